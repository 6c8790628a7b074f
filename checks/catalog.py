"""Every registered query next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from outagelens.functions import cause, incident, redaction, text, times
from outagelens.operators import (
    bundle,
    enrich,
    filters,
    layout,
    profile,
    quantile,
    rca,
    redact,
    related,
    reports,
    stages,
    timeline,
)
from outagelens.session import configure
from outagelens.sources import files, schemas
from outagelens.sources.scratch import COMPRESSION, scratch_folder, stored
from outagelens.streaming import landing

from . import views
from .views_sql import hashed, hits, redacted, with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SALT = "unit_salt"
AS_OF = "1998-08-01 00:00:00"


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if given, the body of its SQL (views are added)."""

    def register(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: query(configure(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return query

    return register


def enriched(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The enriched incidents; only what the asked export columns need is read."""
    return enrich.enrich_incidents(views.incidents(spark, sf_dir, *columns))


def as_text(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that both engines show them alike."""
    stamps = [name for name, kind in df.dtypes if kind.startswith("timestamp")]
    return df.withColumns({name: times.timestamp_text(name) for name in stamps})


# --- Enrichment of rows -----------------------------------------------------------


@check("flag_active", "SELECT number, active AS \"isActive\" FROM enriched")
def flag_active(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "state")
    return rows.select("number", incident.is_active("state").alias("isActive"))


@check("flag_high_impact", "SELECT number, high AS \"isHighImpact\" FROM enriched")
def flag_high_impact(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "priority")
    return rows.select("number", incident.is_high_impact("priority").alias("isHighImpact"))


@check("categorize_pattern", "SELECT number, pattern AS \"patternCategory\" FROM enriched")
def categorize_pattern(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "short_description")
    return rows.select("number", incident.pattern_category("short_description").alias("patternCategory"))


@check("resolution_hours", "SELECT number, hours AS \"resolutionTimeHrs\" FROM enriched")
def resolution_hours(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "opened_at", "resolved_at")
    return rows.select("number", times.hours_between("opened_at", "resolved_at").alias("resolutionTimeHrs"))


@check("sla_breach", "SELECT number, breach AS \"slaBreach\" FROM enriched")
def sla_breach(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "priority", "opened_at", "resolved_at")
    breach = incident.sla_breach(
        times.hours_between("opened_at", "resolved_at"), incident.is_high_impact("priority")
    )
    return rows.select("number", breach.alias("slaBreach"))


@check("user_impact_estimate", "SELECT number, users AS \"userImpactEstimate\" FROM enriched")
def user_impact_estimate(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "ci_type")
    return rows.select(
        "number", incident.user_impact_estimate("number", "ci_type").alias("userImpactEstimate")
    )


@check("iso_week", "SELECT number, week FROM enriched")
def iso_week(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "opened_at")
    return rows.select("number", times.iso_week("opened_at").alias("week"))


ENRICHED_COLUMNS = (
    "number", "short_description", "priority", "state", "opened_at", "resolved_at", "ci_type",
    "assignment_group", "location",
)


@check(
    "enrich_incidents",
    """SELECT number, short_description, priority, state,
              strftime(opened_at, '%Y-%m-%d %H:%M:%S') AS "openedDate",
              strftime(resolved_at, '%Y-%m-%d %H:%M:%S') AS "resolvedDate",
              ci_type, assignment_group, location, active AS "isActive", high AS "isHighImpact",
              pattern AS "patternCategory", hours AS "resolutionTimeHrs", breach AS "slaBreach",
              users AS "userImpactEstimate", week
       FROM enriched""",
)
def enrich_incidents(spark, sf_dir):
    return as_text(enriched(spark, sf_dir, *ENRICHED_COLUMNS))


@check(
    "rename_standard",
    """SELECT number, state, strftime(opened_at, '%Y-%m-%d %H:%M:%S') AS "openedDate",
              strftime(resolved_at, '%Y-%m-%d %H:%M:%S') AS "resolvedDate", ci_type FROM incidents""",
)
def rename_standard(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "state", "opened_at", "resolved_at", "ci_type")
    export = rows.withColumnsRenamed(
        {"state": "incident_state", "resolved_at": "u_resolved", "ci_type": "u_ci_type"}
    )
    return as_text(enrich.rename_standard(export))


@check(
    "fill_defaults",
    """SELECT number, priority, 'Unknown' AS ci_type, 'Unassigned' AS assigned_to,
              0 AS reassignment_count FROM incidents""",
)
def fill_defaults(spark, sf_dir):
    return enrich.fill_defaults(views.incidents(spark, sf_dir, "number", "priority"))


@check(
    "coerce_timestamps",
    """SELECT number, strftime(TRY_CAST(stamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS stamp
       FROM reference_fields""",
)
def coerce_timestamps(spark, sf_dir):
    rows = views.reference_fields(spark, sf_dir).select("number", "stamp")
    return as_text(enrich.coerce_timestamps(rows, ["stamp"]))


@check(
    "display_value",
    """SELECT number, CASE WHEN starts_with(reference, '{')
              THEN coalesce(json_extract_string(CASE WHEN json_valid(reference) THEN reference END, '$.display_value'), 'Unknown')
              ELSE coalesce(reference, 'Unknown') END AS reference FROM reference_fields""",
)
def display_value(spark, sf_dir):
    rows = views.reference_fields(spark, sf_dir)
    return rows.select("number", text.display_value("reference", "Unknown").alias("reference"))


@check(
    "coalesce_chain",
    """SELECT number, coalesce(nullif(close_notes, ''), nullif(short_description, '')) AS notes,
              coalesce(nullif(short_description, ''), nullif(description, '')) AS description FROM incidents""",
)
def coalesce_chain(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "close_notes", "short_description", "description")
    return rows.select(
        "number",
        text.first_text("close_notes", "short_description").alias("notes"),
        text.first_text("short_description", "description").alias("description"),
    )


@check(
    "safe_int",
    """SELECT number, CASE WHEN regexp_full_match(trim(amount), '[+-]?[0-9]+')
              THEN trim(amount)::BIGINT ELSE 0 END AS amount FROM reference_fields""",
)
def safe_int(spark, sf_dir):
    rows = views.reference_fields(spark, sf_dir)
    return rows.select("number", text.safe_int("amount").alias("amount"))


@check(
    "location_parsed",
    """SELECT number, split_part(location, ' - ', 1) AS site_code, split_part(location, ' - ', 2) AS city,
              split_part(split_part(location, ' - ', 3), ' / ', 1) AS country,
              split_part(split_part(location, ' - ', 3), ' / ', 2) AS building FROM incidents""",
)
def location_parsed(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "location")
    return rows.select("number", incident.location_parts("location").alias("parts")).select("number", "parts.*")


@check(
    "priority_score",
    "SELECT number, (10 - 2 * (substr(priority, 1, 1)::INTEGER - 1))::INTEGER AS priority_score FROM incidents",
)
def priority_score(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "priority")
    return rows.select("number", incident.priority_score("priority").alias("priority_score"))


# --- Filters ----------------------------------------------------------------------


@check(
    "filter_network_group",
    "SELECT number, assignment_group FROM incidents WHERE assignment_group ILIKE '%network%'",
)
def filter_network_group(spark, sf_dir):
    return filters.filter_group(views.incidents(spark, sf_dir, "number", "assignment_group"), "network")


@check(
    "filter_open_network",
    """SELECT number, assignment_group, state FROM incidents
       WHERE assignment_group ILIKE '%network%' AND state <> 'Resolved'""",
)
def filter_open_network(spark, sf_dir):
    return filters.filter_open(views.incidents(spark, sf_dir, "number", "assignment_group", "state"))


@check(
    "filter_priority_in",
    "SELECT number, priority FROM incidents WHERE priority IN ('1 - Critical', '2 - High')",
)
def filter_priority_in(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "priority")
    return filters.filter_priority_in(rows, ["1 - Critical", "2 - High"])


@check(
    "filter_priority_at_most",
    "SELECT number, priority FROM incidents WHERE TRY_CAST(substr(priority, 1, 1) AS INTEGER) <= 2",
)
def filter_priority_at_most(spark, sf_dir):
    return filters.filter_priority_at_most(views.incidents(spark, sf_dir, "number", "priority"), 2)


@check(
    "filter_recent",
    f"""SELECT number, strftime(opened_at, '%Y-%m-%d %H:%M:%S') AS opened_at FROM incidents
        WHERE opened_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY
        ORDER BY incidents.opened_at DESC, number LIMIT 500""",
)
def filter_recent(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "opened_at")
    return as_text(filters.filter_recent(rows, 30, F.lit(AS_OF).cast("timestamp_ntz"), 500, "opened_at"))


@check(
    "filter_recent_all",
    f"""SELECT number, strftime(opened_at, '%Y-%m-%d %H:%M:%S') AS opened_at FROM incidents
        WHERE opened_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY""",
)
def filter_recent_all(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "opened_at")
    return as_text(filters.filter_recent(rows, 30, F.lit(AS_OF).cast("timestamp_ntz"), opened="opened_at"))


@check(
    "lookup_incident",
    """SELECT number, priority, state FROM incidents
       WHERE number IN (SELECT 'INC' || lpad(user_id::VARCHAR, 7, '0') FROM events)""",
)
def lookup_incident(spark, sf_dir):
    reported = views.table(spark, sf_dir, "events").select(
        F.concat(F.lit("INC"), F.lpad(F.col("user_id").cast("string"), 7, "0")).alias("number")
    )
    return filters.lookup_incident(views.incidents(spark, sf_dir, "number", "priority", "state"), reported)


@check(
    "project_fields",
    "SELECT number, short_description, priority, state FROM incidents",
)
def project_fields(spark, sf_dir):
    fields = ("number", "short_description", "priority", "state")
    return filters.project_fields(views.incidents(spark, sf_dir, *fields), fields)


@check(
    "page_incidents",
    "SELECT number, priority, state FROM incidents ORDER BY number LIMIT 1000 OFFSET 0",
)
def page_incidents(spark, sf_dir):
    return filters.page_incidents(views.incidents(spark, sf_dir, "number", "priority", "state"), 1000, 0)


@check(
    "page_by_directory",
    "SELECT number, priority, state FROM incidents ORDER BY number LIMIT 100 OFFSET 700",
)
def page_by_directory(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "priority", "state")
    return filters.directory_page(rows, filters.page_directory(rows, 100), 7)


@check(
    "page_directory",
    """SELECT (place // 100)::BIGINT AS page, number AS first_key
       FROM (SELECT number, row_number() OVER (ORDER BY number) - 1 AS place FROM incidents) WHERE place % 100 = 0""",
)
def page_directory(spark, sf_dir):
    return filters.page_directory(views.incidents(spark, sf_dir, "number"), 100)


@check(
    "preview_incidents",
    """SELECT number, substr(coalesce(short_description, 'N/A'), 1, 50) AS short_description, priority, state
       FROM incidents ORDER BY number LIMIT 3""",
)
def preview_incidents(spark, sf_dir):
    return filters.preview_incidents(
        views.incidents(spark, sf_dir, "number", "short_description", "priority", "state")
    )


# --- Redaction --------------------------------------------------------------------


def _documents(spark, sf_dir):
    return views.table(spark, sf_dir, "documents")


def _register_steps():
    """One query per masking step: documents, or texts that hold what documents lack."""
    for step in ("email", "phone", "ip", "name"):

        @check(f"redact_{step}", f"SELECT doc_id, {redacted('text', step)} AS text FROM documents")
        def on_documents(spark, sf_dir, step=step):
            return _documents(spark, sf_dir).select("doc_id", redaction.redact_step("text", step).alias("text"))

    for step in ("ssn", "floor"):

        @check(f"redact_{step}", f"SELECT c_custkey, {redacted('text', step)} AS text FROM contacts")
        def on_contacts(spark, sf_dir, step=step):
            rows = views.contacts(spark, sf_dir)
            return rows.select("c_custkey", redaction.redact_step("text", step).alias("text"))

    @check("redact_room", f"SELECT number, {redacted('description', 'room')} AS description FROM incidents")
    def on_descriptions(spark, sf_dir):
        rows = views.incidents(spark, sf_dir, "number", "description")
        return rows.select("number", redaction.redact_step("description", "room").alias("description"))


_register_steps()


@check("redact_text", f"SELECT doc_id, {redacted('text')} AS text FROM documents")
def redact_text(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", redaction.redact_text("text").alias("text"))


@check("redact_text_contacts", f"SELECT c_custkey, {redacted('text')} AS text FROM contacts")
def redact_text_contacts(spark, sf_dir):
    return views.contacts(spark, sf_dir).select("c_custkey", redaction.redact_text("text").alias("text"))


@check("redact_text_conversations", f"SELECT conv_id, turn, {redacted('text')} AS text FROM conversations")
def redact_text_conversations(spark, sf_dir):
    rows = views.table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", redaction.redact_text("text").alias("text"))


@check("hash_id", f"SELECT number, {hashed('number', SALT)} AS number_hash FROM incidents")
def hash_id(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number")
    return rows.select("number", redaction.hash_id("number", SALT).alias("number_hash"))


REDACTED_INPUT = (
    "number", "sys_id", "short_description", "description", "caller_id", "assigned_to", "location", "priority",
)


@check(
    "redact_frame",
    f"""SELECT number, sys_id, {redacted('short_description')} AS short_description,
               {redacted('description')} AS description, location, priority,
               {hashed('number', SALT)} AS number_hash, {hashed('sys_id', SALT)} AS sys_id_hash
        FROM incidents""",
)
def redact_frame(spark, sf_dir):
    return redact.redact_frame(views.incidents(spark, sf_dir, *REDACTED_INPUT), SALT)


@check(
    "redact_live_export",
    f"""SELECT number, sys_id, {redacted('short_description')} AS short_description,
               {redacted('description')} AS description, split_part(split_part(location, ' - ', 3), ' / ', 1) AS location,
               priority, {hashed('number', SALT)} AS number_hash
        FROM incidents""",
)
def redact_live_export(spark, sf_dir):
    return redact.redact_live_export(views.incidents(spark, sf_dir, *REDACTED_INPUT), SALT)


@check(
    "redact_replace_id",
    f"""SELECT sys_id, {redacted('short_description')} AS short_description,
               {redacted('description')} AS description, assigned_to, split_part(location, '-', 1) AS location,
               priority, {hashed('number', SALT)} AS id_hash
        FROM incidents""",
)
def redact_replace_id(spark, sf_dir):
    return redact.redact_replace_id(views.incidents(spark, sf_dir, *REDACTED_INPUT), SALT)


@check(
    "location_country",
    "SELECT number, split_part(split_part(location, ' - ', -1), ' / ', 1) AS country FROM incidents",
)
def location_country(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "location")
    return rows.select("number", redaction.location_country("location").alias("country"))


@check("location_prefix", "SELECT number, split_part(location, '-', 1) AS prefix FROM incidents")
def location_prefix(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "location")
    return rows.select("number", redaction.location_prefix("location").alias("prefix"))


def _hit_sum(step: str, *columns: str) -> str:
    return f"sum({' + '.join(hits(column, step) for column in columns)})::BIGINT"


REDACTION_SQL = f"""SELECT *, email_count_redacted = 0 AND phone_count_redacted = 0 AS redaction_successful
        FROM (SELECT {_hit_sum('email', 'text', 'lang', 'source')} AS email_count_original,
                     {_hit_sum('phone', 'text', 'lang', 'source')} AS phone_count_original FROM documents),
             (SELECT {_hit_sum('email', 'text', 'lang', 'source')} AS email_count_redacted,
                     {_hit_sum('phone', 'text', 'lang', 'source')} AS phone_count_redacted
              FROM (SELECT {redacted('text')} AS text, lang, source FROM documents))"""


@check("validate_redaction", REDACTION_SQL)
def validate_redaction(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    masked = redact.redact_frame(rows, SALT, text=("text",), ids=(), drop=())
    return redact.validate_redaction(rows, masked)


@check("validate_redaction_observed", REDACTION_SQL)
def validate_redaction_observed(spark, sf_dir):
    """The same counts, made by the one pass that writes the redacted table."""
    seen = redact.ObservedRedaction(spark)
    masked = redact.redact_frame(seen.original(_documents(spark, sf_dir)), SALT, text=("text",), ids=(), drop=())
    stored(seen.redacted(masked), "redacted")
    return seen.check()


@check(
    "pii_column_scan",
    f"""SELECT 'caller_id' AS column_name, TRUE AS sensitive_by_name, {_hit_sum('email', 'caller_id')} AS email_hits,
               {_hit_sum('phone', 'caller_id')} AS phone_hits FROM incidents
        UNION ALL SELECT 'description', FALSE, {_hit_sum('email', 'description')}, {_hit_sum('phone', 'description')} FROM incidents
        UNION ALL SELECT 'assigned_to', TRUE, {_hit_sum('email', 'assigned_to')}, {_hit_sum('phone', 'assigned_to')} FROM incidents
        UNION ALL SELECT 'number', FALSE, {_hit_sum('email', 'number')}, {_hit_sum('phone', 'number')} FROM incidents""",
)
def pii_column_scan(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "caller_id", "description", "assigned_to", "number")
    return redact.pii_column_scan(rows)


@check(
    "pii_column_scan_contacts",
    f"""SELECT 'c_custkey' AS column_name, FALSE AS sensitive_by_name, 0::BIGINT AS email_hits, 0::BIGINT AS phone_hits
        UNION ALL SELECT 'text', FALSE, {_hit_sum('email', 'text')}, {_hit_sum('phone', 'text')} FROM contacts""",
)
def pii_column_scan_contacts(spark, sf_dir):
    return redact.pii_column_scan(views.contacts(spark, sf_dir))


# --- Aggregates -------------------------------------------------------------------

HOURS_INPUT = ("number", "state", "priority", "opened_at", "resolved_at")


@check("total_incidents", "SELECT count(*) AS total_incidents FROM incidents")
def total_incidents(spark, sf_dir):
    return profile.total_incidents(views.incidents(spark, sf_dir, "number"))


@check(
    "active_resolved_counts",
    """SELECT count(*) FILTER (active) AS active_incidents, count(*) FILTER (NOT active) AS resolved_incidents
       FROM enriched""",
)
def active_resolved_counts(spark, sf_dir):
    return profile.active_resolved_counts(enriched(spark, sf_dir, "number", "state"))


@check("high_impact_count", "SELECT count(*) FILTER (high) AS high_impact_incidents FROM enriched")
def high_impact_count(spark, sf_dir):
    return profile.high_impact_count(enriched(spark, sf_dir, "number", "state", "priority"))


def _distribution_sql(source: str, column: str) -> str:
    return f"""SELECT {column}, count(*) AS n, 100::DOUBLE * count(*) / (SELECT count(*) FROM enriched) AS pct
               FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


@check(
    "pattern_distribution",
    _distribution_sql('(SELECT pattern AS "patternCategory" FROM enriched)', '"patternCategory"'),
)
def pattern_distribution(spark, sf_dir):
    return profile.distribution(enriched(spark, sf_dir, "number", "state", "short_description"), "patternCategory")


@check("priority_distribution", _distribution_sql("enriched", "priority"))
def priority_distribution(spark, sf_dir):
    return profile.distribution(views.incidents(spark, sf_dir, "priority"), "priority")


def _top_sql(column: str) -> str:
    return f"SELECT {column}, count(*) AS n FROM incidents GROUP BY {column} ORDER BY n DESC, {column} LIMIT 5"


@check("top_groups", _top_sql("assignment_group"))
def top_groups(spark, sf_dir):
    return profile.top_values(views.incidents(spark, sf_dir, "assignment_group"), "assignment_group")


@check("top_locations", _top_sql("location"))
def top_locations(spark, sf_dir):
    return profile.top_values(views.incidents(spark, sf_dir, "location"), "location")


@check(
    "sla_breach_rate",
    """SELECT count(*) AS resolved, count(*) FILTER (breach) AS breached,
              count(*) FILTER (NOT breach) AS within_sla,
              100::DOUBLE * count(*) FILTER (breach) / count(*) AS sla_breach_rate
       FROM enriched WHERE hours IS NOT NULL""",
)
def sla_breach_rate(spark, sf_dir):
    return profile.sla_breach_rate(enriched(spark, sf_dir, *HOURS_INPUT))


@check(
    "resolution_stats",
    """SELECT avg(hours) AS avg_hours, min(hours) AS fastest_hours, max(hours) AS longest_hours,
              median(hours) AS median_hours FROM enriched""",
)
def resolution_stats(spark, sf_dir):
    return profile.resolution_stats(enriched(spark, sf_dir, *HOURS_INPUT))


@check(
    "approximate_hours",
    """SELECT pattern AS "patternCategory", count(hours) AS n, rank, TRUE AS within_bound
       FROM enriched, (SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS rank) GROUP BY pattern, rank HAVING count(hours) > 0""",
)
def approximate_hours(spark, sf_dir):
    """Whether the true rank of each answer is the asked one, within the promised error."""
    ranks = (0.1, 0.5, 0.9)
    rows = stored(enriched(spark, sf_dir, *HOURS_INPUT, "short_description"), "enriched").filter("resolutionTimeHrs IS NOT NULL")
    answers = profile.approximate_hours(rows, ["patternCategory"], ranks)
    named = F.arrays_zip(F.array(*map(F.lit, ranks)).alias("rank"), F.col("hours").alias("answer"))
    answers = answers.select("patternCategory", "n", F.inline(named))
    hours, answer = F.col("resolutionTimeHrs"), F.col("answer")
    placed = rows.select("patternCategory", "resolutionTimeHrs").join(answers, "patternCategory")
    low, high = F.count_if(hours < answer) / F.col("n"), F.count_if(hours <= answer) / F.col("n")
    rank, error = F.col("rank"), F.lit(quantile.RANK_ERROR)
    within = ((low - error <= rank) & (rank <= high + error)).alias("within_bound")
    return placed.groupBy("patternCategory", "n", "rank", "answer").agg(within).drop("answer")


@check(
    "merged_sketches",
    "SELECT count(hours) AS n, TRUE AS within_bound FROM enriched",
)
def merged_sketches(spark, sf_dir):
    """Sketches by category, merged into one of all rows; its median against all values."""
    rows = stored(enriched(spark, sf_dir, *HOURS_INPUT, "short_description"), "enriched")
    hours = F.col("resolutionTimeHrs")
    parts = stored(quantile.hour_sketches(rows, hours, ["patternCategory"]), "sketches")
    n, answer = quantile.merge_sketches(parts, []).select("n", quantile.sketch_quantile(0.5)).first()
    low, high = F.count_if(hours < answer) / F.lit(n), F.count_if(hours <= answer) / F.lit(n)
    error = F.lit(quantile.RANK_ERROR)
    within = ((low - error <= 0.5) & (high + error >= 0.5)).alias("within_bound")
    return rows.agg(F.count(hours).alias("n"), within)


@check(
    "user_impact_totals",
    "SELECT sum(users)::BIGINT AS total_users, avg(users) AS avg_users FROM enriched",
)
def user_impact_totals(spark, sf_dir):
    return profile.user_impact_totals(enriched(spark, sf_dir, "number", "state", "ci_type"))


@check(
    "weekly_trend",
    "SELECT week, count(*) AS n FROM enriched WHERE week IS NOT NULL GROUP BY week ORDER BY week LIMIT 5",
)
def weekly_trend(spark, sf_dir):
    return profile.weekly_trend(enriched(spark, sf_dir, "number", "state", "opened_at"), 5)


@check(
    "weekly_trend_all",
    "SELECT week, count(*) AS n FROM enriched WHERE week IS NOT NULL GROUP BY week",
)
def weekly_trend_all(spark, sf_dir):
    return profile.weekly_trend(enriched(spark, sf_dir, "number", "state", "opened_at"))


@check(
    "weekly_trend_events",
    "SELECT week(ts)::INTEGER AS week, count(*) AS n FROM events GROUP BY 1 ORDER BY 1 LIMIT 5",
)
def weekly_trend_events(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select(times.iso_week("ts").alias("week"))
    return profile.weekly_trend(events, 5)


@check(
    "run_metrics",
    f"""SELECT '{AS_OF}' AS timestamp, count(*) AS raw_record_count, count(*) AS processed_record_count,
               7 AS columns_added, count(*) FILTER (active) AS active_incidents,
               count(*) FILTER (high) AS high_impact_incidents, count(*) FILTER (breach) AS sla_breaches
        FROM enriched""",
)
def run_metrics(spark, sf_dir):
    raw = views.incidents(spark, sf_dir, *HOURS_INPUT)
    at = F.lit(AS_OF).cast("timestamp_ntz")
    return as_text(profile.run_metrics(raw, enrich.enrich_incidents(raw), at))


@check(
    "sink_metrics_retried",
    f"""SELECT '{AS_OF}' AS timestamp, count(*) AS raw_record_count, count(*) AS processed_record_count,
               7 AS columns_added, count(*) FILTER (active) AS active_incidents,
               count(*) FILTER (high) AS high_impact_incidents, count(*) FILTER (breach) AS sla_breaches,
               'r1' AS run_id
        FROM enriched""",
)
def sink_metrics_retried(spark, sf_dir):
    """A run that counts while it writes, tried twice under one id."""
    path = scratch_folder(spark, "metrics")
    for _ in range(2):
        run = profile.ObservedRun(spark)
        rows = enrich.enrich_incidents(run.raw(views.incidents(spark, sf_dir, *HOURS_INPUT)))
        stored(run.processed(rows), "processed")
        metrics = as_text(run.metrics(F.lit(AS_OF).cast("timestamp_ntz")))
        files.sink_metrics(metrics, path, "r1")
    schema = ", ".join(f"{name} {kind}" for name, kind in metrics.dtypes)
    return spark.read.schema(schema + ", run_id string").option("header", True).csv(path)


def _share(metric: str, column: str, top: bool = False) -> str:
    cut = f"ORDER BY n DESC, key LIMIT 5" if top else ""
    return f"""(SELECT '{metric}' AS metric, {column} AS key, count(*) AS n,
                       100::DOUBLE * count(*) / (SELECT count(*) FROM enriched) AS value
                FROM enriched WHERE {column} IS NOT NULL GROUP BY {column} {cut})"""


def _scalar(metric: str, count: str = "NULL::BIGINT", value: str = "NULL::DOUBLE") -> str:
    return f"SELECT '{metric}' AS metric, NULL::VARCHAR AS key, {count} AS n, {value} AS value FROM enriched"


@check(
    "analyze_incidents",
    " UNION ALL ".join(
        [
            _scalar("total_incidents", "count(*)"),
            _scalar("active_incidents", "count(*) FILTER (active)"),
            _scalar("resolved_incidents", "count(*) FILTER (NOT active)"),
            _scalar("high_impact_incidents", "count(*) FILTER (high)"),
            _scalar("sla_breached", "count(*) FILTER (breach)"),
            _scalar("within_sla", "count(*) FILTER (NOT breach AND hours IS NOT NULL)"),
            _scalar("total_users", "sum(users)::BIGINT"),
            _scalar("avg_users", value="avg(users)"),
            _scalar("fastest_resolution_hours", value="min(hours)"),
            _scalar("longest_resolution_hours", value="max(hours)"),
            "(SELECT 'weekly_trend' AS metric, week::VARCHAR AS key, count(*) AS n, 100::DOUBLE * count(*) / (SELECT count(*) FROM enriched) AS value FROM enriched WHERE week IS NOT NULL GROUP BY week)",
            _scalar("sla_breach_rate", value="100::DOUBLE * count(*) FILTER (breach) / count(hours)"),
            _scalar("avg_resolution_hours", value="avg(hours)"),
            _scalar("median_resolution_hours", value="median(hours)"),
            _share("pattern_distribution", "pattern"),
            _share("priority_distribution", "priority"),
            _share("assignment_groups", "assignment_group", top=True),
            _share("top_locations", "location", top=True),
        ]
    ),
)
def analyze_incidents(spark, sf_dir):
    return profile.analyze_incidents(enriched(spark, sf_dir, *ENRICHED_COLUMNS))


@check(
    "category_profile",
    """SELECT pattern AS "patternCategory", count(*) AS incidents, count(*) FILTER (active) AS active,
              count(*) FILTER (high) AS high_impact, count(hours) AS resolved, count(*) FILTER (breach) AS breached,
              avg(hours) AS avg_hours, 100::DOUBLE * count(*) FILTER (breach) / count(hours) AS sla_breach_rate,
              median(hours) AS median_hours
       FROM enriched GROUP BY pattern""",
)
def category_profile(spark, sf_dir):
    return profile.category_profile(enriched(spark, sf_dir, *HOURS_INPUT, "short_description"))


# --- Joins and timeline -----------------------------------------------------------


@check(
    "join_journal",
    """SELECT i.number, i.sys_id, entry_id, strftime(sys_created_on, '%Y-%m-%d %H:%M:%S') AS sys_created_on,
              element, value
       FROM incidents i LEFT JOIN journal ON element_id = i.sys_id""",
)
def join_journal(spark, sf_dir):
    ids = views.incidents(spark, sf_dir, "number", "sys_id")
    return as_text(timeline.join_journal(ids, views.journal(spark, sf_dir)))


@check(
    "work_notes",
    "SELECT number, timestamp, entry_id, author, value AS note FROM notes WHERE element = 'work_notes'",
)
def work_notes(spark, sf_dir):
    ids = views.incidents(spark, sf_dir, "number", "sys_id")
    return as_text(timeline.work_notes(ids, views.journal(spark, sf_dir)))


@check(
    "comments",
    "SELECT number, timestamp, entry_id, author, value AS comment FROM notes WHERE element = 'comments'",
)
def comments(spark, sf_dir):
    ids = views.incidents(spark, sf_dir, "number", "sys_id")
    return as_text(timeline.comments(ids, views.journal(spark, sf_dir)))


CHILD_INPUT = (
    "number", "sys_id", "parent", "short_description", "priority", "state", "opened_at", "resolved_at",
)


def _related_sql(links: str) -> str:
    return f"""SELECT i.number, related_number, l.short_description, l.priority, l.state,
                      l.opened_at, l.ended_at
               FROM {links} l JOIN incidents i ON i.sys_id = l.sys_id"""


@check("related_incidents", _related_sql("child_links"))
def related_incidents(spark, sf_dir):
    return as_text(related.related_incidents(views.incidents(spark, sf_dir, *CHILD_INPUT)))


@check("related_problems", _related_sql("problem_links"))
def related_problems(spark, sf_dir):
    ids = views.incidents(spark, sf_dir, "number", "sys_id")
    return as_text(related.related_problems(ids, views.problems(spark, sf_dir)))


@check("related_changes", _related_sql("change_links"))
def related_changes(spark, sf_dir):
    ids = views.incidents(spark, sf_dir, "number", "sys_id")
    return as_text(related.related_changes(ids, views.changes(spark, sf_dir)))


EVENT_INPUT = (
    "number", "sys_id", "short_description", "opened_at", "resolved_at", "caller_id", "assigned_to", "close_notes",
)


@check(
    "timeline",
    """SELECT number, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, seq, entry_id, event_type, actor,
              description, details FROM events_all""",
)
def timeline_query(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, *EVENT_INPUT)
    return as_text(timeline.timeline(rows, views.journal(spark, sf_dir)))


@check(
    "timeline_top5",
    """SELECT number, position, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, event_type,
              substr(actor, 1, 30) AS actor, substr(description, 1, 50) AS description
       FROM events_ranked WHERE position <= 5
       UNION ALL
       SELECT DISTINCT number, 6, '...', '...', '...', '*(' || (total - 5)::VARCHAR || ' more events)*'
       FROM events_ranked WHERE total > 5""",
)
def timeline_top5(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, *EVENT_INPUT)
    return timeline.timeline_top(rows, views.journal(spark, sf_dir), 5)


@check(
    "timeline_top20",
    """WITH cases AS (
           SELECT 'CUS' || c_custkey AS number, md5('CUS' || c_custkey) AS sys_id FROM customer),
       entries AS (
           SELECT md5('CUS' || o_custkey) AS sys_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS entry_id,
                  o_orderdate + to_hours(l_linenumber) AS ts, 'work_notes' AS actor, 'Journal Entry' AS event_type,
                  CASE l_partkey % 2 WHEN 0 THEN 'Checked the logs.' ELSE 'Waiting for the vendor.' END AS description
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
       ranked AS (
           SELECT *, row_number() OVER (PARTITION BY sys_id ORDER BY ts, entry_id) AS position,
                  count(*) OVER (PARTITION BY sys_id) AS total
           FROM entries JOIN cases USING (sys_id))
       SELECT number, position, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, event_type, substr(actor, 1, 30) AS actor,
              substr(description, 1, 50) AS description
       FROM ranked WHERE position <= 20
       UNION ALL
       SELECT DISTINCT number, 21, '...', '...', '...', '*(' || (total - 20)::VARCHAR || ' more events)*'
       FROM ranked WHERE total > 20""",
)
def timeline_top20(spark, sf_dir):
    """Work notes of all orders of a customer as one case: most have far more than 20."""
    customers = views.table(spark, sf_dir, "customer")
    number = F.concat(F.lit("CUS"), F.col("c_custkey").cast("string"))
    nothing = F.lit(None).cast("string")
    cases = customers.select(number.alias("number"), F.md5(number.cast("binary")).alias("sys_id"))
    cases = cases.withColumns({name: nothing for name in EVENT_INPUT if name not in ("number", "sys_id")})
    orders = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    suppliers = views.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = views.table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").join(suppliers, "l_suppkey", "left")
    owner = F.concat(F.lit("CUS"), F.col("o_custkey").cast("string")).cast("binary")
    entries = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("entry_id"),
        F.md5(owner).alias("element_id"),
        F.lit("incident").alias("name"),
        F.lit("work_notes").alias("element"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("sys_created_on"),
        F.col("s_name").alias("author"),
        F.when(F.col("l_partkey") % 2 == 0, "Checked the logs.").otherwise("Waiting for the vendor.").alias("value"),
    )
    return timeline.timeline_top(cases, entries, 20)


@check(
    "related_top5",
    """SELECT number, kind, related_number, short_description, position
       FROM related_ranked WHERE position <= 5""",
)
def related_top5(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, *CHILD_INPUT)
    return related.related_top(rows, views.problems(spark, sf_dir), views.changes(spark, sf_dir))


def _related_json(kind: str, ended: str) -> str:
    return f"""coalesce((SELECT to_json(list(struct_pack(number := related_number, short_description := l.short_description,
                  priority := l.priority, state := l.state, opened_at := l.opened_at, {ended} := l.ended_at)
                  ORDER BY related_number)) FROM {kind}_links l WHERE l.sys_id = i.sys_id)::VARCHAR, '[]')"""


def _notes_json(element: str, name: str) -> str:
    return f"""coalesce((SELECT to_json(list(struct_pack(timestamp := timestamp, author := author, {name} := value)
                  ORDER BY timestamp, entry_id)) FROM notes n
                  WHERE n.sys_id = i.sys_id AND n.element = '{element}')::VARCHAR, '[]')"""


TIMELINE_JSON = """coalesce((SELECT to_json(list(struct_pack(timestamp := strftime(ts, '%Y-%m-%d %H:%M:%S'),
    event_type := event_type, actor := actor, description := description, details := details)
    ORDER BY ts, seq, entry_id)) FROM events_all e WHERE e.sys_id = i.sys_id)::VARCHAR, '[]')"""


@check(
    "incident_bundle",
    f"""SELECT number, 0::BIGINT AS part, {TIMELINE_JSON} AS timeline,
               {_notes_json('work_notes', 'note')} AS work_notes, {_notes_json('comments', 'comment')} AS comments,
               {_related_json('child', 'resolved_at')} AS related_incidents,
               {_related_json('problem', 'resolved_at')} AS related_problems,
               {_related_json('change', 'closed_at')} AS related_changes
        FROM incidents i""",
)
def incident_bundle(spark, sf_dir):
    """The lists are shown as JSON text, which both engines write alike."""
    rows = bundle.incident_bundle(
        views.incidents(spark, sf_dir, *dict.fromkeys(EVENT_INPUT + CHILD_INPUT)),
        views.journal(spark, sf_dir),
        views.problems(spark, sf_dir),
        views.changes(spark, sf_dir),
    )
    lists = [name for name, kind in rows.dtypes if kind.startswith("array")]
    as_json = [F.to_json(name, {"ignoreNullFields": "false"}).alias(name) for name in lists]
    return rows.select("number", "part", *as_json)


@check(
    "bundle_long_lists",
    """SELECT i.number, list, count(*) AS entries, ((count(*) - 1) // 4 + 1)::BIGINT AS parts
       FROM (SELECT sys_id, 'timeline' AS list FROM incidents WHERE opened_at IS NOT NULL
             UNION ALL SELECT sys_id, 'timeline' FROM incidents WHERE resolved_at IS NOT NULL
             UNION ALL SELECT element_id, 'timeline' FROM journal
             UNION ALL SELECT element_id, element FROM journal WHERE element IN ('work_notes', 'comments')) x
       JOIN incidents i USING (sys_id) GROUP BY i.number, list""",
)
def bundle_long_lists(spark, sf_dir):
    """Lists of more than four entries go on in further parts; pieces of long ones hold four at most."""
    rows = bundle.incident_bundle(
        stored(views.incidents(spark, sf_dir, *dict.fromkeys(EVENT_INPUT + CHILD_INPUT)), "incidents"),
        stored(views.journal(spark, sf_dir), "journal"),
        views.problems(spark, sf_dir),
        views.changes(spark, sf_dir),
        piece_rows=4,
        lists=("timeline", "work_notes", "comments"),
    )
    sizes = F.array(*[F.struct(F.lit(x).alias("list"), F.size(x).alias("size")) for x in ("timeline", "work_notes", "comments")])
    pieces = rows.select("number", F.inline(sizes)).filter("size > 0")
    total = F.sum("size").alias("entries")
    least = F.floor((F.sum("size") - 1) / 4) + 1
    # Ranges may cut a list between two pieces; no piece is longer than allowed, and none is missing.
    fits = (F.max("size") <= 4) & (F.count("*") >= least)
    return pieces.groupBy("number", "list").agg(total, F.when(fits, least).cast("bigint").alias("parts"))


# --- Root-cause analysis ----------------------------------------------------------


@check("cause_from_notes", "SELECT number, cause FROM note_causes")
def cause_from_notes(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "close_notes")
    return rows.select("number", rca.note_cause(rows).alias("cause"))


@check("cause_sentence", "SELECT sys_id, sentence FROM sentences WHERE sentence IS NOT NULL")
def cause_sentence(spark, sf_dir):
    return rca.cause_sentences(views.journal(spark, sf_dir))


@check(
    "cause_from_problem",
    "SELECT sys_id, 'Related Problem: ' || nullif(first_problem, '') AS problem_cause FROM first_problems",
)
def cause_from_problem(spark, sf_dir):
    return rca.cause_from_problems(views.problems(spark, sf_dir))


@check("root_cause", "SELECT number, sys_id, root_cause FROM root_causes")
def root_cause(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "sys_id", "close_notes", "description", "short_description")
    return rca.root_causes(rows, views.journal(spark, sf_dir), views.problems(spark, sf_dir))


@check("contributing_factors", "SELECT number, sys_id, factors FROM factors")
def contributing_factors(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "sys_id", "opened_at", "resolved_at", "reassignment_count")
    found = rca.contributing_factors(rows, views.journal(spark, sf_dir))
    return found.select("number", "sys_id", F.array_join("contributing_factors", "\n").alias("factors"))


@check("impact_tier", "SELECT number, business_impact, default_users FROM impacts")
def impact_tier(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "priority", "impact")
    return rows.select(
        "number",
        cause.business_impact("priority", "impact").alias("business_impact"),
        cause.default_users("priority", "impact").alias("default_users"),
    )


@check("technical_impact", "SELECT number, technical_impact FROM impacts")
def technical_impact(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "cmdb_ci", "category")
    return rows.select("number", cause.technical_impact("cmdb_ci", "category").alias("technical_impact"))


@check("affected_users", "SELECT number, affected FROM impacts")
def affected_users(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "description", "short_description", "priority", "impact")
    users = cause.affected_users(
        "description", "short_description", cause.default_users("priority", "impact")
    )
    return rows.select("number", users.alias("affected"))


@check("duration_hours", "SELECT number, hours, hours_text FROM durations")
def duration_hours(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "opened_at", "resolved_at")
    hours = rca.duration_hours(rows)
    return rows.select("number", hours.alias("hours"), cause.hours_text(hours).alias("hours_text"))


@check("resolution_efficiency", "SELECT number, efficiency FROM durations")
def resolution_efficiency(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "opened_at", "resolved_at")
    return rows.select("number", cause.resolution_efficiency(rca.duration_hours(rows)).alias("efficiency"))


DETECTION_SQL = """SELECT i.number, i.sys_id, CASE WHEN hours IS NOT NULL THEN detection END AS detection_hours
       FROM enriched i LEFT JOIN (
           SELECT element_id AS sys_id, CASE WHEN count(*) > 1 THEN
                  (epoch_us(min(sys_created_on) FILTER (regexp_matches(element, 'assignment|work')))
                   - epoch_us(min(sys_created_on)))::DOUBLE / 1000000 / 3600 END AS detection
           FROM journal GROUP BY element_id) d ON d.sys_id = i.sys_id"""


def _landed_events(spark, sf_dir):
    return views.journal(spark, sf_dir).select(
        F.col("element_id").alias("sys_id"),
        F.col("sys_created_on").alias("timestamp"),
        F.col("element").alias("event_type"),
    )


@check("time_to_detection", DETECTION_SQL)
def time_to_detection(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "sys_id", "opened_at", "resolved_at")
    return rca.time_to_detection(rows, _landed_events(spark, sf_dir))


@check("rca_analysis_detection", DETECTION_SQL)
def rca_analysis_detection(spark, sf_dir):
    """The time to detection as the whole analysis has it when landed events are given."""
    found = rca.rca_analysis(
        views.incidents(spark, sf_dir),
        views.journal(spark, sf_dir),
        views.problems(spark, sf_dir),
        _landed_events(spark, sf_dir),
    )
    return found.select("number", "sys_id", "duration_analysis.detection_hours")


@check("priority_justification", "SELECT number, justification FROM justifications")
def priority_justification(spark, sf_dir):
    rows = views.incidents(spark, sf_dir, "number", "priority", "impact", "urgency")
    text_column = cause.priority_justification("priority", "impact", "urgency")
    return rows.select("number", text_column.alias("justification"))


def _analysis(spark, sf_dir):
    return rca.rca_analysis(
        views.incidents(spark, sf_dir), views.journal(spark, sf_dir), views.problems(spark, sf_dir)
    )


@check(
    "rca_analysis",
    """SELECT r.number, r.sys_id, root_cause, factors, business_impact, technical_impact, user_impact, affected,
              hours_text AS total_downtime, efficiency, hours, justification
       FROM root_causes r JOIN factors f ON f.sys_id = r.sys_id JOIN impacts m ON m.sys_id = r.sys_id
       JOIN durations d ON d.sys_id = r.sys_id JOIN justifications j ON j.sys_id = r.sys_id""",
)
def rca_analysis(spark, sf_dir):
    return _analysis(spark, sf_dir).select(
        "number",
        "sys_id",
        "root_cause",
        F.array_join("contributing_factors", "\n").alias("factors"),
        "impact_assessment.business_impact",
        "impact_assessment.technical_impact",
        "impact_assessment.user_impact",
        F.col("impact_assessment.affected_users_estimate").alias("affected"),
        "duration_analysis.total_downtime",
        F.col("duration_analysis.resolution_efficiency").alias("efficiency"),
        F.col("duration_analysis.resolution_hours").alias("hours"),
        F.col("priority_justification").alias("justification"),
    )


@check(
    "stream_analysis",
    """SELECT m.number, business_impact, technical_impact, user_impact, affected, hours_text AS total_downtime,
              efficiency, justification
       FROM impacts m JOIN durations d USING (sys_id) JOIN justifications j USING (sys_id)""",
)
def stream_analysis(spark, sf_dir):
    """Landed responses read as a stream, in two batches, the second run finding only new files."""
    landed, path, checkpoint = (scratch_folder(spark, name) for name in ("landed", "analysed", "stream"))
    rows = as_text(views.incidents(spark, sf_dir))
    record = StructType([StructField(name, StringType()) for name in rows.columns])
    pages = rows.select(
        (F.col("number") < "INC0002").alias("early"),
        F.to_json(F.struct(F.array(F.struct(*[F.col(x).cast("string").alias(x) for x in rows.columns])).alias("result"))).alias("value"),
    )
    for early in (True, False):
        pages.filter(F.col("early") == early).select("value").write.mode("append").text(landed)
        query = landing.write_analysis(landing.landed_incidents(spark, landed, record), path, checkpoint)
        query.awaitTermination()
    return spark.read.parquet(path).select(
        "number",
        "impact_assessment.business_impact",
        "impact_assessment.technical_impact",
        "impact_assessment.user_impact",
        F.col("impact_assessment.affected_users_estimate").alias("affected"),
        "duration_analysis.total_downtime",
        F.col("duration_analysis.resolution_efficiency").alias("efficiency"),
        F.col("priority_justification").alias("justification"),
    )


# --- Reports ----------------------------------------------------------------------

CLOCK = "2025-01-15 12:00:00"
TIMELINE_HEADER = (
    "| Timestamp | Event Type | Actor | Description |' || chr(10) || "
    "'|-----------|------------|-------|-------------|"
)


def _as_of():
    return F.lit(CLOCK).cast("timestamp_ntz")


def _tables(spark, sf_dir):
    """The views as stored tables, as a service desk would have them."""
    tables = {
        "incidents": views.incidents(spark, sf_dir),
        "journal": views.journal(spark, sf_dir),
        "problems": views.problems(spark, sf_dir),
        "changes": views.changes(spark, sf_dir),
    }
    return tuple(stored(rows, name) for name, rows in tables.items())


@check("executive_summary", "SELECT number, summary FROM summaries")
def executive_summary(spark, sf_dir):
    found = reports.summary_of(_analysis(spark, sf_dir), views.incidents(spark, sf_dir))
    return found.select("number", "summary")


@check("recommendations", "SELECT number, recommendations FROM advice")
def recommendations(spark, sf_dir):
    found = reports.summary_of(_analysis(spark, sf_dir), views.incidents(spark, sf_dir))
    return found.select("number", "recommendations")


def _markdown_sql(report: str) -> str:
    return f"""SELECT number, 0::BIGINT AS part, {report} AS report FROM (
        SELECT i.number, '# Root Cause Analysis Report' || chr(10) || chr(10)
            || '**Incident Number:** ' || i.number || chr(10) || '**Report Generated:** {CLOCK}' || chr(10) || chr(10)
            || '---' || chr(10) || chr(10)
            || '## Executive Summary' || chr(10) || chr(10) || summary || chr(10) || chr(10)
            || '## Incident Details' || chr(10) || chr(10)
            || '- **Title:** ' || coalesce(short_description, 'N/A') || chr(10)
            || '- **Priority:** ' || priority || chr(10) || '- **Impact:** ' || impact || chr(10)
            || '- **Urgency:** ' || urgency || chr(10) || '- **State:** ' || state || chr(10)
            || '- **Category:** ' || category || chr(10) || '- **Assignment Group:** ' || assignment_group || chr(10)
            || '- **Opened:** ' || strftime(opened_at, '%Y-%m-%d %H:%M:%S') || chr(10)
            || '- **Resolved:** ' || coalesce(strftime(resolved_at, '%Y-%m-%d %H:%M:%S'), 'N/A') || chr(10) || chr(10)
            || '## Root Cause Analysis' || chr(10) || chr(10) || '**Identified Root Cause:**' || chr(10) || chr(10)
            || root_cause || chr(10)
            || CASE WHEN factors <> '' THEN chr(10) || '**Contributing Factors:**' || chr(10) || chr(10)
                    || '- ' || replace(factors, chr(10), chr(10) || '- ') || chr(10) ELSE '' END || chr(10)
            || '## Impact Assessment' || chr(10) || chr(10)
            || '**Business Impact:** ' || business_impact || chr(10) || chr(10)
            || '**Technical Impact:** ' || technical_impact || chr(10) || chr(10)
            || '**User Impact:** ' || user_impact || chr(10) || chr(10)
            || '## Duration Analysis' || chr(10) || chr(10)
            || CASE WHEN hours IS NOT NULL THEN '- **Time to Resolution:** ' || hours_text || chr(10)
                    || '- **Total Downtime:** ' || hours_text || chr(10)
                    || '- **Resolution Efficiency:** ' || efficiency || chr(10) ELSE '' END || chr(10)
            || '## Priority Classification' || chr(10) || chr(10) || justification || chr(10) || chr(10)
            || CASE WHEN event_lines IS NOT NULL THEN '## Timeline of Events' || chr(10) || chr(10)
                    || '{TIMELINE_HEADER}' || chr(10) || event_lines || chr(10)
                    || CASE WHEN total > 20 THEN '| ... | ... | ... | *(' || (total - 20)::VARCHAR
                            || ' more events)* |' || chr(10) ELSE '' END || chr(10) ELSE '' END
            || CASE WHEN coalesce(incident_lines, problem_lines, change_lines) IS NOT NULL THEN
                    '## Related Records' || chr(10) || chr(10)
                    || coalesce('**Related Incidents:**' || chr(10) || incident_lines || chr(10) || chr(10), '')
                    || coalesce('**Related Problems:**' || chr(10) || problem_lines || chr(10) || chr(10), '')
                    || coalesce('**Related Changes:**' || chr(10) || change_lines || chr(10) || chr(10), '') ELSE '' END
            || '## Recommendations' || chr(10) || chr(10) || recommendations || chr(10) || chr(10)
            || '---' || chr(10) || chr(10) || '*Report generated by incident RCA job on {CLOCK}*' AS report
        FROM incidents i JOIN summaries USING (sys_id) JOIN root_causes USING (sys_id) JOIN factors USING (sys_id)
        JOIN impacts USING (sys_id) JOIN durations USING (sys_id) JOIN justifications USING (sys_id)
        JOIN advice USING (sys_id)
        LEFT JOIN (SELECT sys_id, any_value(total) AS total,
                string_agg('| ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' | ' || event_type || ' | ' || substr(actor, 1, 30)
                           || ' | ' || substr(description, 1, 50) || ' |', chr(10) ORDER BY position) AS event_lines
            FROM events_ranked WHERE position <= 20 GROUP BY sys_id) USING (sys_id)
        LEFT JOIN (SELECT sys_id,
                string_agg('- ' || related_number || ': ' || short_description, chr(10) ORDER BY position)
                    FILTER (kind = 'incident') AS incident_lines,
                string_agg('- ' || related_number || ': ' || short_description, chr(10) ORDER BY position)
                    FILTER (kind = 'problem') AS problem_lines,
                string_agg('- ' || related_number || ': ' || short_description, chr(10) ORDER BY position)
                    FILTER (kind = 'change') AS change_lines
            FROM related_ranked WHERE position <= 5 GROUP BY sys_id) USING (sys_id))"""


@check("report_markdown", _markdown_sql("report"))
def report_markdown(spark, sf_dir):
    return reports.generate_report("markdown", *_tables(spark, sf_dir), as_of=_as_of())


@check(
    "report_text",
    _markdown_sql("replace(replace(replace(report, '**', ''), '#', ''), '|', ' | ')"),
)
def report_text(spark, sf_dir):
    return reports.generate_report("text", *_tables(spark, sf_dir), as_of=_as_of())


def _record_json() -> str:
    fields = ", ".join(
        f"{name} := strftime(i.{name}, '%Y-%m-%d %H:%M:%S')" if name.endswith("_at") else f"{name} := i.{name}"
        for name in views.INCIDENT_COLUMNS
    )
    return f"to_json(struct_pack({fields}))::VARCHAR"


def _length(list_json: str) -> str:
    return f"json_array_length({list_json})::VARCHAR"


JSON_SQL = f"""SELECT i.number, 0::BIGINT AS part,
               '{{"metadata":{{"generated_at":"{CLOCK.replace(' ', 'T')}","incident_number":"' || i.number || '"}},"incident":'
               || {_record_json()}
               || ',"analysis":' || to_json(struct_pack(root_cause := root_cause,
                    contributing_factors := CASE WHEN factors = '' THEN []::VARCHAR[] ELSE string_split(factors, chr(10)) END,
                    impact_assessment := struct_pack(business_impact := business_impact, technical_impact := technical_impact,
                        user_impact := user_impact, affected_users_estimate := affected),
                    duration_analysis := struct_pack(time_to_detection := NULL::VARCHAR, time_to_resolution := hours_text,
                        total_downtime := hours_text, resolution_efficiency := efficiency),
                    priority_justification := justification))::VARCHAR
               || ',"timeline":' || {TIMELINE_JSON}
               || ',"related_records":{{"incidents":' || {_related_json('child', 'resolved_at')}
               || ',"problems":' || {_related_json('problem', 'resolved_at')}
               || ',"changes":' || {_related_json('change', 'closed_at')}
               || '}},"lists":{{"part":0,"parts":1,"totals":{{"timeline":' || {_length(TIMELINE_JSON)}
               || ',"related_incidents":' || {_length(_related_json('child', 'resolved_at'))}
               || ',"related_problems":' || {_length(_related_json('problem', 'resolved_at'))}
               || ',"related_changes":' || {_length(_related_json('change', 'closed_at'))} || '}}}}}}' AS report
        FROM incidents i JOIN root_causes USING (sys_id) JOIN factors USING (sys_id) JOIN impacts USING (sys_id)
        JOIN durations USING (sys_id) JOIN justifications USING (sys_id)"""


@check("report_json", JSON_SQL)
def report_json(spark, sf_dir):
    return reports.generate_report("json", *_tables(spark, sf_dir), as_of=_as_of())


@check(
    "reports_of_layout",
    f"""SELECT 'markdown' AS format, number, part, report FROM ({_markdown_sql('report')})
        UNION ALL SELECT 'json', number, part, report FROM ({JSON_SQL})""",
)
def reports_of_layout(spark, sf_dir):
    """Both kinds of report from events and related records that were stored once by incident."""
    tables = _tables(spark, sf_dir)
    digest = rca.stored_digest(tables[1])
    analysis = stored(rca.rca_analysis(*tables[:3], digest=digest), "analysis")
    path = scratch_folder(spark, "reports")
    with layout.incident_layout(*tables, analysis, ("timeline", *bundle.RELATED)) as laid:
        for name in ("markdown", "json"):
            rows = reports.generate_report(name, *tables, as_of=_as_of(), digest=digest, layout=laid)
            rows.write.parquet(f"{path}/format={name}", compression=COMPRESSION)
    return spark.read.schema("number string, part bigint, report string, format string").parquet(path)


# --- Stages -----------------------------------------------------------------------


def _stages(spark, sf_dir):
    original = views.incidents(
        spark, sf_dir, "number", "state", "short_description", "caller_id", "opened_at", "resolved_at", "close_notes"
    )
    masked = redact.redact_frame(original, SALT, drop_raw_ids=False)
    return {"original": original, "redacted": masked, "processed": enrich.enrich_incidents(masked)}


def _stage_sql() -> str:
    """(column, expression over ``enriched``, first and last stage, looks derived)."""
    kept = [("number", "number", 0, 2), ("state", "state", 0, 2), ("close_notes", "close_notes", 0, 2),
            ("short_description", "short_description", 0, 2), ("caller_id", "caller_id", 0, 0),
            ("opened_at", "opened_at", 0, 1), ("resolved_at", "resolved_at", 0, 1),
            ("number_hash", "number", 1, 2)]
    added = [("openedDate", "opened_at"), ("resolvedDate", "resolved_at"), ("isActive", "active"),
             ("isHighImpact", "high"), ("patternCategory", "pattern"), ("resolutionTimeHrs", "hours"),
             ("slaBreach", "breach"), ("userImpactEstimate", "users"), ("week", "week")]
    words = ("active", "impact", "pattern", "resolution", "sla", "week")
    names = ("original", "redacted", "processed")
    selects = []
    for column, expression, first, last in kept + [(a, b, 2, 2) for a, b in added]:
        counts = []
        for position, stage in enumerate(names):
            present = first <= position <= last
            counts.append(f"{'count(*)' if present else 'NULL::BIGINT'} AS {stage}_rows")
            counts.append(f"{f'count({expression})' if present else 'NULL::BIGINT'} AS {stage}_non_null")
        changes = ([f"added in {names[first]}"] if first else []) + ([f"removed in {names[last + 1]}"] if last < 2 else [])
        derived = any(word in column.lower() for word in words)
        selects.append(
            f"SELECT '{column}' AS column_name, {', '.join(counts)}, '{', '.join(changes)}' AS change, "
            f"{str(derived).upper()} AS derived FROM enriched"
        )
    return " UNION ALL ".join(selects)


@check("stage_profile", _stage_sql())
def stage_profile(spark, sf_dir):
    return stages.stage_profile(_stages(spark, sf_dir))


@check(
    "stage_sizes",
    """SELECT 'original' AS stage, count(*) AS rows, 7 AS columns FROM incidents
       UNION ALL SELECT 'redacted', count(*), 7 FROM incidents
       UNION ALL SELECT 'processed', count(*), 14 FROM incidents""",
)
def stage_sizes(spark, sf_dir):
    return stages.stage_sizes(_stages(spark, sf_dir))


# --- Files ------------------------------------------------------------------------

EXPORT_SQL = """SELECT number, short_description, description, priority, state AS incident_state,
                       assignment_group, strftime(opened_at, '%Y-%m-%d %H:%M:%S') AS opened,
                       strftime(resolved_at, '%Y-%m-%d %H:%M:%S') AS resolved, caller_id, location, ci_type
                FROM incidents"""


def _export(spark, sf_dir):
    """Incidents under the names and in the order of a standard CSV export."""
    rows = as_text(
        views.incidents(
            spark, sf_dir, "number", "short_description", "description", "priority", "state",
            "assignment_group", "opened_at", "resolved_at", "caller_id", "location", "ci_type",
        )
    )
    return rows.withColumnsRenamed({"state": "incident_state", "opened_at": "opened", "resolved_at": "resolved"})


@check("scan_csv", EXPORT_SQL)
def scan_csv(spark, sf_dir):
    path = scratch_folder(spark, "export")
    files.sink_csv(_export(spark, sf_dir), path)
    return files.scan_csv(spark, path, schemas.STANDARD_EXPORT)


@check(
    "sink_csv",
    f"SELECT number, short_description, {redacted('text')} AS text FROM incidents, LATERAL (SELECT description || chr(10) || '\"' || state || '\",' AS text)",
)
def sink_csv(spark, sf_dir):
    """Texts with quotes, commas and line breaks survive the round trip."""
    path = scratch_folder(spark, "redacted")
    noted = F.concat("description", F.lit("\n\""), "state", F.lit("\",")).alias("text")
    rows = views.incidents(spark, sf_dir, "number", "short_description", "description", "state")
    masked = redact.redact_frame(rows.select("number", "short_description", noted), SALT, text=("text",), ids=())
    files.sink_csv(masked, path)
    return files.scan_csv(spark, path, masked.schema, multi_line=True)


@check(
    "scan_json_envelope",
    """SELECT number, short_description, strftime(opened_at, '%Y-%m-%d %H:%M:%S') AS opened_at,
              CASE WHEN o_odd THEN caller_id ELSE '{"display_value":"' || caller_id || '"}' END AS assigned_to
       FROM (SELECT *, NOT starts_with(assigned_to, '{') AS o_odd FROM incidents)""",
)
def scan_json_envelope(spark, sf_dir):
    """One landed response per incident; every other reference field is an object."""
    path = scratch_folder(spark, "landed")
    rows = as_text(views.incidents(spark, sf_dir, "number", "short_description", "opened_at", "assigned_to"))
    is_object = F.col("assigned_to").startswith("{")
    name = F.when(is_object, F.struct(text.display_value("assigned_to", "").alias("display_value")))
    plain = ("number", "short_description", "opened_at")
    with_object = F.to_json(F.struct(F.array(F.struct(*plain, name.alias("assigned_to"))).alias("result")))
    with_text = F.to_json(F.struct(F.array(F.struct(*plain, "assigned_to")).alias("result")))
    rows.select(F.when(is_object, with_object).otherwise(with_text).alias("value")).write.text(path)
    return files.scan_json_envelope(spark, path, rows.schema)


@check(
    "sink_json",
    "SELECT assignment_group, count(*) AS n, 100::DOUBLE * count(*) / (SELECT count(*) FROM incidents) AS pct FROM incidents GROUP BY assignment_group",
)
def sink_json(spark, sf_dir):
    path = scratch_folder(spark, "analysis")
    shares = profile.distribution(views.incidents(spark, sf_dir, "assignment_group"), "assignment_group")
    files.sink_json(shares, path)
    return spark.read.schema(shares.schema).json(path)


@check(
    "sink_metrics_append",
    " UNION ALL ".join(
        f"""SELECT '{AS_OF}' AS timestamp, count(*) AS raw_record_count, count(*) AS processed_record_count,
                   7 AS columns_added, count(*) FILTER (active) AS active_incidents,
                   count(*) FILTER (high) AS high_impact_incidents, count(*) FILTER (breach) AS sla_breaches
            FROM enriched"""
        for _ in range(2)
    ),
)
def sink_metrics_append(spark, sf_dir):
    """Two runs leave two rows."""
    path = scratch_folder(spark, "metrics")
    metrics = run_metrics(spark, sf_dir)
    files.sink_metrics(metrics, path)
    files.sink_metrics(metrics, path)
    return spark.read.schema(metrics.schema).option("header", True).csv(path)


@check(
    "sink_reports",
    """SELECT number, 0::BIGINT AS part, number || '.md' AS file_name, 'markdown' AS format, summary AS report FROM summaries
       UNION ALL SELECT number, 0, number || '.txt', 'text', recommendations FROM advice""",
)
def sink_reports(spark, sf_dir):
    """Summaries and recommendations written as two formats, read back together."""
    path = scratch_folder(spark, "reports")
    # Stored, as both formats are made of it.
    found = stored(reports.summary_of(_analysis(spark, sf_dir), views.incidents(spark, sf_dir)), "summaries")
    for format, column in (("markdown", "summary"), ("text", "recommendations")):
        part = F.lit(0).cast("bigint").alias("part")
        files.sink_reports(found.select("number", part, F.col(column).alias("report")), path, format)
    schema = "number string, part bigint, report string, file_name string, format string"
    return spark.read.schema(schema).json(path)
