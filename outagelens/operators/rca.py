"""Root-cause analysis of all incidents at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cause
from ..functions import fixed_values as fixed
from ..functions.text import first_text, text_or
from ..functions.times import hours_between, to_timestamp
from ..sources.scratch import stored
from .packing import bucketed_table, by_key, ordered_list
from .related import linked_to
from .skew import PIECE_BYTES, PIECE_ROWS, ordered_pieces
from .timeline import incident_journal, optional

NOTE_KINDS = ("work_notes", "comments")


def journal_digest(journal: DataFrame) -> DataFrame:
    """What the analysis asks of the journal, one row per sys_id; counts combine before the shuffle.

    Entries, work notes, first and last time, bytes of text, and whether a text could hold the
    cause phrase or begin it at its very end. One scan; columns that are not asked for cost nothing.
    """
    text = F.lower(text_or("value"))
    start = fixed.CAUSE_PHRASE.split(" ")[0]
    possible = F.col("element").isin(*NOTE_KINDS) & (text.contains(fixed.CAUSE_PHRASE) | text.endswith(start))
    return (
        incident_journal(journal)
        .groupBy(F.col("element_id").alias("sys_id"))
        .agg(
            F.count("*").alias("n_entries"),
            F.count_if(F.col("element") == NOTE_KINDS[0]).alias("n_work_notes"),
            F.min("sys_created_on").alias("first_entry"),
            F.max("sys_created_on").alias("last_entry"),
            F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("n_bytes"),
            F.coalesce(F.bool_or(possible), F.lit(False)).alias("possible"),
        )
    )


def stored_digest(journal: DataFrame) -> DataFrame:
    """The digest as a table, for steps that read it several times."""
    return stored(journal_digest(journal), "journal-digest")


def any_long(digest: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> bool:
    """Whether the digest knows an incident with more entries or bytes of text than one array should hold."""
    return not digest.filter((F.col("n_entries") > piece_rows) | (F.col("n_bytes") > piece_bytes)).isEmpty()


SENTENCE_ORDER = ("kind", "sys_created_on", "entry_id")


def sentence_states(journal: DataFrame, digest: DataFrame) -> DataFrame:
    """Notes of incidents whose sentence is possible, each reduced to what its neighbours need."""
    keys = digest.filter("possible").select("sys_id")
    notes = incident_journal(journal).filter(F.col("element").isin(*NOTE_KINDS)).select(
        F.col("element_id").alias("sys_id"),
        (F.col("element") != NOTE_KINDS[0]).alias("kind"),
        "sys_created_on",
        "entry_id",
        text_or("value").alias("text"),
    )
    reduced = notes.join(keys, "sys_id", "left_semi").withColumn("pieces", cause.sentence_pieces(F.lower("text")))
    return reduced.select("sys_id", *SENTENCE_ORDER, cause.reduced_text(F.col("pieces")).alias("text"))


def cause_sentences(
    journal: DataFrame, piece_rows: int = PIECE_ROWS, digest: DataFrame | None = None, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """First sentence with the cause phrase per sys_id, over notes and then comments.

    A sentence may run over several notes. Only incidents that the digest holds possible take
    part; their notes are reduced before they move. If the digest knows no incident with more
    than ``piece_rows`` entries or ``piece_bytes``, the notes of each are joined in order. Else
    all are sorted once into ranges of (sys_id, order), joined within bounded pieces of a range,
    and the pieces and ranges of a key are merged: the same way for every key, so one that holds
    most notes spreads over as many ranges as it fills. Both ways read the notes once.
    """
    digest = stored_digest(journal) if digest is None else digest
    states = sentence_states(journal, digest)
    joined = F.array_join(ordered_list(SENTENCE_ORDER, F.col("text")), " ")
    pieces = cause.sentence_pieces(joined).alias("pieces")
    if not any_long(digest.filter("possible"), piece_rows, piece_bytes):
        whole = by_key(states, "sys_id").groupBy("sys_id").agg(pieces)
    else:
        # Stored, as the bounds of the ranges are found by one more read.
        states = stored(states, "sentence-states")
        ranged = ordered_pieces(states, "sys_id", SENTENCE_ORDER, piece_rows, piece_bytes)
        ranged = ranged.groupBy("sys_id", "_range", "_piece").agg(pieces)
        whole = _merge(_merge(ranged, ["sys_id", "_range"], "_piece"), ["sys_id"], "_range")
    found = whole.select("sys_id", cause.sentence_of_pieces(F.col("pieces")).alias("sentence"))
    return found.filter(F.col("sentence").isNotNull())


def _merge(pieces: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Merge neighbouring pieces of a key, in order, into one."""
    in_order = ordered_list([order], F.col("pieces"))
    merged = F.aggregate(
        F.slice(in_order, F.lit(2), F.greatest(F.size(in_order) - 1, F.lit(0))),
        F.element_at(in_order, 1),
        cause.join_pieces,
    )
    return pieces.groupBy(*keys).agg(merged.alias("pieces"))


def cause_from_problems(problems: DataFrame) -> DataFrame:
    """Cause text from the first related problem, by number, per sys_id."""
    rows = linked_to(problems, "resolved_at")
    first = F.min_by("short_description", "related_number")
    return rows.groupBy("sys_id").agg(cause.cause_from_problem(first).alias("problem_cause"))


def note_cause(incidents: DataFrame):
    """Cause by the closing notes, as a Column over the incident table."""
    return cause.cause_from_notes(
        first_text(optional(incidents, "resolution_notes"), optional(incidents, "close_notes"))
    )


def root_causes(
    incidents: DataFrame,
    journal: DataFrame,
    problems: DataFrame,
    piece_rows: int = PIECE_ROWS,
    digest: DataFrame | None = None,
) -> DataFrame:
    """number, sys_id and root cause of every incident."""
    return (
        incidents.join(cause_sentences(journal, piece_rows, digest), "sys_id", "left")
        .join(cause_from_problems(problems), "sys_id", "left")
        .select(
            "number",
            "sys_id",
            F.coalesce(
                note_cause(incidents),
                "sentence",
                "problem_cause",
                cause.cause_from_description("description", "short_description"),
            ).alias("root_cause"),
        )
    )


def with_event_stats(incidents: DataFrame, digest: DataFrame) -> DataFrame:
    """Incidents with number of work notes and the span of their timeline in hours.

    The span is NULL for timelines of fewer than two events.
    """
    opened, resolved = to_timestamp("opened_at"), to_timestamp("resolved_at")
    rows = incidents.join(digest.select("sys_id", "n_entries", "n_work_notes", "first_entry", "last_entry"), "sys_id", "left")
    events = (
        F.coalesce("n_entries", F.lit(0))
        + opened.isNotNull().cast("int")
        + resolved.isNotNull().cast("int")
    )
    first = F.least("first_entry", opened, resolved)
    last = F.greatest("last_entry", opened, resolved)
    return rows.withColumns(
        {
            "n_work_notes": F.coalesce("n_work_notes", F.lit(0).cast("bigint")),
            "span_hours": F.when(events > 1, hours_between(first, last)),
        }
    ).drop("n_entries", "first_entry", "last_entry")


def factor_list():
    return cause.contributing_factors("reassignment_count", "span_hours", "n_work_notes")


def contributing_factors(incidents: DataFrame, journal: DataFrame) -> DataFrame:
    return with_event_stats(incidents, journal_digest(journal)).select(
        "number", "sys_id", factor_list().alias("contributing_factors")
    )


def duration_hours(incidents: DataFrame):
    """Hours from opening to resolution, or to closing if there is no resolution."""
    ended = F.coalesce(
        to_timestamp("resolved_at"), to_timestamp(optional(incidents, "closed_at"))
    )
    return hours_between(to_timestamp("opened_at"), ended)


def detection_times(events: DataFrame) -> DataFrame:
    """First event about an assignment or work, and first event of all, per sys_id.

    ``events`` holds sys_id, timestamp and event_type. NULL for fewer than two events.
    """
    kind = F.lower("event_type")
    working = kind.contains("assignment") | kind.contains("work")
    first = F.min("timestamp")
    return events.groupBy("sys_id").agg(
        F.when(
            F.count("*") > 1, hours_between(first, F.min(F.when(working, F.col("timestamp"))))
        ).alias("detection_hours")
    )


def time_to_detection(incidents: DataFrame, events: DataFrame) -> DataFrame:
    """Hours to detection of incidents that have ended; NULL for the others."""
    rows = incidents.join(detection_times(events), "sys_id", "left")
    ended = duration_hours(incidents).isNotNull()
    return rows.select(
        "number", "sys_id", F.when(ended, F.col("detection_hours")).alias("detection_hours")
    )


def rca_analysis(
    incidents: DataFrame,
    journal: DataFrame,
    problems: DataFrame,
    landed_events: DataFrame | None = None,
    piece_rows: int = PIECE_ROWS,
    digest: DataFrame | None = None,
) -> DataFrame:
    """One row per incident: root cause, factors, impact, duration, justification.

    All inputs are reduced to one row per incident before they are joined. The journal is read
    once for its digest, unless that is given, and once for the notes that may tell a cause.
    ``landed_events`` may bring event types that tell when work began.
    """
    return analysed(_gathered(incidents, journal, problems, landed_events, piece_rows, digest))


def analysed_incidents(
    incidents: DataFrame,
    journal: DataFrame,
    problems: DataFrame,
    landed_events: DataFrame | None = None,
    piece_rows: int = PIECE_ROWS,
    digest: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The incidents and their analysis, stored side by side in buckets of sys_id.

    Both are read from one table, so they and what is gathered by sys_id meet without moving once
    more. The table's entry stands in the session's catalog until the session ends.
    """
    rows = _gathered(incidents, journal, problems, landed_events, piece_rows, digest)
    name = bucketed_table(analysed(rows, F.struct(*incidents.columns).alias("_incident")), "sys_id", "analysis", joined=True)
    both = incidents.sparkSession.table(name)
    record = [F.col("sys_id" if name == "sys_id" else f"_incident.{name}").alias(name) for name in incidents.columns]
    return both.select(*record), both.drop("_incident")


def _gathered(
    incidents: DataFrame,
    journal: DataFrame,
    problems: DataFrame,
    landed_events: DataFrame | None,
    piece_rows: int,
    digest: DataFrame | None,
) -> DataFrame:
    """Each incident with what its analysis asks for."""
    digest = stored_digest(journal) if digest is None else digest
    rows = (
        with_event_stats(incidents, digest)
        .join(cause_sentences(journal, piece_rows, digest), "sys_id", "left")
        .join(cause_from_problems(problems), "sys_id", "left")
    )
    if landed_events is None:
        return rows.withColumn("detection_hours", F.lit(None).cast("double"))
    return rows.join(detection_times(landed_events), "sys_id", "left")


def analysed(rows: DataFrame, *more: Column) -> DataFrame:
    """The analysis of each row, an incident with what was gathered about it, and ``more`` of its columns.

    That is n_work_notes, span_hours, sentence, problem_cause and detection_hours; no other row
    is needed, so it applies to batches and streams alike.
    """
    rows = rows.withColumns(
        {
            "_hours": duration_hours(rows),
            "_users": cause.affected_users(
                "description", "short_description", cause.default_users("priority", "impact")
            ),
        }
    )
    hours = F.col("_hours")
    detection = F.when(hours.isNotNull(), F.col("detection_hours"))
    impact = F.struct(
        cause.business_impact("priority", "impact").alias("business_impact"),
        cause.technical_impact("cmdb_ci", "category").alias("technical_impact"),
        cause.user_impact("_users").alias("user_impact"),
        F.col("_users").alias("affected_users_estimate"),
    )
    duration = F.struct(
        cause.hours_text(detection).alias("time_to_detection"),
        cause.hours_text(hours).alias("time_to_resolution"),
        cause.hours_text(hours).alias("total_downtime"),
        cause.resolution_efficiency(hours).alias("resolution_efficiency"),
        detection.alias("detection_hours"),
        hours.alias("resolution_hours"),
    )
    return rows.select(
        "number",
        "sys_id",
        F.coalesce(
            note_cause(rows),
            "sentence",
            "problem_cause",
            cause.cause_from_description("description", "short_description"),
        ).alias("root_cause"),
        factor_list().alias("contributing_factors"),
        impact.alias("impact_assessment"),
        duration.alias("duration_analysis"),
        cause.priority_justification("priority", "impact", "urgency").alias(
            "priority_justification"
        ),
        *more,
    )


def analysis_as_landed(incidents: DataFrame) -> DataFrame:
    """The analysis of incidents by themselves, as they land: no journal, no problems.

    The cause comes from closing notes or descriptions, factors from reassignments alone.
    """
    unknown = {"sentence": "string", "problem_cause": "string", "span_hours": "double", "detection_hours": "double"}
    rows = incidents.withColumns({name: F.lit(None).cast(kind) for name, kind in unknown.items()})
    return analysed(rows.withColumn("n_work_notes", F.lit(0).cast("bigint")))
