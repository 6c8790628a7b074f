"""Root-cause reports of all incidents: Markdown, plain text and JSON."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import report_text as rt
from ..functions.text import display_value, join_lines, text_or
from ..functions.times import timestamp_text, to_timestamp
from .bundle import RELATED, incident_bundle, laid_bundle
from .layout import Laid, Layout
from .packing import by_key, ordered_list
from .rca import analysed_incidents, any_long, stored_digest
from .related import first_related, shown_related, top_related
from .skew import PIECE_ROWS
from .timeline import EVENT_ORDER, event_rows, first_events, more_events, optional, shown_event, top_events

TIMELINE_ROWS = 20
RELATED_ROWS = 5
GENERATOR = "incident RCA job"

TIMELINE_HEADER = "| Timestamp | Event Type | Actor | Description |\n|-----------|------------|-------|-------------|"
RELATED_TITLES = {
    "incident": "Related Incidents", "problem": "Related Problems", "change": "Related Changes"
}


def _clock(as_of: datetime | Column | None) -> Column:
    if as_of is None:
        return F.localtimestamp()
    return as_of if isinstance(as_of, Column) else to_timestamp(F.lit(as_of))


def summary_of(analysis: DataFrame, incidents: DataFrame) -> DataFrame:
    """Executive summary and recommendations next to the analysis of each incident."""
    named = incidents.select("sys_id", "short_description", "priority")
    return analysis.join(named, "sys_id").select(
        "number", executive_summary().alias("summary"), advice().alias("recommendations")
    )


def executive_summary() -> Column:
    return rt.executive_summary(
        "number", "short_description", "priority", "root_cause",
        "impact_assessment.business_impact", "impact_assessment.user_impact",
        "duration_analysis.time_to_resolution",
    )


def advice() -> Column:
    return rt.recommendations(
        "root_cause", "duration_analysis.resolution_efficiency", "contributing_factors"
    )


def _event_line(shown: str | None = None) -> Column:
    """The table row of an event as it is shown, of columns or of the struct of that name."""
    values = [F.col(f"{shown}.{name}" if shown else name) for name in ("timestamp", "event_type", "actor", "description")]
    return F.concat(F.lit("| "), *[part for value in values for part in (value, F.lit(" | "))][:-1], F.lit(" |"))


def _timeline_blocks(incidents: DataFrame, journal: DataFrame, digest: DataFrame) -> DataFrame:
    """Table rows of the first events per sys_id; at most ``TIMELINE_ROWS`` + 1 each.

    If the digest knows an incident too long for one array, each task first cuts its events to
    the first ones. Else the lines go to their incident as they are and are gathered in one pass.
    """
    if any_long(digest):
        return top_events(incidents, journal, TIMELINE_ROWS, digest).groupBy("sys_id").agg(
            F.array_join(ordered_list(["position"], _event_line()), "\n").alias("timeline_block")
        )
    events = event_rows(incidents, journal).select("sys_id", *EVENT_ORDER, "event_type", *shown_event()[2:])
    more = more_events(incidents, digest, TIMELINE_ROWS).select("sys_id", _event_line().alias("_more"))
    rows = by_key(events.unionByName(more, allowMissingColumns=True).filter(F.col("sys_id").isNotNull()), "sys_id")
    rows = _event_lines(rows, "_more")
    line = F.when(F.col("_more").isNull(), F.struct(*EVENT_ORDER, "_line"))
    both = F.concat(_first_lines(line), F.sort_array(F.collect_list("_more")))
    return rows.groupBy("sys_id").agg(F.array_join(both, "\n").alias("timeline_block"))


def _event_lines(events: DataFrame, *more: str) -> DataFrame:
    """sys_id, the columns of the order and the table row of each event, and ``more`` columns."""
    shown = events.select("sys_id", *EVENT_ORDER, F.struct(*shown_event()).alias("_shown"), *more)
    return shown.select("sys_id", *EVENT_ORDER, _event_line("_shown").alias("_line"), *more)


def _first_lines(line: Column) -> Column:
    """Aggregate: the first table rows in order, of structs that end in ``_line``."""
    return F.slice(F.sort_array(F.collect_list(line))["_line"], 1, TIMELINE_ROWS)


def _laid_timeline_blocks(laid: Laid, digest: DataFrame, whole: bool) -> DataFrame:
    """The same of stored events: ranked and gathered where they lie; ``whole`` if each incident's fit one array."""
    if whole:
        lines = by_key(_event_lines(laid.lists["timeline"]), "sys_id", placed=True)
        first = lines.groupBy("sys_id").agg(F.array_join(_first_lines(F.struct(*EVENT_ORDER, "_line")), "\n").alias("_lines"))
    else:
        lines = F.array_join(ordered_list(["position"], _event_line()), "\n").alias("_lines")
        first = first_events(laid.lists["timeline"], TIMELINE_ROWS).groupBy("sys_id").agg(lines)
    more = more_events(laid.incidents, digest, TIMELINE_ROWS).select("sys_id", _event_line().alias("_more"))
    return first.join(more, "sys_id", "left").select("sys_id", F.concat_ws("\n", "_lines", "_more").alias("timeline_block"))


def _kind_block(kind: str) -> Column:
    """Aggregate: the bullets of one kind's first records."""
    mine = F.when(F.col("kind") == kind, F.struct("position", _related_line().alias("_line")))
    lines = F.sort_array(F.collect_list(mine))["_line"]
    return F.when(F.count_if(F.col("kind") == kind) > 0, _titled(kind, lines)).alias(f"{kind}_block")


def _related_line() -> Column:
    return rt.bullet(F.concat("related_number", F.lit(": "), "short_description"))


def _titled(kind: str, lines: Column) -> Column:
    return join_lines([F.lit(f"**{RELATED_TITLES[kind]}:**"), F.array_join(lines, "\n"), F.lit("")])


def _related_blocks(incidents: DataFrame, problems: DataFrame, changes: DataFrame) -> DataFrame:
    """Bullets of related records per sys_id; at most ``RELATED_ROWS`` of each kind."""
    rows = top_related(incidents, problems, changes, RELATED_ROWS)
    return rows.groupBy("sys_id").agg(*[_kind_block(kind) for kind in RELATED_TITLES])


def _laid_related_blocks(laid: Laid, whole: bool) -> list[DataFrame]:
    """The same of stored records, a table for each kind."""
    rows = {kind: laid.lists[f"related_{kind}s"].withColumn("kind", F.lit(kind)) for kind in RELATED_TITLES}
    if not whole:
        return [first_related(some, RELATED_ROWS).groupBy("sys_id").agg(_kind_block(kind)) for kind, some in rows.items()]
    blocks = []
    for kind, some in rows.items():
        lines = by_key(shown_related(some).select("sys_id", "related_number", _related_line().alias("_line")), "sys_id", placed=True)
        first = F.slice(F.sort_array(F.collect_list(F.struct("related_number", "_line")))["_line"], 1, RELATED_ROWS)
        blocks.append(lines.groupBy("sys_id").agg(_titled(kind, first).alias(f"{kind}_block")))
    return blocks


def report_markdown(
    incidents: DataFrame,
    journal: DataFrame,
    problems: DataFrame,
    changes: DataFrame,
    analysis: DataFrame | None = None,
    as_of: datetime | Column | None = None,
    generator: str = GENERATOR,
    landed_events: DataFrame | None = None,
    digest: DataFrame | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """number, part (always 0) and the Markdown report of every incident.

    The analysis is stored first unless it is given: its texts appear in several sections
    and would be built anew for each. The journal's digest serves analysis and timeline. A
    ``layout`` with an analysis stands for all tables but the digest.
    """
    digest = stored_digest(journal) if digest is None else digest
    if layout is not None:
        laid = {True: layout.usual, False: layout.long}
        made = [_laid_markdown(some, digest, as_of, generator, whole) for whole, some in laid.items() if some is not None]
        return reduce(DataFrame.unionByName, made)
    records = incidents
    if analysis is None:
        records, analysis = analysed_incidents(incidents, journal, problems, landed_events, digest=digest)
    rows = (
        records.join(analysis.drop("number"), "sys_id")
        .join(_timeline_blocks(incidents, journal, digest), "sys_id", "left")
        .join(_related_blocks(incidents, problems, changes), "sys_id", "left")
    )
    return _as_markdown(rows, as_of, generator)


def _laid_markdown(laid: Laid, digest: DataFrame, as_of: datetime | Column | None, generator: str, whole: bool) -> DataFrame:
    rows = laid.incidents.join(laid.analysis.drop("number"), "sys_id")
    blocks = [_laid_timeline_blocks(laid, digest, whole), *_laid_related_blocks(laid, whole)]
    return _as_markdown(reduce(lambda left, right: left.join(right, "sys_id", "left"), blocks, rows), as_of, generator)


def _as_markdown(rows: DataFrame, as_of: datetime | Column | None, generator: str) -> DataFrame:
    """The report of each row: an incident with its analysis and its blocks."""
    clock = timestamp_text(_clock(as_of))

    def shown(name: str) -> Column:
        return text_or(name, "N/A")

    def detail(label: str, value: Column) -> Column:
        return rt.bullet(rt.labelled(label, value))

    def spaced(*blocks: Column) -> list[Column]:
        return [part for block in blocks for part in (block, F.lit(""))][:-1]

    factors = F.col("contributing_factors")
    impact = F.col("impact_assessment")
    duration = F.col("duration_analysis")
    ended = F.coalesce(to_timestamp("resolved_at"), to_timestamp(optional(rows, "closed_at")))
    factor_block = F.when(
        F.size(factors) > 0,
        join_lines([
            F.lit(""),
            F.lit("**Contributing Factors:**"),
            F.lit(""),
            F.array_join(F.transform(factors, rt.bullet), "\n"),
        ]),
    )
    related = [F.col(f"{kind}_block") for kind in RELATED_TITLES]
    blocks = [
        F.lit("# Root Cause Analysis Report\n"),
        rt.labelled("Incident Number", shown("number")),
        rt.labelled("Report Generated", clock),
        F.lit("\n---\n"),
        rt.section("Executive Summary", executive_summary()),
        rt.section(
            "Incident Details",
            detail("Title", shown("short_description")),
            detail("Priority", shown("priority")),
            detail("Impact", shown("impact")),
            detail("Urgency", shown("urgency")),
            detail("State", shown("state")),
            detail("Category", shown("category")),
            detail("Assignment Group", display_value("assignment_group", "N/A", empty="N/A")),
            detail("Opened", F.coalesce(timestamp_text(to_timestamp("opened_at")), F.lit("N/A"))),
            detail("Resolved", F.coalesce(timestamp_text(ended), F.lit("N/A"))),
        ),
        rt.section(
            "Root Cause Analysis",
            F.lit("**Identified Root Cause:**\n"),
            shown("root_cause"),
            factor_block,
        ),
        rt.section(
            "Impact Assessment",
            *spaced(
                rt.labelled("Business Impact", impact["business_impact"]),
                rt.labelled("Technical Impact", impact["technical_impact"]),
                rt.labelled("User Impact", impact["user_impact"]),
            ),
        ),
        rt.section(
            "Duration Analysis",
            detail("Time to Detection", duration["time_to_detection"]),
            detail("Time to Resolution", duration["time_to_resolution"]),
            detail("Total Downtime", duration["total_downtime"]),
            detail("Resolution Efficiency", F.nullif(duration["resolution_efficiency"], F.lit(""))),
        ),
        rt.section("Priority Classification", F.col("priority_justification")),
        F.when(
            F.col("timeline_block").isNotNull(),
            rt.section("Timeline of Events", F.lit(TIMELINE_HEADER), F.col("timeline_block")),
        ),
        F.when(
            F.coalesce(*related).isNotNull(),
            join_lines([F.lit("## Related Records\n"), *related]),
        ),
        rt.section("Recommendations", advice()),
        F.lit("---\n"),
        F.concat(F.lit(f"*Report generated by {generator} on "), clock, F.lit("*")),
    ]
    return rows.select("number", F.lit(0).cast("bigint").alias("part"), join_lines(blocks).alias("report"))


def report_text(*tables: DataFrame, markdown: DataFrame | None = None, **options) -> DataFrame:
    """The Markdown reports as plain text; same arguments as ``report_markdown``.

    ``markdown`` holds reports (number, part, report) made before, which are not built again.
    """
    made = report_markdown(*tables, **options) if markdown is None else markdown
    return made.select("number", "part", rt.plain_text("report").alias("report"))


def report_json(
    incidents: DataFrame,
    journal: DataFrame,
    problems: DataFrame,
    changes: DataFrame,
    analysis: DataFrame | None = None,
    as_of: datetime | Column | None = None,
    piece_rows: int = PIECE_ROWS,
    landed_events: DataFrame | None = None,
    digest: DataFrame | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """number, part and one JSON document per row.

    Part 0 is the report. Lists too long for one document go on in documents of parts 1, 2,
    ..., see ``incident_bundle``; each of these holds entries of some list. ``lists`` tells the
    part, how many parts there are, and in part 0 how long the lists are over all parts. A
    ``layout`` with an analysis stands for all tables.
    """
    if layout is not None:
        return _as_json(laid_bundle(layout, _results, piece_rows), as_of)
    if analysis is None:
        incidents, analysis = analysed_incidents(incidents, journal, problems, landed_events, piece_rows, digest)
    bundle = incident_bundle(incidents, journal, problems, changes, piece_rows, _results(analysis), ("timeline", *RELATED))
    return _as_json(bundle, as_of)


def _results(analysis: DataFrame) -> DataFrame:
    """The analysis per sys_id as it stands in the document."""
    return analysis.select(
        "sys_id",
        F.struct(
            "root_cause",
            "contributing_factors",
            "impact_assessment",
            F.col("duration_analysis")
            .dropFields("detection_hours", "resolution_hours")
            .alias("duration_analysis"),
            "priority_justification",
        ).alias("analysis"),
    )


def _as_json(bundle: DataFrame, as_of: datetime | Column | None) -> DataFrame:
    document = F.struct(
        F.struct(
            F.date_format(_clock(as_of), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
            F.col("number").alias("incident_number"),
        ).alias("metadata"),
        "incident",
        "analysis",
        "timeline",
        F.struct(
            F.col("related_incidents").alias("incidents"),
            F.col("related_problems").alias("problems"),
            F.col("related_changes").alias("changes"),
        ).alias("related_records"),
        F.struct("part", "parts", "totals").alias("lists"),
    )
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    return bundle.select("number", "part", F.to_json(document, options).alias("report"))


FORMATS = {"markdown": report_markdown, "json": report_json, "text": report_text}


def generate_report(format: str, *tables: DataFrame, **options) -> DataFrame:
    """Reports in the named format."""
    try:
        build = FORMATS[format.lower()]
    except KeyError:
        raise ValueError(f"Unsupported format: {format}") from None
    return build(*tables, **options)
