"""Journal joins, notes, comments and the timeline of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import display_value, text_or
from ..functions.times import timestamp_text, to_timestamp

INCIDENT_TABLE = "incident"


def optional(df: DataFrame, name: str) -> Column:
    """The column, or NULL text if the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def incident_journal(journal: DataFrame) -> DataFrame:
    """Journal entries about incidents, with a typed time and a unique ``entry_id``.

    Without an ``entry_id`` column, entries of the same second are told apart by their
    content.
    """
    entry_id = (
        F.col("entry_id")
        if "entry_id" in journal.columns
        else F.hex(F.xxhash64("element_id", "sys_created_on", "element", "value"))
    )
    about = (F.col("name") == INCIDENT_TABLE) & (F.col("element_id") != "")  # entries of no incident go
    return journal.filter(about).withColumns(
        {"entry_id": entry_id, "sys_created_on": to_timestamp("sys_created_on")}
    )


def join_journal(incidents: DataFrame, journal: DataFrame) -> DataFrame:
    """Each incident with its journal entries; incidents without entries stay, once.

    The inner join may split a hot incident over several tasks, which an outer join with
    the journal on the inner side may not. Incidents without entries come from an anti
    join with the distinct keys.
    """
    entries = incident_journal(journal).select(
        F.col("element_id").alias("sys_id"), "entry_id", "sys_created_on", "element", "value"
    )
    ids = incidents.select("number", "sys_id")
    silent = ids.join(entries.select("sys_id").distinct(), "sys_id", "left_anti")
    return ids.join(entries, "sys_id").unionByName(silent, allowMissingColumns=True)


def notes_of(journal: DataFrame, element: str) -> DataFrame:
    """Entries of one kind: sys_id, timestamp, entry_id, author, text."""
    entries = incident_journal(journal).filter(F.col("element") == element)
    return entries.select(
        F.col("element_id").alias("sys_id"),
        F.col("sys_created_on").alias("timestamp"),
        "entry_id",
        note_author(entries).alias("author"),
        text_or("value").alias("text"),
    )


def note_author(entries: DataFrame) -> Column:
    return display_value("author" if "author" in entries.columns else "element", "Unknown")


def _of_incidents(incidents: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.join(incidents.select("sys_id", "number"), "sys_id")


def work_notes(incidents: DataFrame, journal: DataFrame) -> DataFrame:
    """One row per work note of an incident, to be read in (timestamp, entry_id) order."""
    rows = _of_incidents(incidents, notes_of(journal, "work_notes"))
    return rows.select("number", "timestamp", "entry_id", "author", F.col("text").alias("note"))


def comments(incidents: DataFrame, journal: DataFrame) -> DataFrame:
    """One row per comment of an incident, to be read in (timestamp, entry_id) order."""
    rows = _of_incidents(incidents, notes_of(journal, "comments"))
    return rows.select("number", "timestamp", "entry_id", "author", F.col("text").alias("comment"))


# Order of events: by time, then creation before entries before resolution.
EVENT_ORDER = ("timestamp", "seq", "entry_id")


def event_rows(incidents: DataFrame, journal: DataFrame, notes: Sequence[str] = ()) -> DataFrame:
    """Created, journal and resolved events, keyed by sys_id, without a join.

    Each table is read once: an incident row unfolds into its two events. Events that are notes of
    the named kinds also have ``element``, ``author`` and the whole ``text``; these are NULL for others.
    """

    def event(seq, entry_id, timestamp, event_type, actor, description, details) -> list[Column]:
        return [
            to_timestamp(timestamp).alias("timestamp"),
            F.lit(seq).alias("seq"),
            entry_id.alias("entry_id"),
            F.lit(event_type).alias("event_type"),
            actor.alias("actor"),
            description.alias("description"),
            details.alias("details"),
        ]

    created = event(
        0, F.lit(""), "opened_at", "Incident Created",
        display_value("caller_id", "Unknown"),
        F.concat(F.lit("Incident "), F.col("number"), F.lit(" created")),
        text_or("short_description"),
    )
    closing = F.coalesce(
        optional(incidents, "resolution_notes"), optional(incidents, "close_notes"), F.lit("")
    )
    resolved = event(
        2, F.lit(""), "resolved_at", "Incident Resolved",
        display_value("assigned_to", "Unknown"), F.lit("Incident resolved"), closing,
    )
    ends = incidents.select(
        "sys_id", F.inline(F.array(F.struct(*created), F.struct(*resolved)))
    ).filter(F.col("timestamp").isNotNull())
    entries = incident_journal(journal)
    note = F.col("element").isin(*notes)
    as_note = {"element": F.col("element"), "author": note_author(entries), "text": text_or("value")}
    logged = entries.select(
        F.col("element_id").alias("sys_id"),
        *event(
            1, F.col("entry_id"), "sys_created_on", "Journal Entry",
            display_value("element", "System"),
            F.substring(text_or("value"), 1, 200),
            F.col("name"),
        ),
        *[F.when(note, value).alias(name) for name, value in as_note.items() if notes],
    )
    return ends.unionByName(logged, allowMissingColumns=True)


def timeline(incidents: DataFrame, journal: DataFrame) -> DataFrame:
    """All events of all incidents, one row each, to be read in ``EVENT_ORDER``."""
    return _of_incidents(incidents, event_rows(incidents, journal)).select(
        "number", *EVENT_ORDER, "event_type", "actor", "description", "details"
    )


def top_rows(rows: DataFrame, keys: list[str], order: list, n: int, name: str) -> DataFrame:
    """First n rows per key. Spark keeps at most n rows per key and task before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(name, rank).filter(F.col(name) <= n)


def entry_counts(journal: DataFrame) -> DataFrame:
    """sys_id, n_entries; of the journal only the keys are read."""
    about = incident_journal(journal)
    return about.groupBy(F.col("element_id").alias("sys_id")).agg(F.count("*").alias("n_entries"))


def first_events(events: DataFrame, n: int = 20) -> DataFrame:
    """First n events per sys_id, cut for display."""
    return top_rows(events, ["sys_id"], list(EVENT_ORDER), n, "position").select("sys_id", "position", *shown_event())


def shown_event() -> list[Column]:
    """timestamp, event_type, actor and description of an event, cut for display."""
    return [
        F.coalesce(timestamp_text("timestamp"), F.lit("N/A")).alias("timestamp"),
        F.col("event_type"),
        F.substring("actor", 1, 30).alias("actor"),
        F.substring("description", 1, 50).alias("description"),
    ]


def more_events(incidents: DataFrame, counts: DataFrame, n: int = 20) -> DataFrame:
    """One row per sys_id with more than n events, telling how many follow.

    How many there are follows from the incident and from ``counts`` (sys_id, n_entries) of its
    journal. An incident brings two events at most, so the others' counts must tell of more than
    n - 2 entries.
    """
    ends = [to_timestamp(name).isNotNull().cast("int") for name in ("opened_at", "resolved_at")]
    entries = counts.select("sys_id", "n_entries")
    if n >= len(ends):
        both = incidents.join(entries.filter(F.col("n_entries") > n - len(ends)), "sys_id")
    else:
        both = incidents.join(entries, "sys_id", "left")
    both = both.select(
        "sys_id", sum(ends, F.coalesce("n_entries", F.lit(0))).alias("_events")
    )
    dots = F.lit("...")
    return both.filter(F.col("_events") > n).select(
        "sys_id",
        F.lit(n + 1).alias("position"),
        dots.alias("timestamp"),
        dots.alias("event_type"),
        dots.alias("actor"),
        F.concat(
            F.lit("*("), (F.col("_events") - n).cast("string"), F.lit(" more events)*")
        ).alias("description"),
    )


def top_events(incidents: DataFrame, journal: DataFrame, n: int = 20, counts: DataFrame | None = None) -> DataFrame:
    """First n events per sys_id, and one row telling how many follow; the events are made once."""
    counts = entry_counts(journal) if counts is None else counts
    return first_events(event_rows(incidents, journal), n).unionByName(more_events(incidents, counts, n))


def timeline_top(incidents: DataFrame, journal: DataFrame, n: int = 20) -> DataFrame:
    """``top_events`` with incident numbers; few rows per incident reach the join."""
    return _of_incidents(incidents, top_events(incidents, journal, n)).drop("sys_id")
