"""Incidents, problems and changes related to an incident."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.text import text_or
from ..functions.times import to_timestamp
from .timeline import top_rows

# Kind of record, and the column that says when it ended.
KINDS = {"incident": "resolved_at", "problem": "resolved_at", "change": "closed_at"}


def children_of(incidents: DataFrame) -> DataFrame:
    """Child incidents keyed by the sys_id of their parent."""
    return incidents.filter(F.col("parent") != "").select(
        F.col("parent").alias("sys_id"), *_record("resolved_at")
    )


def linked_to(records: DataFrame, ended: str) -> DataFrame:
    """Problems or changes keyed by each sys_id in their ``incidents`` list.

    The list is split into ids, so the link is an equality, and each id counts once.
    """
    listed = F.col("incidents")
    if not isinstance(records.schema["incidents"].dataType, ArrayType):
        listed = F.split(listed, ",")
    ids = F.array_distinct(F.transform(listed, lambda entry: F.trim(entry)))
    ids = F.filter(ids, lambda entry: entry != "")
    return records.select(F.explode(ids).alias("sys_id"), *_record(ended))


def _record(ended: str) -> list:
    return [
        F.col("number").alias("related_number"),
        "short_description",
        "priority",
        "state",
        to_timestamp("opened_at").alias("opened_at"),
        to_timestamp(ended).alias("ended_at"),
    ]


def _with_number(incidents: DataFrame, rows: DataFrame) -> DataFrame:
    joined = rows.join(incidents.select("sys_id", "number"), "sys_id")
    return joined.select("number", *[name for name in rows.columns if name != "sys_id"])


def related_incidents(incidents: DataFrame) -> DataFrame:
    return _with_number(incidents, children_of(incidents))


def related_problems(incidents: DataFrame, problems: DataFrame) -> DataFrame:
    return _with_number(incidents, linked_to(problems, KINDS["problem"]))


def related_changes(incidents: DataFrame, changes: DataFrame) -> DataFrame:
    return _with_number(incidents, linked_to(changes, KINDS["change"]))


def related_rows(incidents: DataFrame, problems: DataFrame, changes: DataFrame) -> DataFrame:
    """Related records of all kinds, keyed by sys_id."""
    parts = {
        "incident": children_of(incidents),
        "problem": linked_to(problems, KINDS["problem"]),
        "change": linked_to(changes, KINDS["change"]),
    }
    kinds = [rows.withColumn("kind", F.lit(kind)) for kind, rows in parts.items()]
    return reduce(DataFrame.unionByName, kinds)


def top_related(incidents: DataFrame, problems: DataFrame, changes: DataFrame, n: int = 5) -> DataFrame:
    """First n related records per sys_id and kind, in number order, cut for display."""
    return first_related(related_rows(incidents, problems, changes), n)


def first_related(rows: DataFrame, n: int = 5) -> DataFrame:
    """First n of related rows per sys_id and kind, in number order, cut for display."""
    return top_rows(shown_related(rows), ["sys_id", "kind"], ["related_number"], n, "position")


def shown_related(rows: DataFrame) -> DataFrame:
    """sys_id, kind, number and description of related rows, cut for display."""
    return rows.select(
        "sys_id",
        "kind",
        "related_number",
        F.substring(text_or("short_description"), 1, 60).alias("short_description"),
    )


def related_top(incidents: DataFrame, problems: DataFrame, changes: DataFrame, n: int = 5) -> DataFrame:
    """``top_related`` with incident numbers."""
    return _with_number(incidents, top_related(incidents, problems, changes, n))
