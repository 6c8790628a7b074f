"""Row selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.incident import priority_digit
from ..functions.times import to_timestamp
from ..sources.scratch import stored


def group_contains(word: str, column: str = "assignment_group") -> Column:
    """Condition: the group name holds the word, in any case."""
    return F.lower(F.col(column)).contains(word.lower())


def filter_group(df: DataFrame, word: str = "network") -> DataFrame:
    return df.filter(group_contains(word))


def filter_open(df: DataFrame, word: str = "network", closed: Sequence[str] = ("6", "Resolved")) -> DataFrame:
    """Incidents of matching groups whose state is none of the closed ones."""
    is_closed = F.coalesce(F.col("state").isin(*closed), F.lit(False))  # no state is not closed
    return df.filter(group_contains(word) & ~is_closed)


def filter_priority_in(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    return df.filter(F.col("priority").isin(*labels))


def filter_priority_at_most(df: DataFrame, digit: int) -> DataFrame:
    """Incidents at least as urgent as the priority with this digit."""
    return df.filter(priority_digit("priority") <= digit)


def filter_recent(
    df: DataFrame,
    days: int = 7,
    as_of: datetime | Column | None = None,
    limit: int | None = None,
    opened: str = "openedDate",
    key: str = "number",
) -> DataFrame:
    """Incidents opened in the last ``days`` days before ``as_of`` (default now).

    With a ``limit`` only the latest ones.
    """
    if as_of is None:
        as_of = F.localtimestamp()
    elif not isinstance(as_of, Column):
        as_of = to_timestamp(F.lit(as_of))
    start = as_of - F.make_dt_interval(F.lit(days))
    recent = df.filter(F.col(opened) >= start)
    return recent if limit is None else recent.orderBy(F.desc(opened), key).limit(limit)


def lookup_incident(df: DataFrame, wanted: str | Sequence[str] | DataFrame) -> DataFrame:
    """Incidents by number: one, a few, or all numbers of another table."""
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select("number").distinct(), "number", "left_semi")
    numbers = [wanted] if isinstance(wanted, str) else list(wanted)
    return df.filter(F.col("number").isin(*numbers))


def project_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The asked fields that exist, in the asked order."""
    return df.select(*[name for name in fields if name in df.columns])


def page_incidents(
    df: DataFrame, size: int, offset: int = 0, key: str = "number", after: str | None = None
) -> DataFrame:
    """One page in key order.

    ``after`` names the last key of the page before: deep pages then cost no more than the
    first, while an offset sorts and carries all rows up to its page.
    """
    rows = df if after is None else df.filter(F.col(key) > after)
    rows = rows.orderBy(key)
    return (rows.offset(offset) if offset else rows).limit(size)


def page_directory(df: DataFrame, size: int, key: str = "number") -> DataFrame:
    """page, first_key: with which key each page of ``size`` rows begins, pages counted from 0.

    The keys alone are sorted once, in ranges, and numbered by the rows of the ranges before.
    Stored next to the table, the directory makes every page a range of keys. Keys are unique;
    rows without one are on no page.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).repartitionByRange(key)
    keys = stored(keys.withColumn("_range", F.spark_partition_id()), "page-keys")
    ranges = keys.groupBy("_range").agg(F.count("*").alias("_n"))  # one row for each range
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    placed = keys.withColumn("_inside", inside).join(ranges.withColumn("_before", before), "_range")
    place = F.col("_before") + F.col("_inside")
    first = placed.filter(place % size == 0)
    return first.select(F.floor(place / size).cast("long").alias("page"), F.col(key).alias("first_key"))


def directory_page(df: DataFrame, directory: DataFrame, page: int, key: str = "number") -> DataFrame:
    """One page in key order: only the rows between two keys of the directory are read and sorted."""
    bounds = {r["page"]: r["first_key"] for r in directory.filter(F.col("page").isin(page, page + 1)).collect()}
    if page not in bounds:
        return df.limit(0)
    rows = df.filter(F.col(key) >= bounds[page])
    if page + 1 in bounds:
        rows = rows.filter(F.col(key) < bounds[page + 1])
    return rows.orderBy(key)


def preview_incidents(df: DataFrame, rows: int = 3, width: int = 50) -> DataFrame:
    """First incidents with the description cut; ``N/A`` for missing values."""

    def shown(name: str) -> Column:
        value = F.col(name) if name in df.columns else F.lit(None).cast("string")
        return F.coalesce(value, F.lit("N/A"))

    return (
        df.orderBy("number")
        .limit(rows)
        .select(
            shown("number").alias("number"),
            F.substring(shown("short_description"), 1, width).alias("short_description"),
            shown("priority").alias("priority"),
            shown("state").alias("state"),
        )
    )
