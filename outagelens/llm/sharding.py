"""Contiguous shards of near-equal bytes.

Rows are put in one global order over many range partitions. Each partition's total, and the
totals before it, turn a running sum inside the partition into a global prefix sum. The line
of all bytes is cut at equal targets; a row goes to the shard that holds its middle byte, so
two shards differ by about one row at most. No task sees more than one range of the order.

Only DataFrame functions are used: there is no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, kept

#: Rows that one range of the global order holds, about, as long as there are no more than so many ranges.
ROWS_PER_RANGE = 50_000
MOST_RANGES = 10_000


def byte_shards(
    rows: DataFrame,
    order: Sequence[str],
    size: str = "size",
    shards: int = 24,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The rows with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``order`` names the columns of the global order; nulls come first. Ties are harmless: the
    range a row lands in and its place there are fixed by a table written once, and rows that
    agree in all of ``order`` are interchangeable. ``size`` is a non-null long. An empty table
    gives an empty table; if all sizes are zero, everything goes to shard 0. Columns named
    ``shard`` or ``slot`` are replaced, others may have any names.
    """
    rows = rows.drop("shard", "slot")
    near, at, here, place, first = (free_name(rows, name) for name in ("_range", "_at", "_in_range", "_place", "_first"))
    bytes_before, rows_before = free_name(rows, "_bytes_before"), free_name(rows, "_rows_before")
    ranges = min(MOST_RANGES, max(1, -(-rows.count() // rows_per_range)))
    keys = [F.col(name).asc_nulls_first() for name in order]
    dealt = rows.repartitionByRange(ranges, *keys).withColumn(near, F.spark_partition_id())
    dealt = kept(dealt, "shard-ranges")

    totals = dealt.groupBy(near).agg(F.sum(size).alias(bytes_before), F.count("*").alias(rows_before))
    total = totals.agg(F.sum(bytes_before)).first()[0] or 0
    before = Window.orderBy(near).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(  # one row for each range
        near, *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(x) for x in (bytes_before, rows_before))
    )

    inside = Window.partitionBy(near).orderBy(*keys)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumns({here: F.sum(size).over(running), at: F.row_number().over(inside)}).join(starts, near)
    cut = _shard_of(F.col(bytes_before) + F.col(here), F.col(size), total, shards)
    placed = placed.select(*rows.columns, cut.alias("shard"), (F.col(rows_before) + F.col(at) - 1).alias(place))
    placed = kept(placed, "shard-places")
    firsts = placed.groupBy("shard").agg(F.min(place).alias(first))
    slots = placed.join(F.broadcast(firsts), "shard")  # a row for each shard
    return slots.select(*rows.columns, "shard", (F.col(place) - F.col(first)).alias("slot"))


def _shard_of(end: Column, size: Column, total: int, shards: int) -> Column:
    """The shard of the middle byte of a row that ends at ``end`` on the line of all bytes.

    Twice the middle is whole, so that the cut is exact in whole numbers.
    """
    doubled = (end * 2 - size).cast("decimal(38,0)") * shards
    shard = F.floor(doubled / F.lit(max(2 * total, 1)).cast("decimal(38,0)"))
    return F.least(shard.cast("int"), F.lit(shards - 1))


def sized_documents(docs: DataFrame, overhead: int = 8) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, none if null, plus the overhead), text_crc32."""
    text = docs["text"].cast("string")
    return docs.select(
        docs["doc_id"],
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
    )
