"""Keeping hot keys out of single tasks.

One incident may hold a large part of all journal rows. Work that gathers the rows of a
key is therefore split: keys of normal size are gathered as they are, the rows of hot
keys are cut into ordered pieces first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

# Most rows, and bytes of text, of one key that are gathered into one array.
PIECE_ROWS = 10_000
PIECE_BYTES = 16 * 1024 * 1024
# Most hot keys that are broadcast; more are joined over salted keys.
BROADCAST_KEYS = 10_000
SALTS = 64
# Most rows, and bytes of text, of one key that pass through one task; larger keys are spread.
TASK_ROWS = 1_000_000
TASK_BYTES = 1024 * 1024 * 1024


@dataclass(frozen=True)
class HotKeys:
    """Keys with too many rows for one array: their values while they are few, else a table of them.

    Next to a table stand the values of the keys that are too large for one task.
    """

    values: tuple
    table: DataFrame | None = None

    def none(self) -> bool:
        return self.table is None and not self.values


def any_list(hot: dict[str, HotKeys]) -> HotKeys:
    """The keys that are hot in some list."""
    tables = [keys.table for keys in hot.values() if keys.table is not None]
    values = tuple(sorted({key for keys in hot.values() for key in keys.values}))
    return HotKeys(values, reduce(DataFrame.unionByName, tables).distinct() if tables else None)


def find_hot(
    sizes: DataFrame,
    key: str,
    piece_rows: int = PIECE_ROWS,
    piece_bytes: int = PIECE_BYTES,
    broadcast_keys: int = BROADCAST_KEYS,
) -> dict[str, HotKeys]:
    """By list, the keys with more rows or bytes than fit one array.

    ``sizes`` has rows of list, key, n and bytes, which are summed here; one job for all lists
    when the plan is built, and what it finds is stored. At most ``broadcast_keys`` + 1 keys come
    back. Of more keys those come back that hold more than ``TASK_ROWS`` rows or ``TASK_BYTES``.
    """
    sums = sizes.groupBy("list", key).agg(F.sum("n").alias("_n"), F.sum("bytes").alias("_bytes"))
    hot = sums.filter((F.col("_n") > piece_rows) | (F.col("_bytes") > piece_bytes))
    hot = stored(hot.select("list", key, "_n", "_bytes"), "hot-keys")
    found = hot.select("list", key).limit(broadcast_keys + 1).collect()
    many = len(found) > broadcast_keys
    if many:
        names = [row[0] for row in hot.select("list").distinct().collect()]  # one for each list
        tasks = F.greatest(F.col("_n") / TASK_ROWS, F.col("_bytes") / TASK_BYTES)
        found = hot.filter(tasks > 1).orderBy(tasks.desc()).limit(broadcast_keys).select("list", key).collect()
    values: dict[str, list] = {}
    for name, value in found:
        values.setdefault(name, []).append(value)
    if many:
        return {name: HotKeys(tuple(values.get(name, ())), hot.filter(F.col("list") == name).select(key)) for name in names}
    return {name: HotKeys(tuple(some)) for name, some in values.items()}


def split_hot(
    rows: DataFrame,
    key: str,
    spread_by: str,
    piece_rows: int = PIECE_ROWS,
    broadcast_keys: int = BROADCAST_KEYS,
    salts: int = SALTS,
    piece_bytes: int = PIECE_BYTES,
    hot: HotKeys | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of normal keys, and rows of keys with more than ``piece_rows`` rows or ``piece_bytes``.

    The second part is None if there is no hot key. Hot keys that are not given are found by
    an aggregate over the key and the lengths of all texts when the plan is built. Few are
    broadcast; else the rows meet them on the key. Those too large for one task also have a salt
    taken from ``spread_by``, so that each spreads over ``salts`` tasks. Rows whose key is NULL or
    empty belong to nothing and are left out.
    """
    rows = rows.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    if hot is None:
        hot = hot_of(rows, key, piece_rows, piece_bytes, broadcast_keys)
    if hot.none():
        return rows, None
    if hot.table is None:
        keys = _few(rows, key, hot)
        return rows.join(keys, key, "left_anti"), rows.join(keys, key, "left_semi")
    if not hot.values:
        return rows.join(hot.table, key, "left_anti"), rows.join(hot.table, key, "left_semi")
    spread = _few(rows, key, hot).withColumn("_salts", F.lit(salts))

    def salts_of(df: DataFrame) -> DataFrame:
        return df.join(spread, key, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    salted_keys = salts_of(hot.table).select(key, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
    salted = salts_of(rows).withColumn("_salt", F.pmod(F.hash(spread_by), "_salts"))
    on = [key, "_salt"]
    return (
        salted.join(salted_keys, on, "left_anti").select(*rows.columns),
        salted.join(salted_keys, on, "left_semi").select(*rows.columns),
    )


def hot_of(
    rows: DataFrame, key: str, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES, broadcast_keys: int = BROADCAST_KEYS
) -> HotKeys:
    """The hot keys of a table."""
    rows = rows.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    sizes = rows.select(F.lit("").alias("list"), key, F.lit(1).alias("n"), text_bytes(rows).alias("bytes"))
    return find_hot(sizes, key, piece_rows, piece_bytes, broadcast_keys).get("", HotKeys(()))


def _few(rows: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    return F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in hot.values], rows.select(key).schema))


def text_bytes(rows: DataFrame) -> Column:
    """Bytes of all texts of a row."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in rows.dtypes if kind == "string"]
    return reduce(lambda a, b: a + b, texts, F.lit(0)).cast("bigint")


def pieces_by_key(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    piece_rows: int = PIECE_ROWS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Number consecutive rows of a key in pieces; the rows of a key pass through one task.

    Adds ``part``, from 0 without gaps, and ``_total``, the key's rows. Keys whose rows fit one
    piece have one. The rows are dealt by key, sorted once and not moved again to gather them.
    """
    along = Window.partitionBy(key).orderBy(*order)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_rows = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size = text_bytes(rows)
    sized = rows.withColumns(
        {
            "_row": F.row_number().over(along),
            "_so_far": F.sum(size).over(so_far),
            "_total": F.count(F.lit(1)).over(all_rows),
            "_bytes": F.sum(size).over(all_rows),
        }
    )
    long = (F.col("_total") > piece_rows) | (F.col("_bytes") > piece_bytes)
    piece = F.floor((F.col("_row") - 1) / piece_rows) + F.floor(F.col("_so_far") / piece_bytes)
    numbered = sized.withColumn("_piece", F.when(long, piece).otherwise(0))
    begins = numbered.withColumn("_begins", F.col("_piece") != F.lag("_piece").over(along))
    return begins.withColumn("part", F.count_if("_begins").over(so_far)).select(*rows.columns, "part", "_total")


def ordered_pieces(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    piece_rows: int = PIECE_ROWS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Number consecutive rows of a key in pieces of at most ``piece_rows`` rows and about ``piece_bytes``.

    Adds ``_range`` and ``_piece``; within a key, (``_range``, ``_piece``) rises with the
    order. The rows are range-partitioned on key and order, so a key spreads over as many
    tasks as its size asks for, and rows are only counted inside one range.
    """
    ranged = rows.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy(key, "_range").orderBy(*order)
    so_far = F.sum(text_bytes(rows)).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    by_rows = F.floor((F.row_number().over(inside) - 1) / piece_rows)
    by_bytes = F.floor(so_far / piece_bytes)
    # Both rise along the order; a new piece begins where either does.
    return ranged.withColumn("_piece", by_rows + by_bytes)
