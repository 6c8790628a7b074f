"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to whole numbers. A block of rows is indexed as bitmaps: one for each
attribute and binary digit (slice), a bit for each row. A query's score of all rows of a block
is added up on bitmaps: the slices of each attribute, shifted by the set digits of the query's
component, go through carry-save adders, 64 rows in each machine word. Attributes that the query
weighs negatively enter by their complement. The best rows are then selected from the most
significant slice of the score downward; the rows left at the boundary have equal scores and are
resolved by their ids.

The scores are exact, so nothing is missed. Query blocks meet index blocks by block number: no
block is sent everywhere, and a task holds one of each.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept

SCALE = 256
TOP = 5
#: Rows of a block, fewer where vectors are wide: a block holds so many components at most.
INDEX_ROWS = 16_384
INDEX_CELLS = 1 << 22
QUERY_ROWS = 256
_LIMIT = (1 << 63) - 1


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double; an error beyond 62 bits."""

    def number(x: Column) -> Column:
        scaled = x.cast("double") * scale
        wide = F.raise_error(F.concat(F.lit("component too large to quantise: "), x.cast("string")))
        return F.when(F.abs(scaled) < 2.0**62, F.floor(scaled)).otherwise(wide.cast("long")).cast("long")

    return F.transform(vector, number)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return vector.isNotNull() & finite


# --- Bitmaps -----------------------------------------------------------------------------


class SlicedBlock:
    """The bitmaps of a block of rows, and of their complements."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.low = int(vectors.min()) if vectors.size else 0
        self.digits = (int(vectors.max()) - self.low).bit_length() if vectors.size else 0
        rows, self.width = vectors.shape
        self.words = -(-rows // 64)
        shifted = (vectors - self.low).astype(np.uint64)
        slices = np.zeros((self.digits, 2 * self.width, self.words), dtype=np.uint64)
        for digit in range(self.digits):
            bits = (shifted >> np.uint64(digit) & np.uint64(1)).astype(np.uint8)
            slices[digit, : self.width] = _packed(bits.T, self.words)
        slices[:, self.width :] = ~slices[:, : self.width]
        self.slices = slices
        self.rows = _packed(np.ones((1, rows), dtype=np.uint8), self.words)[0]

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the score from the least significant on, and the constant to add to all rows."""
        weights = [abs(int(x)) for x in query]
        negative = query < 0
        rows_of = np.arange(self.width) + self.width * negative
        full = (1 << self.digits) - 1
        constant = sum((-w * (full + self.low)) if n else w * self.low for w, n in zip(weights, negative, strict=True))
        columns: dict[int, list[np.ndarray]] = {}
        for k in range(max(weights, default=0).bit_length()):
            some = rows_of[[i for i, w in enumerate(weights) if w >> k & 1]]
            if len(some):
                for digit in range(self.digits):
                    columns.setdefault(k + digit, []).append(self.slices[digit][some])
        return _added(columns, self.words), constant

    def top(self, query: np.ndarray, own_id: int, k: int) -> list[tuple[int, int]]:
        """(row id, score) of the k best rows but those of the query's id; ties to smaller ids."""
        slices, constant = self.scores(query)
        candidates = self.rows & ~_packed((self.ids == own_id).astype(np.uint8)[None], self.words)[0]
        certain = np.zeros_like(candidates)
        for piece in reversed(slices):
            better = certain | (candidates & piece)
            count = int(np.bitwise_count(better).sum())
            if count > k:
                candidates &= piece
            else:
                certain = better
                candidates &= ~piece
                if count == k:
                    candidates[:] = 0
                    break
        sure, boundary = self._row_numbers(certain), self._row_numbers(candidates)
        room = k - len(sure)
        if len(boundary) > room:  # equal scores: the smallest ids
            boundary = boundary[np.lexsort((boundary, self.ids[boundary]))[:room]]
        chosen = np.concatenate([sure, boundary]).astype(np.int64)
        found = [(int(self.ids[row]), self._score(slices, row) + constant) for row in chosen.tolist()]
        return sorted(found, key=lambda x: (-x[1], x[0]))

    @staticmethod
    def _row_numbers(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    @staticmethod
    def _score(slices: list[np.ndarray], row: int) -> int:
        return sum((int(piece[row >> 6]) >> (row & 63) & 1) << i for i, piece in enumerate(slices))


def _packed(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of 0 and 1 as bitmaps of 64-bit words."""
    data = np.packbits(bits, axis=1, bitorder="little")
    padded = np.zeros((len(bits), words * 8), dtype=np.uint8)
    padded[:, : data.shape[1]] = data
    return padded.view(np.uint64)


def _added(columns: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The sum of bitmaps by binary place, one bitmap for each place of the result.

    Three bitmaps of a place become one of it and one carry, until one is left.
    """
    result = []
    place, last = 0, max(columns, default=-1)
    while place <= last:
        stack = columns.pop(place, [])
        at = np.concatenate(stack) if stack else np.zeros((0, words), dtype=np.uint64)
        carries = []
        while len(at) > 2:
            third = len(at) // 3
            a, b, c = at[:third], at[third : 2 * third], at[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            at = np.concatenate([half ^ c, at[3 * third :]])
        if len(at) == 2:
            carries.append((at[0] & at[1])[None])
            at = (at[0] ^ at[1])[None]
        if carries:
            columns.setdefault(place + 1, []).extend(carries)
            last = max(last, place + 1)
        result.append(at[0] if len(at) else np.zeros(words, dtype=np.uint64))
        place += 1
    return result


# --- Index and search ------------------------------------------------------------------------


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(rows["vector"].to_numpy()).astype(np.int64)
    block = SlicedBlock(rows["id"].to_numpy(dtype=np.int64), vectors)
    first = rows.iloc[0]
    return pd.DataFrame({"block": [first["block"]], "width": [first["width"]], "index": [pickle.dumps(block, 5)]})


def _dealt(parts: int) -> Column:
    """A part for each row, whatever the rows are and however they lie; to be stored at once."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")


def build_index(vectors: DataFrame, block_rows: int = INDEX_ROWS) -> DataFrame:
    """vectors (id, vector: whole numbers) to (block, width, index), every row in one block."""
    numbered = vectors.withColumn("width", F.size("vector"))
    rows, widest = numbered.agg(F.count("*"), F.max("width")).first()
    blocks = max(1, -(-rows // max(1, min(block_rows, INDEX_CELLS // max(1, widest or 0)))))
    numbered = numbered.withColumn("block", _dealt(blocks))
    numbered = kept(numbered, "numbered-vectors")
    index = numbered.groupBy("block", "width").applyInPandas(_built, "block int, width int, index binary")
    return kept(index, "bit-slices")


def search(index: DataFrame, queries: DataFrame, k: int = TOP, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows by inner product, ties to smaller ids.

    queries (id, vector). Rows of the query's own id are no candidates, nor are rows with
    another number of components. Rows that agree in id and vector are one query.
    """
    queries = queries.distinct().withColumn("width", F.size("vector"))
    groups = max(1, -(-queries.count() // query_rows))
    queries = queries.withColumn("group", _dealt(groups))
    queries = kept(queries, "numbered-queries")
    batches = queries.groupBy("group", "width").agg(F.collect_list(F.struct("id", "vector")).alias("queries"))
    # Each batch of queries goes to every block of rows, by the block's number. Where blocks are
    # fewer than tasks can run, each is sent in some copies, which share the batches.
    last = index.agg(F.max("block")).first()[0] or 0
    copies = min(groups, max(1, -(-2 * index.sparkSession.sparkContext.defaultParallelism // (last + 1))))
    batches = batches.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last)))).withColumn("copy", F.col("group") % copies)
    copied = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    pairs = batches.join(copied.hint("shuffle_merge"), ["block", "width", "copy"])

    @F.pandas_udf("array<struct<query_id: long, sign: int, vec_id: long, score: long>>")
    def best(blocks: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for stored, asked in blocks:
            found = []
            for data, some in zip(stored, asked, strict=True):
                block: SlicedBlock = pickle.loads(data)
                rows = []
                for number, query in enumerate(some):
                    vector = np.asarray(query["vector"], dtype=np.int64)
                    for row, score in block.top(vector, query["id"], k):
                        if abs(score) > _LIMIT:
                            raise OverflowError(f"the product of vectors {query['id']} and {row} passes 64 bits")
                        rows.append({"query_id": query["id"], "sign": number, "vec_id": row, "score": score})
                found.append(rows)
            yield pd.Series(found, dtype=object)

    rows = pairs.select("group", "width", F.explode(best("index", "queries")).alias("row")).select("group", "width", "row.*")
    order = Window.partitionBy("query_id", "group", "width", "sign").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_products(table: DataFrame, every: int = 50, k: int = TOP, block_rows: int = INDEX_ROWS) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``, the k best others of all rows.

    Vectors that are null, or hold a null or a component that is not finite, take no part; nor
    do rows with a null id. Repeated rows are candidates each. Empty vectors have products of
    zero with each other. Other columns are ignored; an empty table gives no rows.
    """
    rows = table.select(table["vec_id"].cast("long").alias("id"), table["embedding"].alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = kept(rows.select("id", quantised(F.col("vector")).alias("vector")), "quantised")
    return search(build_index(rows, block_rows), rows.filter(F.col("id") % every == 0), k)


TOP_SQL = f"""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
               list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= {TOP}"""
