"""Bottom-k sketches of shingle hashes.

A sketch holds the k smallest distinct hashes of a text's word shingles. The sketch of a union
is made of the sketches alone, so parts of a text or groups of texts are merged without their
words. From two sketches follow resemblance, containment and the number of distinct shingles;
with fewer than k distinct shingles all three are exact.

A sketch is written as a text: its hashes in rising order, 12 hex digits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text

K = 128
SHINGLE = 5
DIGITS = 12  # of a hash: its upper 48 bits


class Shingles:
    """The shingle hashes of a text, in order, with what is needed to hash a changed end only."""

    def __init__(self, text: str, size: int = SHINGLE, like: Shingles | None = None, shared: int = 0):
        """``like`` is hashed already and agrees with the text in its first ``shared`` bytes."""
        self.size = size
        data = text.encode("utf-8").lower()
        words = data.split()
        self.words = words
        if not words:
            self.hashes = np.zeros(0, dtype=np.uint64)
            return
        joined = memoryview(b" ".join(words))
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        length = min(size, len(words))
        known = 0
        if like is not None and len(words) >= size and len(like.words) >= size:
            # All words before the one that holds the last shared byte are the same.
            same = max(0, len(data[:shared].split()) - 1)
            known = max(0, same - size + 1)
        starts = starts[: len(words) - length + 1]
        spans = zip(starts[known:].tolist(), ends[length - 1 + known :].tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        fresh = np.array([digest(joined[a:b]) for a, b in spans], dtype=np.uint64)
        self.hashes = np.concatenate([like.hashes[:known], fresh]) if known else fresh


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, rising."""
    values = hashes >> np.uint64(64 - 4 * DIGITS)
    if len(values) > 8 * k:
        # Enough of the smallest to hold k distinct ones, unless many repeat.
        few = np.unique(np.partition(values, 4 * k)[: 4 * k])
        if len(few) >= k:
            return few[:k]
    return np.unique(values)[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of what both were made of."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all of both; two empty texts resemble by 1."""
    both = merged(a, b, k)
    if not len(both):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(common <= both[-1])) / len(both)


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) / ((float(a[-1]) + 1) / float(1 << 4 * DIGITS))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    union = distinct_shingles(merged(a, b, k), k)
    return min(1.0, r * union / distinct_shingles(a, k))


def written(a: np.ndarray) -> str:
    return "".join([f"{value:012x}" for value in a.tolist()])


def read(text: str) -> np.ndarray:
    return np.array([int(text[i : i + DIGITS], 16) for i in range(0, len(text), DIGITS)], dtype=np.uint64)


def fingerprints(docs: DataFrame, key: str = "doc_id", k: int = K) -> DataFrame:
    """key, fingerprint, n_shingles (estimated distinct shingles) of every whole text.

    Null, empty and blank texts have the empty fingerprint; a text of fewer than five words is
    one shingle. Repeated rows keep a row each; other columns are ignored.
    """

    @F.pandas_udf("fingerprint string, n_shingles double")
    def made(texts: pd.Series) -> pd.DataFrame:
        found = [sketch(Shingles(text).hashes, k) for text in texts]
        return pd.DataFrame(
            {"fingerprint": [written(x) for x in found], "n_shingles": [distinct_shingles(x, k) for x in found]}
        )

    rows = docs.select(docs[key], made(whole_text(docs["text"])).alias("_made"))
    return rows.select(key, "_made.fingerprint", "_made.n_shingles")


def merge_by(prints: DataFrame, by: str, k: int = K) -> DataFrame:
    """by, fingerprint: one sketch for each group, made of its members' sketches.

    A group's hashes are never gathered: only its k smallest leave each task.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), (F.length("fingerprint") / DIGITS).cast("int") - 1),
        lambda i: F.substring(F.col("fingerprint"), i * DIGITS + 1, F.lit(DIGITS)),
    )
    rows = prints.select(by, F.explode_outer(F.when(F.length("fingerprint") > 0, hashes)).alias("hash")).distinct()
    smallest = Window.partitionBy(by).orderBy("hash")
    few = rows.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k)
    joined = F.array_join(F.array_sort(F.collect_list("hash")), "")
    return few.groupBy(by).agg(joined.alias("fingerprint"))


# --- A text, its edited form and the next text ------------------------------------------

_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the following text's first."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


class _Doc:
    def __init__(self, text: str):
        self.text = text
        self.shingles = Shingles(text)
        self.sketch = sketch(self.shingles.hashes)

    def against(self, following: _Doc) -> tuple:
        text = edited_text(self.text, following.text)
        kept_bytes = len(self.text[: len(self.text) - len(self.text) // 3].encode("utf-8"))
        edited = sketch(Shingles(text, like=self.shingles, shared=kept_bytes).hashes)
        return (
            len(self.text),
            hashlib.sha256(text.encode("utf-8")).hexdigest(),
            written(self.sketch),
            written(edited),
            resemblance(self.sketch, edited),
            resemblance(self.sketch, following.sketch),
        )


#: Ranges of the order for each shuffle partition.
RANGES_EACH = 4
_LOWEST = -(1 << 63)


def _range_heads(ids: DataFrame, ranges: int) -> list[int]:
    """The largest id of each range of the descending order, largest first; at most ``ranges``."""
    dealt = ids.repartitionByRange(ranges, F.col("id").desc()).groupBy(F.spark_partition_id().alias("range"))
    return sorted((row["head"] for row in dealt.agg(F.max("id").alias("head")).collect()), reverse=True)


def compare_with_next(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document its fingerprint, that of its edited text, and two likenesses.

    Documents follow each other by descending key (nulls last, ties by text), after the last
    comes the first; a single document follows itself. The order is cut into ranges of ids, and
    a range gets, behind its last document, a copy of the first document of the next range. So
    each text moves once, and a task reads a range in order, two documents at a time. Null texts
    count as empty. Repeated rows keep a row each; other columns are ignored; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[key].cast("long").alias("name"), whole_text(docs["text"]).alias("text"))
    rows = rows.withColumn("id", F.coalesce("name", F.lit(_LOWEST)))
    heads = _range_heads(rows.select("id"), partitions * RANGES_EACH)
    rising = np.array(heads[::-1], dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        # Heads rise here; an id belongs to the smallest head that is not below it.
        return pd.Series(len(rising) - 1 - np.searchsorted(rising, ids.to_numpy(), side="left"), dtype="int32")

    before = [(head, (i - 1) % len(heads)) for i, head in enumerate(heads)]
    followers = F.broadcast(spark.createDataFrame(before, "id long, range int"))  # a row for each range
    firsts = rows.join(followers, "id").groupBy("range", "id").agg(F.min("text").alias("text"))
    place = F.lit(0).alias("place")
    ordered = rows.select(range_of("id").alias("range"), place, "id", "name", "text").unionByName(
        firsts.select("range", F.lit(1).alias("place"), "id", F.lit(None).cast("long").alias("name"), "text")
    )
    ordered = ordered.repartition(partitions, "range").sortWithinPartitions("range", "place", F.desc("id"), "text")
    ordered = ordered.select("range", "place", F.col("name").cast("string").alias("name"), "text")  # pandas has no long with nulls
    found = ordered.mapInPandas(_neighbours, f"name string, {_RESULT}")
    names = [x.split()[0] for x in _RESULT.split(", ")]
    return found.select(F.col("name").cast("long").alias(key), *names)


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["name", *(x.split()[0] for x in _RESULT.split(", "))]
    waiting: tuple[str | None, _Doc] | None = None
    for batch in batches:
        rows = []
        for follower, name, text in zip(batch["place"], batch["name"], batch["text"], strict=True):
            doc = _Doc(text)
            if waiting is not None:
                rows.append((waiting[0], *waiting[1].against(doc)))
            waiting = None if follower else (name, doc)  # a follower ends its range
        if rows:
            yield pd.DataFrame(rows, columns=columns)
