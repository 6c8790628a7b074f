"""SimHash near-duplicates found through Golay codes.

The binary Golay code of length 23 is perfect: every 23-bit word lies within 3 bits of exactly
one of its 4,096 codewords. A word within 2 bits of its codeword shares that codeword with all
words one bit away; a word at 3 bits also takes the five codewords at 4 bits from it. With these
1 or 6 codeword indices, any two words that differ in one bit share an index.

Two fingerprints of 64 bits with at most 3 different bits agree in one of their four 16-bit
blocks, and of the two 23-bit words of the other 48 bits one has at most one error. So each of
the 4 x 2 choices of block and word gives keys of (block bits, codeword index), 43 on average,
and every link shares a key. Fingerprints are joined on the keys and verified.

Equal fingerprints are one node from the start. A key's members are never expanded into all
pairs: links are searched from one member to those not yet reached, and each member found
leaves the search, so that a dense group costs about as much as its size. Keys of more than
`BLOCK` members are searched in pairs of hashed blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, kept, whole_text
from .components import components

BITS = 3
SEED = 42
SHINGLE = 3
#: Members of a key that are searched together.
BLOCK = 65_536
_HASHES_AT_ONCE = 65_536

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
LENGTH, INFORMATION = 23, 12


# --- Fingerprints -------------------------------------------------------------------


def simhashes(text: str, shingle: int = SHINGLE, seed: int = SEED, count: int = 1) -> list[int]:
    """Fingerprints of a whole text as unsigned numbers; zero if it has no word.

    The first is made of the shingles' XXH64, each further one of those values mixed once more.
    """
    words = text.encode("utf-8").lower().split()  # both touch ASCII only
    if not words:
        return [0] * count
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros((count, 64), dtype=np.int64)
    for i in range(0, len(starts), _HASHES_AT_ONCE):
        some = zip(starts[i : i + _HASHES_AT_ONCE], ends[i : i + _HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in some], dtype="<u8")
        for place in range(count):
            bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
            ones[place] += bits.sum(0, dtype=np.int64)
            hashes = _mixed(hashes)
    return np.packbits(2 * ones > len(starts), axis=1, bitorder="little").view("<u8")[:, 0].tolist()


def _mixed(values: np.ndarray) -> np.ndarray:
    """Other values of 64 bits, one for each."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def simhash(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    return simhashes(text, shingle, seed)[0]


def simhash_columns(count: int = 1, shingle: int = SHINGLE):
    """Text to (fp0, fp1, ...): fingerprints, their top bit as the sign."""

    @F.pandas_udf(", ".join(f"fp{i} long" for i in range(count)))
    def prints(texts: pd.Series) -> pd.DataFrame:
        rows = np.array([simhashes(text, shingle, count=count) for text in texts], dtype=np.uint64)
        rows = rows.reshape(-1, count).astype(np.int64)
        return pd.DataFrame({f"fp{i}": rows[:, i] for i in range(count)})

    return prints


def fingerprint_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- Golay keys ----------------------------------------------------------------------


def _remainders(count: int, shift: int) -> np.ndarray:
    """Of value << shift, for each value below count, the remainder by the generator."""
    found = np.arange(count, dtype=np.int64) << shift
    for bit in range(LENGTH - 1, LENGTH - INFORMATION - 1, -1):
        found = np.where(found >> bit & 1, found ^ (GENERATOR << (bit - 11)), found)
    return found


def _error_table() -> np.ndarray:
    """By syndrome, the patterns that lead to the nearest codewords: one, and five more or -1."""
    low, high = _remainders(1 << 12, 0), _remainders(1 << 11, 12)
    table = np.full((1 << 11, 6), -1, dtype=np.int64)
    filled = np.zeros(1 << 11, dtype=np.int64)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            error = sum(1 << place for place in places)
            syndrome = low[error & 0xFFF] ^ high[error >> 12]
            nearest = table[syndrome, 0]
            if weight == 4 and int(nearest).bit_count() < 3:
                continue
            table[syndrome, filled[syndrome]] = error
            filled[syndrome] += 1
    return table


_TABLES: list[np.ndarray] = []


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """For 23-bit words: the indices of the nearest codewords, 1 or 6 in each row, -1 for none."""
    if not _TABLES:
        _TABLES.extend((_remainders(1 << 12, 0), _remainders(1 << 11, 12), _error_table()))
    low, high, errors = _TABLES
    found = errors[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(found >= 0, (words[:, None] ^ found) >> 11, -1)


def golay_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, positions): the keys of each fingerprint (unsigned) and whose they are."""
    values = fingerprints.astype(np.uint64)
    blocks = [(values >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    keys, owners = [], []
    for i, block in enumerate(blocks):
        a, b, c = (blocks[j] for j in range(4) if j != i)
        rest = a | b << 16 | c << 32
        for segment, word in enumerate((rest & 0x7FFFFF, rest >> 23 & 0x7FFFFF)):
            indices = codeword_indices(word)
            owner, column = np.nonzero(indices >= 0)
            keys.append((2 * i + segment) << 28 | block[owner] << 12 | indices[owner, column])
            owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def _key_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        fingerprints = batch["fp"].to_numpy()
        keys, owners = golay_keys(fingerprints.astype(np.uint64))
        yield pd.DataFrame({"key": keys, "fp": fingerprints[owners]})


def near_links(members: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Links that connect the members exactly as all pairs within the distance would.

    Each member that is reached leaves the search.
    """
    links: list[tuple[int, int]] = []
    left = np.unique(members.astype(np.int64))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            near = np.bitwise_count((left ^ one).view(np.uint64)) <= bits
            if near.any():
                hits = left[near]
                links.extend((int(one), int(hit)) for hit in hits)
                queue.extend(hits)
                left = left[~near]
    return links


def _links_column(bits: int):
    @F.pandas_udf("array<struct<a: long, b: long>>")
    def links(groups: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in near_links(np.asarray(x), bits)] for x in groups], dtype=object)

    return links


def fingerprint_links(nodes: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """nodes (fp: distinct longs) to links (a, b) that connect all fingerprints within 3 bits.

    With more ``bits``, those that share a key are linked up to that distance too.
    """
    keys = kept(nodes.select("fp").mapInPandas(_key_rows, "key long, fp long"), "golay-keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keys.join(sizes, "key")
    # Normally one block. Of more, each pair of blocks is a group of its own.
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    others = F.sequence(F.lit(0), parts - 1)
    paired = shared.select("key", "fp", own.alias("own"), F.explode(others).alias("other"))
    groups = paired.groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    found = groups.agg(F.collect_list("fp").alias("members")).select(_links_column(bits)("members").alias("links"))
    return found.select(F.inline("links")).distinct()


def _classes(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """prints (id, fp) to a row for each fp: its component's smallest fp and smallest id."""
    nodes = kept(prints.groupBy("fp").agg(F.min("id").alias("id")), "fingerprints")
    roots = components(fingerprint_links(nodes, bits))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = kept(placed.select("fp", "id", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    smallest = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    return placed.select("fp", "root").join(smallest, "root")


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fingerprint and component_id.

    The component is the smallest id reachable over links of at most 3 different bits, the own
    id included. Null, empty and blank texts have fingerprint zero and link like any other.
    Repeated rows keep a row each. Null ids are no candidates for the smallest; a component of
    only such rows has a null id. Other columns are ignored; an empty table gives no rows.
    """
    made = simhash_columns()(whole_text(docs["text"])).alias("made")
    prints = kept(docs.select(docs[key].alias("id"), made).select("id", F.col("made.fp0").alias("fp")), "simhash")
    found = prints.join(_classes(prints), "fp", "left")
    return found.select(F.col("id").alias(key), fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component stays, the one of the smallest id, with all its columns.

    Components are those of `near_duplicates`: fingerprints of word shingles, linked at ``bits``
    or fewer different bits. A null id counts as the largest; of several rows of the smallest id
    any one stays. Null, empty and blank texts have fingerprint zero and are alike. Repeated rows
    are copies; an empty table gives no rows; further columns may have any names.
    """
    row, order, fp = (free_name(docs, name) for name in ("row", "order", "fp"))
    made = simhash_columns(1, shingle)(whole_text(docs["text"]))["fp0"]
    last = F.lit((1 << 63) - 1)
    stored = docs.withColumns({fp: made, row: F.monotonically_increasing_id(), order: F.coalesce(docs[key].cast("long"), last)})
    stored = kept(stored, "simhash-rows")
    prints = stored.select(F.struct(F.col(order).alias("order"), F.col(row).alias("row")).alias("id"), F.col(fp).alias("fp"))
    smallest = _classes(prints, bits).select("fp", "component_id")
    gone = prints.join(smallest, "fp").filter("id <> component_id").select(F.col("id.row").alias(row))
    return stored.join(gone, row, "left_anti").select(*(stored[name] for name in docs.columns))
