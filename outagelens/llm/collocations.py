"""Phrase collocations, mined level by level with broadcast double-array tries.

Words that occur often enough get numbers, and the texts are written once as arrays of numbers,
zero for rare words and for the ends of pieces. Then for each length:

1. Safe candidates are the sequences that occur and whose shorter parts are all frequent. So that
   few of them are rare, their occurrences are first counted by hashed bucket, and only those in
   buckets that reach the least count go on. No frequent phrase is lost by that.
2. The candidates form double-array tries of bounded size. Numpy moves the states of all text
   positions at once, one level in each step, and counts the accepting states of each array of
   texts; Spark sums these counts.

Tries, words and bucket marks are broadcast in parts of a stated size. More of them than one
part holds make more parts, over which a task goes one after another; nothing is left out.
Phrases are dealt to the tries by a hash, and a position walks only the trie that its own words
belong to, so more tries make no more passes and no more steps.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH_BYTES, kept

UNKNOWN = "und"
#: Occurrences a phrase needs, its most words, and how many each language reports.
LEAST = 30
LONGEST = 4
REPORTED = 2000
SCALE = 2_000_000
#: A phrase goes if a longer one that holds it has so many hundredths of its occurrences.
COVERED = 80
#: Bounds of one broadcast part: frequent words, phrases of a trie, buckets (a bit each).
PART_WORDS = 500_000
PART_PHRASES = 150_000
MOST_BUCKETS = 1 << 30
#: Buckets and phrases are summed in blocks of this many.
BLOCK = 1 << 16
#: Bits of a block's number within its trie.
TRIE_BLOCKS = 12
#: Numbers of words that are worked on at once, and that a task holds for all tries and word parts.
ARRAY = 1 << 20
HELD = 1 << 22
#: Parts in which a language's phrases are ranked before they meet.
PARTS = 32
_BLOCK_ROW = "block int, places binary, counts binary"

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9)


# --- Words and numbers ------------------------------------------------------------------


def tokens(text: bytes) -> list[bytes]:
    """The words of a text in order; a full stop stands where a piece ends."""
    return text.translate(_FOLD).replace(b".", b" . ").split()  # of the white space only blanks and tabs are left


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            counts: Counter[bytes] = Counter()
            for text in texts:
                counts.update(tokens(text))
            counts.pop(b".", None)
            yield pd.DataFrame({"lang": lang, "word": list(counts), "n": np.fromiter(counts.values(), np.int64, len(counts))})


class _Numbers(dict):
    """Words to numbers; zero for words that have none."""

    def __missing__(self, word: bytes) -> int:
        return 0


def _numbers(text: bytes, numbers: _Numbers) -> np.ndarray:
    words = tokens(b"." + text)
    return np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))


def _let_go(part: Broadcast, parts: list[Broadcast]) -> None:
    """Of several parts a task holds one at a time; the file on its machine is read again."""
    if len(parts) > 1:
        vars(part).pop("_value", None)


def _texts_held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of ``BATCH_BYTES`` of text where they are smaller, so that parts are read less often."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += int(batch["text"].str.len().sum())
        if size >= BATCH_BYTES:
            yield pd.concat(held)
            held, size = [], 0
    if held:
        yield pd.concat(held)


def _encoder(parts: list[Broadcast]):
    """A function of batches that writes texts as arrays of numbers, each text with a zero before it."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _texts_held(batches) if len(parts) > 1 else batches:
            found = np.zeros(1, dtype=np.int32)
            for part in parts:  # a text's words are held by one text at a time
                numbers, none = part.value, _Numbers()
                rows = [_numbers(text, numbers.get(lang, none)) for lang, text in zip(batch["lang"], batch["text"], strict=True)]
                found = np.maximum(found, np.concatenate(rows))
                _let_go(part, parts)
            # Runs of zeros say no more than one.
            found = found[(found != 0) | np.concatenate([[True], found[:-1] != 0])]
            yield pd.DataFrame({"ids": [found.tobytes()]})

    return encode


# --- Double-array tries ------------------------------------------------------------------


class DoubleArray:
    """A trie of equally long sequences of positive numbers in two arrays.

    Numbers are spelled in digits of `DIGIT` bits, so that a state has few children and these
    find room among each other. State s goes with digit c to t = base[s] + c if check[t] = s.
    A state in which a sequence ends has no children; its base is the sequence's row. State 0 is
    the root.
    """

    DIGIT = 6
    ROOM = 4  # places for each state
    _FREE, _ROOT = -1, -2

    def __init__(self, rows: np.ndarray):
        """rows: different sequences, sorted, one in each row."""
        self.rows = rows
        n, self.length = rows.shape
        places = max(1, -(-int(rows.max(initial=1)).bit_length() // self.DIGIT))
        self.shifts = [self.DIGIT * i for i in reversed(range(places))]
        spelled = [self._digit(rows[:, word], shift) for word in range(self.length) for shift in self.shifts]
        fresh = np.zeros((len(spelled) + 1, n), dtype=bool)  # by level, the rows that begin a state
        fresh[:, :1] = True
        for level, digits in enumerate(spelled):
            fresh[level + 1, 1:] = fresh[level, 1:] | (digits[1:] != digits[:-1])
        size = self.ROOM * (int(fresh.sum()) + (2 << self.DIGIT))
        self.base = np.zeros(size, dtype=np.int32)
        self.check = np.full(size, self._FREE, dtype=np.int32)
        self.check[0] = self._ROOT
        above = np.zeros(n, dtype=np.int64)  # the state of each row's prefix
        for level, digits in enumerate(spelled):
            old, new = np.flatnonzero(fresh[level]), np.flatnonzero(fresh[level + 1])
            states = self._placed(above[old], np.searchsorted(new, old), digits[new])
            above = states[np.cumsum(fresh[level + 1]) - 1]
        self.base[above] = np.arange(n)

    def _digit(self, numbers: np.ndarray, shift: int) -> np.ndarray:
        return numbers >> shift & (1 << self.DIGIT) - 1

    def _placed(self, parents: np.ndarray, starts: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """States for the children of one level: of each parent the digits from its start on.

        Parents of equal width draw a base each; those whose places are free keep it, the others draw anew.
        """
        counts = np.diff(np.append(starts, len(digits)))
        states = np.zeros(len(digits), dtype=np.int64)
        rng = np.random.default_rng(len(digits))
        for width in range(1 << self.DIGIT, 0, -1):  # the widest while there is most room
            left = np.flatnonzero(counts == width)
            while len(left):
                bases = rng.integers(1, len(self.check) - (1 << self.DIGIT), size=len(left))
                own = starts[left][:, None] + np.arange(width)
                places = bases[:, None] + digits[own]
                free = (self.check[places] == self._FREE).all(axis=1)
                _, first = np.unique(places[free].ravel(), return_index=True)
                clear = np.zeros(int(free.sum()) * width, dtype=bool)
                clear[first] = True
                good = np.flatnonzero(free)[clear.reshape(-1, width).all(axis=1)]
                owners = parents[left[good]]
                self.base[owners] = bases[good]
                self.check[places[good]] = owners[:, None]
                states[own[good]] = places[good]
                left = np.delete(left, good)
        return states

    def accepted(self, ids: np.ndarray) -> np.ndarray:
        """By position, the row of the sequence that starts there, -1 where none does."""
        found = np.full(len(ids), -1, dtype=np.int64)
        places, rows = self.walked(ids, np.arange(max(0, len(ids) - self.length + 1)))
        found[places] = rows
        return found

    def walked(self, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of these positions, those where a sequence starts, and its row."""
        state = np.zeros(len(places), dtype=np.int64)
        for word in range(self.length):
            known = ids[places + word] > 0
            places, state = places[known], state[known]
            for shift in self.shifts:  # all positions go one level down together
                following = self.base[state] + self._digit(ids[places + word], shift)
                alive = self.check[following] == state
                places, state = places[alive], following[alive]
        return places, self.base[state]


def _walks(tries: list[Broadcast], arrays: list[np.ndarray], length: int) -> Iterator[tuple[int, DoubleArray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each trie its place, itself, and by array the positions where one of its sequences starts, and their rows.

    With several tries a position is walked in the one that its words are dealt to.
    """
    known = [np.arange(max(0, len(ids) - length + 1)) for ids in arrays]
    if len(tries) > 1:
        for word in range(length):
            known = [places[ids[places + word] > 0] for ids, places in zip(arrays, known, strict=True)]
        owners = [_owner(_windows(ids, places, length), len(tries)) for ids, places in zip(arrays, known, strict=True)]
    for place, part in enumerate(tries):
        trie = part.value
        mine = [places[own == place] for places, own in zip(known, owners, strict=True)] if len(tries) > 1 else known
        yield place, trie, [trie.walked(ids, places) for ids, places in zip(arrays, mine, strict=True)]
        _let_go(part, tries)


def _hits(tries: list[Broadcast], arrays: list[np.ndarray], length: int) -> list[np.ndarray]:
    """By array, whether a sequence of one of the tries starts at each position."""
    found = [np.zeros(len(ids), dtype=bool) for ids in arrays]
    for _, _, walked in _walks(tries, arrays, length):
        for hits, (places, _) in zip(found, walked, strict=True):
            hits[places] = True
    return found


# --- Passes over the encoded texts -----------------------------------------------------------


def _arrays(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    """The encoded texts, each with a zero before it, in arrays of ``ARRAY`` numbers where they are smaller."""
    some: list[np.ndarray] = []
    for batch in batches:
        for ids in batch["ids"]:
            some.append(np.frombuffer(ids, dtype=np.int32))
            if sum(map(len, some)) >= ARRAY:
                yield np.concatenate(some)
                some = []
    if some:
        yield np.concatenate(some)


def _held(batches: Iterator[pd.DataFrame], tries: list[Broadcast]) -> Iterator[list[np.ndarray]]:
    """Arrays to be worked on together: with several tries about ``HELD`` numbers, so that these are read less often."""
    some: list[np.ndarray] = []
    for ids in _arrays(batches):
        some.append(ids)
        if len(tries) < 2 or sum(map(len, some)) >= HELD:
            yield some
            some = []
    if some:
        yield some


def _safe_places(batches: Iterator[pd.DataFrame], length: int, shorter: list[Broadcast]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By array, it and its positions where both parts of one word less are frequent."""
    for arrays in _held(batches, shorter):
        good = _hits(shorter, arrays, length - 1) if length > 2 else [ids > 0 for ids in arrays]
        for ids, frequent in zip(arrays, good, strict=True):
            yield ids, np.flatnonzero(frequent[:-1] & frequent[1:])


def _windows(ids: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    windows = np.empty((len(places), length), dtype=np.int32)
    for word in range(length):
        windows[:, word] = ids[places + word]
    return windows


def _mixed(windows: np.ndarray) -> np.ndarray:
    mixed = np.zeros(len(windows), dtype=np.uint64)
    for column in windows.T:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _bucket(windows: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(windows) % np.uint64(buckets)).astype(np.int64)


def _owner(windows: np.ndarray, tries: int) -> np.ndarray:
    """The trie that each sequence is dealt to; of the hash, bits that tell no bucket."""
    return ((_mixed(windows) >> np.uint64(32)) * np.uint64(tries) >> np.uint64(32)).astype(np.int32)


def _dealer(length: int, tries: int):
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(part=_owner(batch.to_numpy(dtype=np.int32).reshape(-1, length), tries))

    return deal


def _in_blocks(places: np.ndarray, counts: np.ndarray, kind: str) -> pd.DataFrame:
    """Rising places and their counts, a row for each block of places."""
    blocks, first = np.unique(places // BLOCK, return_index=True)
    places, counts, ends = (places % BLOCK).astype("<u2"), counts.astype(kind), [*first[1:], len(places)]
    rows = [(block, places[a:z].tobytes(), counts[a:z].tobytes()) for block, a, z in zip(blocks, first, ends[: len(first)], strict=True)]
    return pd.DataFrame(rows, columns=["block", "places", "counts"])


def _block_totals(batches: Iterator[pd.DataFrame], kind: str) -> Iterator[tuple[int, np.ndarray]]:
    """The sums of rows that come sorted by block; one block is held at a time."""
    block, total = None, np.zeros(BLOCK, dtype=np.int64)
    for batch in batches:
        for now, places, counts in zip(batch["block"], batch["places"], batch["counts"], strict=True):
            if block is not None and now != block:
                yield block, total
                total = np.zeros(BLOCK, dtype=np.int64)
            block = now
            total[np.frombuffer(places, "<u2")] += np.frombuffer(counts, kind)
    if block is not None:
        yield block, total


def _bucket_counter(length: int, buckets: int, shorter: list[Broadcast], least: int):
    """Occurrences by bucket, up to ``least`` of each array only: more would not tell more."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, places in _safe_places(batches, length, shorter):
            found, n = np.unique(_bucket(_windows(ids, places, length), buckets), return_counts=True)
            yield _in_blocks(found, np.minimum(n, least), "<u2")

    return count


def _block_marker(least: int):
    """Per block the bits of the buckets that reach ``least``."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, total in _block_totals(batches, "<u2"):
            yield pd.DataFrame({"block": [block], "bits": [np.packbits(total >= least).tobytes()]})

    return mark


def _candidate_finder(length: int, buckets: int, shorter: list[Broadcast], marks: Broadcast):
    """A task's candidates, each once as long as no more than ``ARRAY`` different ones are held."""
    row = np.dtype((np.void, 4 * length))

    def spelled(found: np.ndarray) -> pd.DataFrame:
        words = found.view(np.int32).reshape(-1, length)
        return pd.DataFrame({f"w{i}": words[:, i] for i in range(length)})

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, found = marks.value, np.empty(0, dtype=row)
        for ids, places in _safe_places(batches, length, shorter):
            windows = _windows(ids, places, length)
            at = _bucket(windows, buckets)
            windows = np.ascontiguousarray(windows[bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 > 0])
            found = np.unique(np.concatenate([found, windows.view(row).ravel()]))
            if len(found) > ARRAY:
                yield spelled(found)
                found = found[:0]
        yield spelled(found)

    return find


def _phrase_counter(length: int, tries: list[Broadcast]):
    """Accepting states of a task's arrays, counted: of one trie over the whole task, of several over what is held."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = None
        for arrays in _held(batches, tries):
            for place, trie, walked in _walks(tries, arrays, length):
                total = np.zeros(len(trie.rows), dtype=np.int64)
                for _, rows in walked:
                    total += np.bincount(rows, minlength=len(total))
                if len(tries) > 1:
                    yield _counted(total, place)
                else:
                    whole = total if whole is None else whole + total
        if whole is not None:
            yield _counted(whole, 0)

    return count


def _counted(total: np.ndarray, place: int) -> pd.DataFrame:
    """The counts of a trie's rows; its blocks are numbered after those of the tries before."""
    found = np.flatnonzero(total)
    rows = _in_blocks(found, total[found], "<i8")
    return rows.assign(block=(place << TRIE_BLOCKS) + rows["block"])


def _phrase_totals(tries: list[Broadcast], least: int):
    """The tries' sequences that all tasks together counted ``least`` times; rows come trie by trie."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for block, total in _block_totals(batches, "<i8"):
            place, block = block >> TRIE_BLOCKS, block & (1 << TRIE_BLOCKS) - 1
            if held is not None and held != place:
                _let_go(tries[held], tries)
            held = place
            found = np.flatnonzero(total >= least)
            words = tries[place].value.rows[block * BLOCK + found]
            yield pd.DataFrame({f"w{i}": words[:, i] for i in range(words.shape[1])} | {"f": total[found]})

    return sums


# --- The levels ------------------------------------------------------------------------------


def _numbered_words(words: DataFrame) -> DataFrame:
    """A column id from 1 on: a number in the part of the table, after those of the parts before."""
    dealt = kept(words.repartition("lang", "word").withColumn("part", F.spark_partition_id()), "frequent-words")
    sizes = dealt.groupBy("part").count().orderBy("part").collect()  # one row for each task
    before = dict(zip((r["part"] for r in sizes), np.cumsum([0, *(r["count"] for r in sizes)]).tolist(), strict=False))

    def number(group: pd.DataFrame) -> pd.DataFrame:
        start = before[group["part"].iloc[0]] + 1
        return group.sort_values(["lang", "word"]).assign(id=range(start, start + len(group)))[["lang", "word", "n", "id"]]

    return kept(dealt.groupBy("part").applyInPandas(number, "lang string, word binary, n long, id int"), "numbered-words")


def _word_parts(spark: SparkSession, numbered: DataFrame, count: int, size: int) -> list[Broadcast]:
    """The numbers of words by language, in parts of bounded size."""
    parts = []
    for start in range(1, count + 1, size):
        some: dict[str, _Numbers] = {}
        for lang, word, number in numbered.filter(F.col("id").between(start, start + size - 1)).select("lang", "word", "id").collect():
            some.setdefault(lang, _Numbers())[bytes(word)] = number
        parts.append(spark.sparkContext.broadcast(some))
    return parts


def _trie_parts(spark: SparkSession, phrases: DataFrame, length: int, size: int) -> Iterator[Broadcast]:
    """Phrases as tries of bounded size, dealt by ``_owner``; the driver holds one at a time."""
    names = [f"w{i}" for i in range(length)]
    count = phrases.count()
    parts = -(-count // size)
    if parts > 1:  # stored trie by trie, so that each is read alone
        dealt = phrases.select(*names).mapInPandas(_dealer(length, parts), ", ".join(f"{x} int" for x in (*names, "part")))
        phrases = kept(dealt.repartitionByRange(parts, "part").sortWithinPartitions("part"), f"dealt-phrases-{length}")
    for part in range(parts):
        some = phrases.filter(F.col("part") == part) if parts > 1 else phrases
        rows = some.select(*names).toPandas().to_numpy(dtype=np.int32).reshape(-1, length)
        yield spark.sparkContext.broadcast(DoubleArray(rows[np.lexsort(rows.T[::-1])]))


def _level(spark: SparkSession, encoded: DataFrame, length: int, shorter: list[Broadcast], total: int, least: int, size: int) -> DataFrame:
    """(w0, ..., f): all phrases of a length that occur often enough."""
    names = [f"w{i}" for i in range(length)]
    buckets = min(MOST_BUCKETS, max(BLOCK, 1 << int(total // 4).bit_length()))
    counted = encoded.mapInPandas(_bucket_counter(length, buckets, shorter, least), _BLOCK_ROW)
    bits = np.zeros(buckets // 8, dtype=np.uint8)
    for block, some in _by_block(counted).mapInPandas(_block_marker(least), "block int, bits binary").collect():
        # A bit for each bucket, so at most MOST_BUCKETS.
        bits[block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)] = np.frombuffer(some, np.uint8)
    marks = spark.sparkContext.broadcast(bits)
    row = ", ".join(f"{x} int" for x in names)
    candidates = kept(encoded.mapInPandas(_candidate_finder(length, buckets, shorter, marks), row).distinct(), f"candidates-{length}")
    marks.unpersist()
    tries = list(_trie_parts(spark, candidates, length, size))
    if not tries:
        return spark.createDataFrame([], f"{row}, f long")
    dealt_by = "block" if len(tries) == 1 else f"block >> {TRIE_BLOCKS}"  # several tries each to one task
    counts = _by_block(encoded.mapInPandas(_phrase_counter(length, tries), _BLOCK_ROW), dealt_by)
    phrases = kept(counts.mapInPandas(_phrase_totals(tries, least), f"{row}, f long"), f"phrases-{length}")
    for trie in tries:
        trie.unpersist()
    return phrases


def _by_block(rows: DataFrame, dealt_by: str = "block") -> DataFrame:
    return rows.repartition(F.expr(dealt_by)).sortWithinPartitions("block")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    reported: int = REPORTED,
    part_words: int = PART_WORDS,
    part_phrases: int = PART_PHRASES,
) -> DataFrame:
    """Each language's phrases that stick together most: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words occurs ``a`` >= ``least`` times within pieces; l and r are
    the occurrences of its parts at the cut of the lowest score, floor(2000000 * a / (l + r)), ties to the
    shorter first part. Phrases that stand in a longer candidate with at least 80 % of their
    occurrences are left out. The first ``reported`` by score, occurrences and phrase are ranked.

    A null language is ``und``; null, empty and blank texts have no word; repeated rows count
    each. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    words = docs.mapInPandas(_word_counts, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = kept(words, "words")
    totals = kept(words.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    numbered = _numbered_words(words.filter(F.col("n") >= least))
    total = totals.agg(F.sum("n")).first()[0] or 0
    parts = _word_parts(spark, numbered, numbered.count(), part_words)
    encoded = kept(docs.mapInPandas(_encoder(parts), "ids binary"), "encoded")
    for part in parts:
        part.unpersist()
    levels, shorter = [numbered.select(F.array("id").alias("ids"), F.col("n").alias("f"))], []
    for length in range(2, longest + 1):
        phrases = _level(spark, encoded, length, shorter, total, least, part_phrases)
        for part in shorter:
            part.unpersist()
        shorter = list(_trie_parts(spark, phrases, length, part_phrases)) if length < longest else []
        levels.append(phrases.select(F.array(*(f"w{i}" for i in range(length))).alias("ids"), "f"))
    every = kept(reduce(DataFrame.unionByName, levels), "phrases")
    return _ranked(every, numbered, totals, reported)


def _ranked(every: DataFrame, numbered: DataFrame, totals: DataFrame, reported: int) -> DataFrame:
    candidates = every.filter(F.size("ids") > 1)
    cuts = candidates.selectExpr("ids", "f AS a", "explode(sequence(1, size(ids) - 1)) AS k")
    cuts = cuts.selectExpr("ids", "a", "k", "slice(ids, 1, k) AS first", "slice(ids, k + 1, size(ids) - k) AS rest")
    cuts = cuts.join(every.selectExpr("ids AS first", "f AS l"), "first").join(every.selectExpr("ids AS rest", "f AS r"), "rest")
    score = f"cast({SCALE} AS decimal(18, 0)) * cast(a AS decimal(19, 0)) div (cast(l AS decimal(20, 0)) + cast(r AS decimal(20, 0)))"
    cuts = cuts.withColumn("score", F.expr(score).cast("long"))
    lowest = cuts.groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.filter(F.size("ids") > 2).selectExpr("ids", "f", "explode(sequence(2, size(ids) - 1)) AS m")
    inner = inner.selectExpr("ids", "f", "m", "explode(sequence(1, size(ids) - m + 1)) AS i").selectExpr("slice(ids, i, m) AS ids", "f")
    longer = inner.groupBy("ids").agg(F.max("f").alias("longer"))
    wide = "decimal(25, 0)"
    covered = F.expr(f"100 * cast(longer AS {wide}) >= {COVERED} * cast(a AS {wide})")
    stay = lowest.join(longer, "ids", "left").filter(~F.coalesce(covered, F.lit(False)))

    stay = kept(stay, "ranked-phrases")
    spelled = stay.select("ids", F.posexplode("ids").alias("i", "id")).join(numbered.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("ids", "lang").agg(F.sort_array(F.collect_list(F.struct("i", F.col("word").cast("string").alias("word")))).alias("w"))
    spelled = spelled.select("ids", "lang", F.array_join("w.word", " ").alias("phrase"))
    rows = stay.join(spelled, "ids").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # A language's phrases are cut down in parts first, so that few of them meet in one task.
    order = "row_number() OVER (PARTITION BY {} ORDER BY score DESC, a DESC, phrase)"
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", F.expr(order.format("lang, part")))
    rows = rows.filter(F.col("rank") <= reported).withColumn("rank", F.expr(order.format("lang"))).filter(F.col("rank") <= reported)
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations_sql() -> str:
    """The same rows in SQL, from all phrases of all texts."""
    return f"""
WITH pieces AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces
), phrases AS (
    SELECT lang, m, phrase, count(*) AS f FROM (
        SELECT lang, m, array_to_string(words[i : i + m - 1], ' ') AS phrase
        FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM split, (SELECT unnest(range(1, {LONGEST + 1})) AS m))
    ) GROUP BY ALL
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE m = 1 GROUP BY lang
), candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE m > 1 AND f >= {LEAST}
), cuts AS (
    SELECT c.lang, c.phrase, c.m, c.a, k, x.f AS l, y.f AS r, ({SCALE}::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
    JOIN phrases x ON x.lang = c.lang AND x.m = k AND x.phrase = array_to_string(w[1 : k], ' ')
    JOIN phrases y ON y.lang = c.lang AND y.m = c.m - k AND y.phrase = array_to_string(w[k + 1 : c.m], ' ')
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase, m ORDER BY score, k) = 1
), longer AS (
    SELECT lang, j AS m, array_to_string(w[i : i + j - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM candidates)) GROUP BY ALL
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score::BIGINT AS score
    FROM lowest LEFT JOIN longer USING (lang, m, phrase)
    WHERE longer IS NULL OR 100 * longer::HUGEINT < {COVERED} * a::HUGEINT
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {REPORTED}
"""
