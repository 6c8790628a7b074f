"""BPE encoding and decoding with forced boundaries.

A merged token holds each pair of neighbouring base symbols somewhere inside it. A pair that
occurs inside no vocabulary token can therefore never be merged over: it marks a certain cut.
Words are cut there, the fragments are encoded independently and their ids concatenated, which
gives exactly the ids of the uncut word. Fragments and words repeat, so both are remembered,
up to a bound.

The tokenizer read here lower-cases, drops white space and marks word ends (``</w>``); without
a decoder of its own, decoding joins its tokens' written forms by one space.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import model_of, whole_text

#: Words and fragments that a Python worker remembers; the memory is emptied when it is full.
REMEMBERED = 50_000
#: Code points of a word that is not remembered beyond its batch.
LONG_WORD = 64
#: A word's ids, the ids in decimal, and what they decode to.
Word = tuple[tuple[int, ...], str, str]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(256, 512))
    return [chr(byte if byte in plain else next(moved)) for byte in range(256)]


class PairTable:
    """Whole numbers by key, for arrays of keys at once; ``default`` for other keys.

    A hash table with open places: nearly all keys stand at their own place, the few others
    in a sorted list that is searched only where the place is taken by another key.
    """

    def __init__(self, entries: dict[int, int], default: int):
        self.default = default
        keys = np.fromiter(entries.keys(), dtype=np.int64, count=len(entries))
        values = np.fromiter(entries.values(), dtype=np.int64, count=len(entries))
        bits = max(4, int(16 * max(1, len(keys))).bit_length())
        self.shift = np.uint64(64 - bits)
        places = self._place(keys)
        _, first = np.unique(places, return_index=True)
        own = np.zeros(len(keys), dtype=bool)
        own[first] = True
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, default, dtype=np.int64)
        self.keys[places[own]], self.values[places[own]] = keys[own], values[own]
        order = np.argsort(keys[~own])
        self.other_keys, self.other_values = keys[~own][order], values[~own][order]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        places = self._place(keys)
        held = self.keys[places]
        found = np.where(held == keys, self.values[places], self.default)
        if len(self.other_keys):
            taken = np.nonzero((held != keys) & (held >= 0))
            if len(taken[0]):
                at = np.minimum(np.searchsorted(self.other_keys, keys[taken]), len(self.other_keys) - 1)
                found[taken] = np.where(self.other_keys[at] == keys[taken], self.other_values[at], self.default)
        return found


class WordBpe:
    """Encoder and decoder of one vocabulary file; make one in each worker."""

    def __init__(self, definition: dict, remembered: int = REMEMBERED):
        model = definition["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.width = 1 + max(self.vocab.values(), default=0)
        first: dict[int, int] = {}  # left * width + right -> rank; the first of equal merges counts
        for rank, (left, right) in enumerate(pairs):
            first.setdefault(self.vocab[left] * self.width + self.vocab[right], rank)
        self.merged = np.array([self.vocab[left + right] for left, right in pairs] or [0], dtype=np.int64)
        self.none = len(pairs)
        self.ranks = first
        self.rank_table = PairTable(first, self.none)
        self.special = {x["content"]: x["id"] for x in definition.get("added_tokens", [])}
        self.tokens = {number: token for token, number in (self.vocab | self.special).items()}
        # By byte: the base symbol's id inside a word and at its end.
        self.inner = np.array([self.vocab[x] for x in byte_symbols()], dtype=np.int64)
        self.last = np.array([self.vocab[x + self.end] for x in byte_symbols()], dtype=np.int64)
        self.split_words = _word_splitter(definition)
        longest_first = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.special_pattern = re.compile(f"({longest_first})") if self.special else None
        self.joinable = self._joinable_pairs()
        self.remembered = remembered
        self.decimal = [str(number) for number in range(1 + max(self.tokens, default=0))]
        self.words: dict[str, Word] = {}

    @classmethod
    def from_file(cls, path: str, **options) -> WordBpe:
        with open(path, encoding="utf-8") as file:
            return cls(json.load(file), **options)

    def base_symbols(self, token: str) -> list[str]:
        """The symbols of a vocabulary token: one for each byte, the last with the word end."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            inner = token[: -len(self.end)]
            return [*inner[:-1], inner[-1] + self.end]
        return list(token)

    def _joinable_pairs(self) -> PairTable:
        """Neighbours (left * width + right) that occur inside some vocabulary token."""
        pairs: set[int] = set()
        for token in self.vocab:
            symbols = [self.vocab[x] for x in self.base_symbols(token)]
            pairs.update(a * self.width + b for a, b in zip(symbols, symbols[1:], strict=False))
        return PairTable(dict.fromkeys(pairs, 1), 0)

    def forced_cuts(self, symbols: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
        """Where fragments start: at words, and between two symbols that no token holds side by side."""
        starts = np.zeros(len(symbols), dtype=bool)
        starts[1:] = self.joinable[symbols[:-1] * self.width + symbols[1:]] == 0
        starts[word_starts] = True
        return np.flatnonzero(starts)

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each (non-empty) word: its fragments encoded apart and put together."""
        if not words:
            return []
        data = [word.encode("utf-8") for word in words]
        raw = np.frombuffer(b"".join(data), dtype=np.uint8)
        ends = np.cumsum([len(x) for x in data])
        word_starts = np.concatenate([[0], ends[:-1]])
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        starts = self.forced_cuts(symbols, word_starts)
        lengths = np.diff(np.append(starts, len(symbols)))

        # What is left of each fragment stands at its start; -1 fills the places merged away.
        done = np.full(len(symbols), -1, dtype=np.int64)
        single = lengths == 1
        done[starts[single]] = symbols[starts[single]]
        for low, high in ((2, 4), (5, 8), (9, 16), (17, 32)):
            some = (lengths >= low) & (lengths <= high)
            if some.any():
                self._merge_many(symbols, starts[some], lengths[some], done)
        for start, length in zip(starts[lengths > 32], lengths[lengths > 32], strict=True):
            parts = self._merge_long(symbols[start : start + length].tolist())
            done[start : start + len(parts)] = parts

        left = done >= 0
        ids = done[left].tolist()
        bounds = np.concatenate([[0], np.cumsum(left)[ends - 1]]).tolist()
        return [tuple(ids[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def _merge_many(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, done: np.ndarray) -> None:
        """Merge many short fragments side by side: in each, the pair of lowest rank, leftmost first."""
        longest = int(lengths.max())
        columns = np.arange(longest)
        inside = columns < lengths[:, None]
        parts = np.where(inside, symbols[np.minimum(starts[:, None] + columns, len(symbols) - 1)], -1)
        ranks = np.where(inside[:, 1:], self.rank_table[parts[:, :-1] * self.width + parts[:, 1:]], self.none)
        while len(starts):
            at = ranks.argmin(1)
            rows = np.arange(len(starts))
            best = ranks[rows, at]
            over = best == self.none
            if over.any():
                final, places = parts[over], starts[over, None] + columns[: parts.shape[1]]
                full = final >= 0
                done[places[full]] = final[full]
                going = ~over
                parts, ranks, starts, at, best = parts[going], ranks[going], starts[going], at[going], best[going]
                rows = np.arange(len(starts))
                if not len(starts):
                    break
            parts[rows, at] = self.merged[best]
            width = parts.shape[1] - 1  # one part less in every row
            moved = columns[:width] + (columns[:width] > at[:, None])
            parts = np.take_along_axis(parts, moved, 1)
            if width == 1:
                ranks = np.full((len(starts), 1), self.none)
                continue
            moved = columns[: width - 1] + (columns[: width - 1] >= at[:, None])
            ranks = np.take_along_axis(ranks, moved, 1)
            for shift in (-1, 0):  # the pairs left and right of the merged part
                i = at + shift
                fits = (i >= 0) & (i < width - 1)
                some, i = rows[fits], i[fits]
                a, b = parts[some, i], parts[some, i + 1]
                ranks[some, i] = np.where(b >= 0, self.rank_table[a * self.width + b], self.none)

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same for one fragment of any length, with a heap and links."""
        size = len(parts)
        after = [*range(1, size), -1]
        before = list(range(-1, size - 1))
        merged = self.merged.tolist() if size > 100_000 else self.merged
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := self.ranks.get(parts[i] * self.width + parts[j])) is not None:
                heapq.heappush(queue, (rank, i, parts[i], parts[j]))

        for i in range(size):
            offer(i)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue  # a neighbour has been merged since
            parts[i], parts[j] = int(merged[rank]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [part for part in parts if part >= 0]

    def _learned(self, split: list[list[str]]) -> dict[str, Word]:
        """Every word of the batch with its ids; words not met before are encoded together."""
        known = self.words
        wanted = set().union(*split)
        fresh = [word for word in wanted if word not in known and word not in self.special]
        if len(known) + len(fresh) > self.remembered:
            known.clear()
            fresh = [word for word in wanted if word not in self.special]
        for word, ids in zip(fresh, self.encode_words(fresh), strict=True):
            known[word] = (ids, " ".join([self.decimal[i] for i in ids]), self.decode(ids))
        for word, number in self.special.items():
            known[word] = ((number,), self.decimal[number], word)
        return known

    def _forget_long(self, split: list[list[str]]) -> None:
        for words in split:
            for word in words:
                if len(word) > LONG_WORD:
                    self.words.pop(word, None)

    def encode_batch(self, texts: Sequence[str]) -> list[list[int]]:
        """The ids of whole texts; special strings in them stand for their own ids."""
        split = [self._split(text) for text in texts]
        known = self._learned(split)
        results = [[i for word in words for i in known[word][0]] for words in split]
        self._forget_long(split)
        return results

    def count_batch(self, texts: Sequence[str]) -> list[int]:
        """The number of ids of each text."""
        split = [self._split(text) for text in texts]
        known = self._learned(split)
        results = [sum([len(known[word][0]) for word in words]) for words in split]
        self._forget_long(split)
        return results

    def written_batch(self, texts: Sequence[str]) -> list[tuple[int, str, str]]:
        """Of each text the number of ids, the ids in decimal, and what they decode to.

        Both written forms are those of the words, joined by one space, as ids and tokens are.
        """
        split = [self._split(text) for text in texts]
        known = self._learned(split)
        results = []
        for words in split:
            found = [known[word] for word in words]
            count = sum([len(x[0]) for x in found])
            results.append((count, " ".join([x[1] for x in found]), " ".join([x[2] for x in found])))
        self._forget_long(split)
        return results

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0]

    def _split(self, text: str) -> list[str]:
        """The words of a text, in order; a special string is a word of its own."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self.split_words(normalised(text))
        words: list[str] = []
        for piece in self.special_pattern.split(text):
            words.extend([piece] if piece in self.special else self.split_words(normalised(piece)))
        return words

    def decode(self, ids: Sequence[int]) -> str:
        """The tokens' written forms joined by one space; ids out of range are left out."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])


def normalised(text: str) -> str:
    """Composed (NFC) and lower-cased character by character, so a final sigma stays as it is."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _word_splitter(definition: dict) -> Callable[[str], list[str]]:
    """Splits a normalised text by the tokenizer's own pattern of a word.

    Its classes are written out as ranges. Texts within Latin-1, by far the most here, are
    split by a pattern whose classes end there, which is several times faster.
    """
    for step in definition["pre_tokenizer"]["pretokenizers"]:
        if step["type"] == "Split":
            latin = whole = step["pattern"]["Regex"]
            for kind, codes in _classes().items():
                latin = latin.replace(kind, _as_ranges([x for x in codes if x < 256]))
                whole = whole.replace(kind, _as_ranges(codes))
            in_latin, in_any = re.compile(latin).findall, regex.compile(whole).findall
            return lambda text: in_latin(text) if _is_latin(text) else in_any(text)
    raise ValueError("the tokenizer has no split pattern")


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _classes() -> dict[str, list[int]]:
    r"""The code points of \p{L}, \p{N} and \s."""
    members: dict[str, list[int]] = {r"\p{L}": [], r"\p{N}": []}
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LN":
            members[r"\p{" + kind + "}"].append(code)
    spaces = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    return members | {r"\s": spaces}


def _as_ranges(codes: list[int]) -> str:
    """For use inside a character class."""
    found: list[list[int]] = []
    for code in codes:
        if found and found[-1][1] == code - 1:
            found[-1][1] = code
        else:
            found.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in found)


def encoder(path: str) -> WordBpe:
    """This process's encoder of the file, made once."""
    return model_of("bpe", path, lambda: WordBpe.from_file(path))


def encode_column(path: str):
    """Text to array of ids (null text: no ids)."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for texts in batches:
            yield pd.Series(bpe.encode_batch(texts.fillna("").tolist()), dtype=object)

    return encode


def count_column(path: str):
    """Text to the number of its ids (null text: none)."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for texts in batches:
            yield pd.Series(bpe.count_batch(texts.fillna("").tolist()), dtype="int64")

    return count


def decode_column(path: str):
    """Array of ids to text (null or empty: empty text)."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for rows in batches:
            yield pd.Series([bpe.decode(ids) if ids is not None else "" for ids in rows], dtype=object)

    return decode


def round_trip_column(path: str):
    """Digests of a text's ids and of what they decode to, without carrying either further."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for texts in batches:
            rows = [(n, _sha256(ids), _sha256(text)) for n, ids, text in bpe.written_batch(texts.tolist())]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """key, ids: the ids of every whole text.

    A null or empty text has no ids. Repeated rows and keys keep a row each; other columns are
    ignored; an empty table gives no rows.
    """
    text = docs[text] if isinstance(text, str) else text
    return docs.select(docs[key], encode_column(path)(whole_text(text)).alias("ids"))


def round_trip(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """key, n_tokens and the digests of ids and decoded text; rows as in `encode_documents`."""
    done = docs.select(docs[key], round_trip_column(path)(whole_text(docs["text"])).alias("_done"))
    return done.select(key, "_done.n_tokens", "_done.ids_sha256", "_done.decoded_sha256")
