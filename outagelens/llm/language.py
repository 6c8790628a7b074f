"""Language identification by cross-parsing.

Per language a suffix automaton holds a bounded amount of labelled text. A text is parsed
against each: every phrase is the longest match, anywhere in the language's text, of what comes
next. A language needs few phrases for texts like its own; the number of phrases, normalised by
the length of both texts, estimates the cross-entropy. The lowest wins.

Parses restart every `BLOCK` characters, for every text alike, so that the blocks of many texts
run side by side through one transition table, one character in each step.
"""

from __future__ import annotations

import hashlib
import math
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, kept, model_of, whole_text

UNDETERMINED = "und"
BLOCK = 1024
#: Bounds of the labelled sample: rows and characters of each language.
SAMPLE_ROWS = 128
SAMPLE_CHARS = 32_768
#: Characters of all languages together, as long as each has its least rows and characters of a row.
ALL_CHARS = 262_144
LEAST_ROWS, LEAST_PIECE = 8, 64
#: Codes of letters; more letters than that share codes.
CODES = 126
#: Pieces that a language needs for its halves to judge each other.
LEAST_PIECES = 8

_SPACE, _OTHER = 0, 1  # codes of what is no letter, and of letters the sample does not have


def letters_only(text: str) -> str:
    """Lower case; each run of anything but letters is one space."""
    return " ".join("".join([c if c.isalpha() else " " for c in text.lower()]).split())


@dataclass(frozen=True)
class LanguageModel:
    """The labelled text of each language, letters only."""

    texts: dict[str, str]

    def digest(self) -> str:
        return hashlib.sha256(repr(sorted(self.texts.items())).encode()).hexdigest()


class CrossParser:
    """All automata of a model as one table of transitions; made once in each worker."""

    def __init__(self, model: LanguageModel):
        self.languages = sorted(model.texts)
        alphabet = sorted({c for text in model.texts.values() for c in text if c != " "})
        self.codes = {" ": _SPACE} | {c: i % CODES + 2 for i, c in enumerate(alphabet)}
        self.width = min(len(alphabet), CODES) + 2
        self.code_of = self._code_table()
        tables, self.roots, start = [], [], 0
        for language in self.languages:
            rows = suffix_automaton([self.codes[c] for c in model.texts[language]])
            tables.append(self._transitions(rows, start))
            self.roots.append(start * self.width)
            start += len(rows)
        self.table = np.concatenate(tables) if tables else np.zeros(0, dtype=np.int64)
        self.weights = [math.log2(len(model.texts[x]) + 2) for x in self.languages]

    def _code_table(self) -> np.ndarray:
        """By code point: the code of its lower case."""
        found = np.zeros(sys.maxunicode + 1, dtype=np.int16)
        for code in range(sys.maxunicode + 1):
            c = chr(code)
            if unicodedata.category(c)[0] == "L":
                found[code] = self.codes.get(c.lower()[0], _OTHER)
        return found

    def _transitions(self, rows: list[dict[int, int]], start: int) -> np.ndarray:
        """By state * width + code: twice the next state's place, plus one where a phrase ends."""
        width = self.width
        root = np.full(width, start * width * 2 + 1, dtype=np.int64)
        for code, target in rows[0].items():
            root[code] = (start + target) * width * 2 + 1  # a new phrase starts with this code
        table = np.tile(root, len(rows)).reshape(len(rows), width)
        for state, following in enumerate(rows):
            for code, target in following.items():
                table[state, code] = (start + target) * width * 2
        # From the root nothing has been matched, so whatever comes starts a phrase.
        for code, target in rows[0].items():
            table[0, code] = (start + target) * width * 2 + 1
        return table.ravel()

    def encode(self, text: str) -> np.ndarray:
        """The codes of a text; runs of what is no letter are one."""
        codes = self.code_of[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
        return codes[keep]

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """texts x languages: the number of phrases."""
        counts = np.zeros((len(coded), len(self.languages)), dtype=np.int64)
        pieces = [(i, codes[a : a + BLOCK]) for i, codes in enumerate(coded) for a in range(0, len(codes), BLOCK)]
        pieces.sort(key=lambda x: -len(x[1]))
        for low in range(0, len(pieces), 8192):
            some = pieces[low : low + 8192]
            lengths = np.array([len(x) for _, x in some])
            grid = np.zeros((len(some), lengths[0]), dtype=np.int64)
            for row, (_, codes) in zip(grid, some, strict=True):
                row[: len(codes)] = codes
            grid = np.ascontiguousarray(grid.T)
            active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # longer than t
            owners = np.array([i for i, _ in some])
            for language, root in enumerate(self.roots):
                np.add.at(counts[:, language], owners, self._run(grid, active, root))
        return counts

    def _run(self, grid: np.ndarray, active: np.ndarray, root: int) -> np.ndarray:
        state = np.full(grid.shape[1], root, dtype=np.int64)
        count = np.zeros(grid.shape[1], dtype=np.int64)
        table = self.table
        for codes, n in zip(grid, active, strict=True):
            found = table[state[:n] + codes[:n]]
            count[:n] += found & 1
            state[:n] = found >> 1
        return count

    def entropies(self, texts: list[str]) -> list[list[float]]:
        """For each text the estimate of each language; none where nothing can be said."""
        coded = [self.encode(text) for text in texts]
        results = []
        for codes, counts in zip(coded, self.phrases(coded), strict=True):
            if not self.languages or not (codes != _SPACE).any():
                results.append([])
                continue
            results.append([c * w / len(codes) for c, w in zip(counts.tolist(), self.weights, strict=True)])
        return results

    def _best(self, entropy: list[float]) -> tuple[str, float]:
        if not entropy:
            return UNDETERMINED, 0.0
        ranked = sorted(range(len(entropy)), key=lambda i: (entropy[i], i))
        score = 1.0 if len(ranked) == 1 else _behind(entropy[ranked[0]], entropy[ranked[1]])
        return self.languages[ranked[0]], score

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """For each text the language and a score from 0 to 1: how far the second one falls behind."""
        return [self._best(entropy) for entropy in self.entropies(texts)]

    def judge(self, texts: list[str], claims: list[str | None]) -> list[tuple[str, float]]:
        """For each text the language, and from 0 to 1 how far the claimed one falls behind; 0 if it is not learned."""
        place = {name: i for i, name in enumerate(self.languages)}
        return [
            (self._best(entropy)[0], _behind(min(entropy), entropy[place[claim]]) if entropy and claim in place else 0.0)
            for entropy, claim in zip(self.entropies(texts), claims, strict=True)
        ]


def _behind(best: float, other: float) -> float:
    return min(1.0, max(0.0, 1.0 - best / max(other, 1e-12)))


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """For each state its transitions; state 0 is the root. Every path from it spells a substring."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for code in codes:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and code not in following[state]:
            following[state][code] = new
            state = link[state]
        if state >= 0:
            target = following[state][code]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and following[state].get(code) == target:
                    following[state][code] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return following


def held_out(key: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from learning: crc32 of its id's digits leaves ``fold``."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % folds == fold, F.lit(False))


def fit(labelled: DataFrame, key: str = "doc_id", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Learn every language from a bounded sample of the rows (key, text, lang).

    Of each language the ``rows`` rows of smallest digest of their key are asked for, which
    does not depend on the order of the table, and each gives ``chars / rows`` letters and
    spaces from where its digest says, equal ones once. With many languages the share of each
    is smaller, by shorter pieces at first and then by fewer rows, down to `LEAST_ROWS` of
    `LEAST_PIECE`. Labels may be wrong: the sample is halved, each half is read by the automata
    of the other, and rows read as another language are left out. Rows with a null key, text or
    language take no part.
    """
    labelled = labelled.select(F.col(key).alias("id"), "text", F.col("lang").cast("string").alias("lang")).dropna()
    labelled = labelled.filter(F.col("lang") != UNDETERMINED)
    named = kept(labelled.select("id", "lang", F.xxhash64("id").alias("h")).distinct(), "labelled-ids")
    counts = {row["lang"]: row["count"] for row in named.groupBy("lang").count().collect()}  # one row for each language
    if not counts:
        return LanguageModel({})
    share = min(chars, ALL_CHARS // len(counts))
    rows = min(rows, max(LEAST_ROWS, share // LEAST_PIECE))
    piece = max(LEAST_PIECE, share // rows)
    # Digests are evenly spread, so few rows below a bound hold the smallest of a language.
    sizes = labelled.sparkSession.createDataFrame([(k, 3.0 * rows / n) for k, n in counts.items()], "lang string, part double")
    low = F.col("h").cast("double") / 2.0**64 + 0.5 <= F.col("part")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    chosen = named.join(F.broadcast(sizes), "lang").filter(low).withColumn("place", place).filter(F.col("place") <= rows)
    chosen = kept(chosen.select("id", "lang", "h"), "sampled-ids")
    sample = labelled.join(F.broadcast(chosen), ["id", "lang"])  # at most rows x languages
    start = F.pmod("h", F.greatest(F.length("text") - 4 * piece + 1, F.lit(1))) + 1
    stretch = F.substring("text", start.cast("int"), F.lit(4 * piece)).alias("text")
    found = sample.groupBy("lang", "h", "id").agg(F.min("text").alias("text")).select("lang", "h", "id", stretch)
    pieces: dict[str, list[str]] = {name: [] for name in counts}
    for row in sorted(found.collect(), key=lambda r: (r["lang"], r["h"], r["id"])):
        text = letters_only(row["text"])[:piece]
        if text and text not in pieces[row["lang"]]:
            pieces[row["lang"]].append(text)
    return _joined(_agreeing(pieces))


def _joined(pieces: dict[str, list[str]]) -> LanguageModel:
    return LanguageModel({name: " ".join(some) for name, some in pieces.items() if some})


def _agreeing(pieces: dict[str, list[str]]) -> dict[str, list[str]]:
    """The pieces that the other half's automata read as their own language.

    A language of fewer than `LEAST_PIECES` pieces is not halved: it keeps all of them, and both
    halves are read by them too. One of which none would be left keeps all.
    """
    halved = {name: some for name, some in pieces.items() if len(some) >= LEAST_PIECES}
    kept_pieces: dict[str, list[str]] = {name: [] for name in halved}
    for half in (0, 1) if halved else ():
        parser = CrossParser(_joined({name: some[half::2] if name in halved else some for name, some in pieces.items()}))
        for name, some in halved.items():
            read = parser.predict(some[1 - half :: 2])
            kept_pieces[name] += [text for text, (language, _) in zip(some[1 - half :: 2], read, strict=True) if language == name]
    return {name: kept_pieces.get(name) or some for name, some in pieces.items()}


def parser_of(model: LanguageModel, digest: str) -> CrossParser:
    """This process's parser, made once; of other models none is kept.

    A column function must reach it through this module: what it names itself is copied into
    each task.
    """
    return model_of("language", digest, lambda: CrossParser(model))


def predict_column(model: LanguageModel):
    """Text to (lang_pred, score)."""
    digest = model.digest()

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = parser_of(model, digest)
        for texts in batches:
            yield pd.DataFrame(parser.predict(texts.tolist()), columns=["lang_pred", "score"])

    return predict


def judge_column(model: LanguageModel):
    """Text and claimed language to (lang_pred, behind)."""
    digest = model.digest()

    @F.pandas_udf("lang_pred string, behind double")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        parser = parser_of(model, digest)
        for texts, claims in batches:
            yield pd.DataFrame(parser.judge(texts.tolist(), claims.tolist()), columns=["lang_pred", "behind"])

    return judge


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id") -> DataFrame:
    """key, held_out, lang_pred, score of every whole text.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    Repeated rows keep a row each; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(
        docs[key], held_out(docs[key]).alias("held_out"), predict_column(model)(whole_text(docs["text"])).alias("_p")
    )
    return rows.select(key, "held_out", "_p.lang_pred", "_p.score")


def drop_rejected(docs: DataFrame, model: LanguageModel, contradiction: float = 0.35) -> DataFrame:
    """The rows, with all their columns, whose language is found and not plainly another one.

    A row goes if its language is undetermined, or if it names a learned language and this one
    falls behind the predicted one by at least the given score, whatever lies between. Rows with
    a null ``lang`` are judged by the first rule only. Null, empty and blank texts are
    undetermined; repeated rows are judged alike; an empty table gives no rows; further columns
    may have any names.
    """
    found = free_name(docs, "found")
    claim = docs["lang"].cast("string")
    marked = docs.withColumn(found, judge_column(model)(whole_text(docs["text"]), claim))
    predicted, behind = F.col(f"{found}.lang_pred"), F.col(f"{found}.behind")
    named = claim.isin(sorted(model.texts)) if model.texts else F.lit(False)
    wrong = F.coalesce(named & (claim != predicted) & (behind >= contradiction), F.lit(False))
    stay = marked.filter((predicted != UNDETERMINED) & ~wrong)
    return stay.select(*(marked[name] for name in docs.columns))
