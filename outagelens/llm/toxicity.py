"""Toxicity by a weighted finite-state grammar of clauses.

A text is read as symbols: insults, threats, targets, negations, reporting verbs, quotation
marks, clause ends, and everything else. Four transducers are composed into one machine:

* reported speech turns insults and threats inside quotation marks after a reporting verb into
  reported ones;
* negation turns an insult or threat right behind a negation (articles may stand between) into
  a negated one;
* insult and threat, together with the target, hold the strongest match of a clause and say at
  the clause's end what it was: aimed, asserted, weak, negated or reported.

The weight of a clause depends on that match, not on single words. Clauses combine as
independent evidence. Insults are a small written lexicon, and stems learned from labelled
texts: beginnings of words that stand in toxic texts far more often than chance would have it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bottom_k import Shingles
from .common import free_name, kept, model_of, whole_text

THRESHOLD = 0.3
#: Bounds of the labelled sample: rows with label 1 and rows with label 0.
SAMPLE_TOXIC = 4_000
SAMPLE_CLEAN = 12_000
STEM_LENGTHS = (4, 5, 6, 7, 8)
#: Least share of toxic texts among the sample's texts that have a stem.
PURE = 0.97
#: Least number of toxic texts with a stem.
LEAST_TEXTS = 3
REMEMBERED = 50_000
#: Beginnings of words that a task counts before it hands the counts on.
COUNTED = 100_000

# Words of the grammar, in four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown vermin imbecile "
    "idiota estúpido estúpida imbécil basura escoria dummkopf idioten abschaum arschloch trottel blödmann "
    "crétin abruti connard ordure imbécile".split()
)
THREATS = frozenset(
    "kill murder hurt destroy strangle stab shoot matar mataré matarte destruir umbringen töten erschießen "
    "verprügeln tuer tuerai frapper égorger".split()
)
TARGETS = frozenset(
    "you your yours yourself u he she they him her them tú te ti usted ustedes vosotros du dich dir ihr euch sie "
    "vous toi tu votre".split()
)
NEGATIONS = frozenset(
    "not never isn't aren't wasn't don't nicht kein keine keinen niemals pas jamais aucun nunca jamás tampoco".split()
)
ARTICLES = frozenset("a an the any some really such un una el la los las ein eine einen der die das une le les des".split())
REPORTS = frozenset(
    "said says wrote writes reported claimed shouted called quoted according dijo escribió gritó sagte schrieb "
    "meinte rief dit écrit déclaré crié".split()
)
QUOTES = frozenset('"“”„«»')
#: What a clause weighs by its strongest match.
WEIGHTS = {"aimed": 0.97, "asserted": 0.9, "weak": 0.45, "negated": 0.12, "reported": 0.15, "threat": 0.2, "none": 0.0}
#: Score of a text without any match.
BASE = 0.02

#: By an opening quotation mark, the marks that close it.
CLOSING = {'"': '"', "“": '”"', "”": "”", "„": '“”"', "«": "»", "»": "«»"}

INSULT, WEAK, THREAT, TARGET, NEG, ART, REPORT, QUOTE, END, OTHER = range(10)
#: Symbols that transducers put in the place of insults and threats.
NEGATED, REPORTED = 10, 11
#: The end of a quotation; `QUOTE` is its beginning.
CLOSE = 12
_SYMBOLS = range(13)
_MARK = re.compile(r"[\"“”„«»]|\n[^\S\n]*\n")
_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;\n\"“”„«»]")


# --- Transducers ------------------------------------------------------------------------


@dataclass
class Transducer:
    """start, and by (state, symbol) the next state and the symbol that is put out.

    What is missing keeps the state and hands the symbol on.
    """

    start: object
    steps: dict[tuple[object, int], tuple[object, object]] = field(default_factory=dict)

    def step(self, state: object, symbol: int) -> tuple[object, object]:
        return self.steps.get((state, symbol), (state, symbol))


def negation() -> Transducer:
    """A negation holds over articles and up to the next other word."""
    made = Transducer("plain")
    for symbol in _SYMBOLS:
        made.steps["after", symbol] = ("plain", symbol)
    made.steps["plain", NEG] = made.steps["after", NEG] = ("after", NEG)
    made.steps["after", ART] = ("after", ART)
    for symbol in (INSULT, WEAK, THREAT):
        made.steps["after", symbol] = ("plain", NEGATED)
    return made


def reported_speech() -> Transducer:
    """Quotation marks after a reporting verb of the same clause hold up to the closing mark."""
    made = Transducer("plain")
    made.steps["plain", REPORT] = ("said", REPORT)
    made.steps["said", QUOTE] = ("quoted", QUOTE)
    made.steps["said", END] = ("plain", END)
    made.steps["quoted", CLOSE] = ("plain", CLOSE)
    for symbol in (INSULT, WEAK, THREAT):
        made.steps["quoted", symbol] = ("quoted", REPORTED)
    return made


def clause() -> Transducer:
    """Insults, threats and targets of a clause; its end puts out the strongest match by name.

    A state is (strongest of none, reported, negated, weak, threat, asserted; target seen).
    """
    order = ("none", "reported", "negated", "threat", "weak", "asserted")
    found = {INSULT: "asserted", WEAK: "weak", THREAT: "threat", NEGATED: "negated", REPORTED: "reported"}
    made = Transducer(("none", False))
    for kind in order:
        for aimed in (False, True):
            state = (kind, aimed)
            made.steps[state, TARGET] = ((kind, True), OTHER)
            for symbol, new in found.items():
                made.steps[state, symbol] = ((max(kind, new, key=order.index), aimed), OTHER)
            strong = aimed and kind in ("asserted", "threat")
            made.steps[state, END] = (made.start, "aimed" if strong else kind)
            for symbol in (NEG, ART, REPORT, QUOTE, CLOSE, OTHER):
                made.steps[state, symbol] = (state, OTHER)
    return made


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that reads what the first puts out with the second; only states it can reach."""
    made = Transducer((first.start, second.start))
    ahead, seen = [made.start], {made.start}
    while ahead:
        a, b = state = ahead.pop()
        for symbol in _SYMBOLS:
            next_a, between = first.step(a, symbol)
            next_b, out = second.step(b, between)
            made.steps[state, symbol] = ((next_a, next_b), out)
            if (next_a, next_b) not in seen:
                seen.add((next_a, next_b))
                ahead.append((next_a, next_b))
    return made


class Grammar:
    """The composed machine with numbered states: one list look-up for each symbol."""

    def __init__(self):
        machine = compose(compose(reported_speech(), negation()), clause())
        states = list(dict.fromkeys(state for state, _ in machine.steps))
        number = {state: i for i, state in enumerate(states)}
        self.start = number[machine.start]
        self.steps = [
            [(number[machine.steps[state, symbol][0]], machine.steps[state, symbol][1]) for symbol in _SYMBOLS]
            for state in states
        ]

    def matches(self, symbols: list[int]) -> Counter:
        """How many clauses have which match; the end of the text ends the last clause."""
        found: Counter = Counter()
        state, steps = self.start, self.steps
        for symbol in symbols:
            state, out = steps[state][symbol]
            if symbol == END and out != "none":
                found[out] += 1
        out = steps[state][END][1]
        if out != "none":
            found[out] += 1
        return found


def quotations(text: str) -> list[int]:
    """For each quotation mark of a text: `QUOTE` if it opens, `CLOSE` if it closes, else `OTHER`.

    A mark opens only if one that closes it follows before the next blank line. Straight marks
    are told apart by what stands around them; one right behind a letter or digit, such as an
    inch sign, opens nothing. Marks inside a quotation are no others.
    """
    found = [(x.start(), x[0]) for x in _MARK.finditer(text)]
    closed_by: dict[int, int] = {}
    ahead: dict[str, int] = {}  # the next mark that can close, by its character
    for i in range(len(found) - 1, -1, -1):
        at, mark = found[i]
        if mark not in QUOTES:
            ahead.clear()
            continue
        before, after = text[at - 1 : at], text[at + 1 : at + 2]
        if mark != '"' or not before.isalnum():
            ends = [ahead[x] for x in CLOSING[mark] if x in ahead]
            if ends:
                closed_by[i] = min(ends)
        if mark != '"' or not (before.isspace() or not before) or not after.isalnum():
            ahead[mark] = i
    symbols, until = [], -1
    for i, (_, mark) in enumerate(found):
        if mark in QUOTES:
            opens = i > until and i in closed_by
            symbols.append(CLOSE if i == until else QUOTE if opens else OTHER)
            until = closed_by[i] if opens else until
    return symbols


# --- Lexicon and scores ---------------------------------------------------------------------


@dataclass(frozen=True)
class ToxicLexicon:
    """Learned stems: beginning of a word to the share of toxic texts among those that have it."""

    stems: dict[str, float] = field(default_factory=dict)


class Scorer:
    """Scores whole texts; made once in each worker."""

    def __init__(self, lexicon: ToxicLexicon):
        self.grammar = Grammar()
        self.stems = lexicon.stems
        self.lengths = sorted({len(stem) for stem in lexicon.stems})
        self.written: dict[str, int] = {}
        marks = dict.fromkeys(QUOTES, QUOTE) | dict.fromkeys(".!?;\n", END)
        for words, symbol in (
            (ARTICLES, ART), (TARGETS, TARGET), (REPORTS, REPORT), (NEGATIONS, NEG), (THREATS, THREAT), (INSULTS, INSULT),
        ):
            self.written |= dict.fromkeys(words, symbol)
        self.written |= marks
        self.known = dict(self.written)

    def _symbol(self, word: str) -> int:
        for length in self.lengths:
            share = self.stems.get(word[:length])
            if share is not None and len(word) >= length:
                symbol = INSULT if share >= 0.9 else WEAK
                break
        else:
            symbol = OTHER
        if len(word) <= 64:
            if len(self.known) >= REMEMBERED:
                self.known = dict(self.written)
            self.known[word] = symbol
        return symbol

    def score(self, text: str) -> float:
        known, symbol_of = self.known, self._symbol
        text = text.lower().replace("’", "'")
        symbols = [known[x] if x in known else symbol_of(x) for x in _TOKEN.findall(text)]
        clean = 1.0 - BASE
        if INSULT in symbols or THREAT in symbols or WEAK in symbols:
            if QUOTE in symbols:
                marks = iter(quotations(text))
                symbols = [next(marks) if x == QUOTE else x for x in symbols]
            for match, times in self.grammar.matches(symbols).items():
                clean *= (1.0 - WEIGHTS[match]) ** times
        return min(1.0, max(0.0, 1.0 - clean))


def scorer_of(lexicon: ToxicLexicon) -> Scorer:
    """This process's scorer, made once; of other lexicons none is kept.

    A column function must reach it through this module: what it names itself is copied into
    each task.
    """
    return model_of("toxicity", tuple(sorted(lexicon.stems.items())), lambda: Scorer(lexicon))


def score_column(lexicon: ToxicLexicon) -> Callable[[Column], Column]:
    """Text to score (0 to 1)."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = scorer_of(lexicon)
        for texts in batches:
            yield pd.Series([scorer.score(text) for text in texts], dtype="float64")

    return score


# --- Learning ---------------------------------------------------------------------------------


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from learning: crc32 of its id's digits leaves ``fold``."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % folds == fold, F.lit(False))


def _stem_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Beginnings of words: with how many words of toxic and clean texts each goes on, and in how many toxic texts.

    A word counts once in each text. The empty beginning counts all words. Counts are handed on
    as soon as they are `COUNTED`, so a beginning may come several times, to be summed.
    """
    toxic: Counter = Counter()
    clean: Counter = Counter()
    texts: Counter = Counter()
    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"], strict=True):
            words = {x for x in _TOKEN.findall(text.lower()) if x.isalpha()}
            stems = [word[:n] for word in words for n in (0, *STEM_LENGTHS) if len(word) >= n]
            (toxic if label else clean).update(stems)
            if label:
                texts.update(set(stems))
            if len(toxic) + len(clean) >= COUNTED:
                yield _counted(toxic, clean, texts)
                for counter in (toxic, clean, texts):
                    counter.clear()
    yield _counted(toxic, clean, texts)


def _counted(toxic: Counter, clean: Counter, texts: Counter) -> pd.DataFrame:
    names = list(toxic.keys() | clean.keys())  # those of clean texts alone too: other parts may have them in toxic ones
    frame = pd.DataFrame({"stem": names, "toxic": [toxic[x] for x in names], "clean": [clean[x] for x in names]})
    return frame.assign(texts=[texts[x] for x in names]).astype(
        {"stem": "object", "toxic": "int64", "clean": "int64", "texts": "int64"}
    )


def chosen_stems(counts: list[tuple[str, int, int]], stems: int, toxic: int, clean: int) -> dict[str, float]:
    """Stems whose toxic texts are too many for chance, given how many stems there are.

    counts: stem, its words in toxic and in clean texts; ``toxic`` and ``clean`` are those of all
    words. A stem's words must stand in toxic texts nearly alone (`PURE`). Of a chosen stem's
    continuations the longest is taken that keeps nearly all of its words in toxic texts. The
    value is the share of words in toxic texts, with one clean text added.
    """
    if not toxic or not clean:
        return {}
    base = toxic / (toxic + clean)
    needed = math.log(max(stems, 1)) + 6
    good: dict[str, tuple[int, float]] = {}
    for stem, a, b in counts:
        n, share = a + b, a / (a + b)
        if a < 3 or share < PURE or share <= base:
            continue
        other = 0.0 if b == 0 else (1 - share) * math.log((1 - share) / (1 - base))
        if n * (share * math.log(share / base) + other) >= needed:
            good[stem] = (a, a / (n + 1))
    found: dict[str, float] = {}
    for stem in sorted(good, key=lambda x: (len(x), x)):
        if any(stem[:n] in found for n in range(1, len(stem))) or any(x.startswith(stem) for x in found):
            continue
        longest = stem
        for longer in sorted((x for x in good if x.startswith(stem) and len(x) > len(stem)), key=len):
            if len(longer) == len(longest) + 1 and longer.startswith(longest) and good[longer][0] >= 0.95 * good[stem][0]:
                longest = longer
        found[longest] = good[longest][1]
    return found


@F.pandas_udf(T.LongType())
def _copy_sign(texts: pd.Series) -> pd.Series:
    """One number that near copies mostly share: the smallest hash of five words in a row."""
    hashes = [Shingles(text).hashes for text in texts]
    return pd.Series([int(x.min() >> np.uint64(1)) if len(x) else 0 for x in hashes], dtype="int64")


def _smallest(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Of rows (id, toxic, h), for each label so many of smallest (h, id).

    Sizes by the upper bits of h tell which part holds them, so that no task sorts a label's other rows.
    """
    rows = kept(rows, "label-rows")
    part = F.shiftright("h", 52)  # 4,096 values
    sizes = rows.groupBy("toxic", part.alias("part")).count().orderBy("toxic", "part").collect()
    few = []
    for label, count in counts.items():
        parts = [(row["part"], row["count"]) for row in sizes if row["toxic"] == label]
        held = list(accumulate(n for _, n in parts))
        upper = next((p for (p, _), n in zip(parts, held, strict=True) if n >= count), 2047)
        few.append(rows.filter((F.col("toxic") == label) & (part <= upper)).orderBy("h", "id").limit(count))
    return reduce(DataFrame.unionByName, few)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", toxic_rows: int = SAMPLE_TOXIC, clean_rows: int = SAMPLE_CLEAN
) -> ToxicLexicon:
    """Learn stems from a bounded sample of labelled texts.

    Of each label the rows with the smallest digests of their keys are asked for, which does
    not depend on the order of the tables; their whole texts are read. Of near copies mostly
    one counts, as words of a text that was copied often would look like words of toxicity. Null labels, keys and
    texts, and keys with contradicting labels take no part. Stems are bounded by the sample only. Nothing to learn from gives an
    empty lexicon; the written words remain.
    """
    rows = labels.select(F.col(key).alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    rows = rows.groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    rows = rows.filter("toxic = most").select("id", "toxic", F.xxhash64("id").alias("h"))
    few = _smallest(rows, {1: toxic_rows, 0: clean_rows})
    texts = docs.select(F.col(key).alias("id"), "text").dropna()
    sample = texts.join(F.broadcast(few.select("id", "toxic")), "id")  # bounded by the sample
    sample = kept(sample.withColumn("sign", _copy_sign("text")).groupBy("sign", "toxic").agg(F.min("text").alias("text")), "labelled")
    counts = sample.mapInPandas(_stem_counts, "stem string, toxic long, clean long, texts long")
    every = counts.groupBy("stem").agg(*(F.sum(x).alias(x) for x in ("toxic", "clean", "texts")))
    every = kept(every.filter("toxic > 0"), "stems")  # others can't be learned
    words = every.filter("stem = ''").first()
    pure = F.col("toxic") >= PURE * (F.col("toxic") + F.col("clean"))  # others can't be chosen
    likely = every.filter((F.col("texts") >= LEAST_TEXTS) & pure & (F.col("stem") != "")).orderBy("stem")
    found = [tuple(row) for row in likely.select("stem", "toxic", "clean").collect()]
    return ToxicLexicon(chosen_stems(found, every.count(), words["toxic"], words["clean"]) if words else {})


def score_documents(docs: DataFrame, lexicon: ToxicLexicon, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """key, held_out, score (0 to 1), predicted (1 from the threshold on) of every whole text.

    Null, empty and blank texts have the score of a text without a match. Repeated rows keep a
    row each; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(
        docs[key], held_out(docs[key]).alias("held_out"), score_column(lexicon)(whole_text(docs["text"])).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, lexicon: ToxicLexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold.

    Null, empty and blank texts have no match and stay; repeated rows are judged alike; an
    empty table gives no rows; further columns may have any names.
    """
    score = free_name(docs, "score")
    marked = docs.withColumn(score, score_column(lexicon)(whole_text(docs["text"])))
    return marked.filter(F.col(score) < threshold).select(*(marked[name] for name in docs.columns))
