"""Toxicity scores and learned stems against plain versions without transducers or Spark."""

import math
import random
import re

import pandas as pd
import pytest

from outagelens.llm import toxicity
from outagelens.llm.bottom_k import Shingles
from outagelens.llm.common import table

SF = "/root/testdata/sf0.001"
STRENGTH = ["none", "reported", "negated", "threat", "weak", "asserted"]


def plain_kind(word, stems):
    """What a word is by itself."""
    for words, kind in ((toxicity.INSULTS, "asserted"), (toxicity.THREATS, "threat"), (toxicity.NEGATIONS, "neg"),
                        (toxicity.REPORTS, "report"), (toxicity.TARGETS, "target"), (toxicity.ARTICLES, "article")):
        if word in words:
            return kind
    for n in range(1, len(word) + 1):
        if word[:n] in stems:
            return "asserted" if stems[word[:n]] >= 0.9 else "weak"
    return "other"


def plain_pairs(text):
    """Positions of quotation marks that open, with those that close them, by looking ahead from each."""
    marks = [m.start() for m in re.finditer('["“”„«»]', text)]
    closes, i = {}, 0
    while i < len(marks):
        at = marks[i]
        after_letter = at > 0 and text[at - 1].isalnum()
        partner = None
        if text[at] != '"' or not after_letter:
            for other in marks[i + 1 :]:
                if re.search(r"\n[^\S\n]*\n", text[at:other]):
                    break
                begins = text[other - 1].isspace() and other + 1 < len(text) and text[other + 1].isalnum()
                if text[other] in toxicity.CLOSING[text[at]] and (text[other] != '"' or not begins):
                    partner = other
                    break
        if partner is None:
            i += 1
        else:
            closes[at] = partner
            i = marks.index(partner) + 1
    return closes


def plain_score(text, stems):
    text = text.lower().replace("’", "'")
    closes = plain_pairs(text)
    words = []  # (place, kind)
    for m in re.finditer(r"[^\W_]+(?:'[^\W_]+)*|[.!?;\n\"“”„«»]", text):
        kind = "end" if m[0] in ".!?;\n" else "mark" if m[0] in toxicity.QUOTES else plain_kind(m[0], stems)
        words.append((m.start(), kind))
    # Quotations behind a reporting verb of the same clause.
    reported, since = [], 0
    for at, end in sorted(closes.items()):
        before = [kind for place, kind in words if since <= place < at]
        if "end" in before:
            before = before[len(before) - before[::-1].index("end") :]
        if "report" in before:
            reported.append((at, end))
            since = end
    clean, strongest, aimed = 1 - toxicity.BASE, "none", False
    for i, (place, kind) in enumerate([*words, (len(text), "end")]):
        if kind == "end":
            match = "aimed" if aimed and strongest in ("asserted", "threat") else strongest
            clean *= 1 - toxicity.WEIGHTS[match]
            strongest, aimed = "none", False
        elif kind == "target":
            aimed = True
        elif kind in ("asserted", "weak", "threat"):
            back = i - 1
            while back >= 0 and words[back][1] == "article":
                back -= 1
            if any(a < place < b for a, b in reported):
                kind = "reported"
            elif back >= 0 and words[back][1] == "neg":
                kind = "negated"
            strongest = max(strongest, kind, key=STRENGTH.index)
    return 1 - clean


STEMS = {"grob": 0.95, "schlim": 0.5, "tarnis": 0.99}
WORDS = ["you", "idiot", "kill", "not", "a", "an", "said", "wrote", "house", "grobul", "schlimm", "tarnist", "tarni", "isn't", "15", "du", "dummkopf"]
MARKS = [" ", " ", " ", " ", ". ", "! ", "\n", "\n\n", ' "', '" ', '"', " “", "” ", " „", "“ ", " «", "» ", "’", "_"]


def test_scores_equal_a_plain_version():
    rng = random.Random(31)
    scorer = toxicity.Scorer(toxicity.ToxicLexicon(STEMS))
    seen = set()
    for _ in range(4000):
        text = "".join(rng.choice(WORDS) + rng.choice(MARKS) for _ in range(rng.randrange(25)))
        assert scorer.score(text) == pytest.approx(plain_score(text, STEMS), abs=1e-9), text
        seen.add(round(scorer.score(text), 2))
    assert len(seen) > 20


def plain_stems(rows):
    """rows: text and label. The stems by their definition, with every count made by a search through all words."""
    signed = {}
    for text, label in rows:
        hashes = Shingles(text).hashes
        key = (int(hashes.min()) >> 1 if len(hashes) else 0, label)
        signed[key] = min(text, signed.get(key, text))
    sets = [(label, {w for w in re.findall(r"[^\W_]+(?:['’][^\W_]+)*", text.lower()) if w.isalpha()}) for (_, label), text in signed.items()]
    toxic = [w for label, words in sets if label for w in words]
    clean = [w for label, words in sets if not label for w in words]
    if not toxic or not clean:
        return {}
    stems = {w[:n] for w in toxic for n in toxicity.STEM_LENGTHS if len(w) >= n}
    base, needed = len(toxic) / (len(toxic) + len(clean)), math.log(len(stems) + 1) + 6  # and the empty one
    good = {}
    for stem in stems:
        a, b = (sum(w.startswith(stem) for w in words) for words in (toxic, clean))
        share = a / (a + b)
        if sum(any(w.startswith(stem) for w in words) for label, words in sets if label) < toxicity.LEAST_TEXTS:
            continue
        if share < toxicity.PURE or share <= base:
            continue
        gain = a * math.log(share / base) + (b * math.log((1 - share) / (1 - base)) if b else 0)
        if gain >= needed:
            good[stem] = a
            good[stem, "value"] = a / (a + b + 1)
    found = {}
    for stem in sorted((s for s in good if isinstance(s, str)), key=lambda s: (len(s), s)):
        if any(stem.startswith(f) or f.startswith(stem) for f in found):
            continue
        longest = stem
        while True:
            longer = [s for s in good if isinstance(s, str) and len(s) == len(longest) + 1 and s.startswith(longest) and good[s] >= 0.95 * good[stem]]
            if not longer:
                break
            longest = longer[0]
        found[longest] = good[longest, "value"]
    return found


#: One text or two in each part of the sample.
APART = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.files.maxPartitionBytes": "20000",
}


@pytest.mark.parametrize("settings", [{}, APART])
def test_stems_equal_a_plain_version_however_the_sample_lies(ready, settings):
    """Learned beginnings stand in clean texts too, mostly in parts of the sample without a toxic text."""
    rng = random.Random(32)
    plain = [f"{a}{b}{c}" for a in "mo ta ri lu ke so".split() for b in "na pi do ve".split() for c in "lan tor mis".split()]
    rows = []
    for i in range(240):
        words = [rng.choice(plain) for _ in range(30)]
        if i % 8 == 0:
            words[::10] = [f"grobul{rng.choice(['a', 'en', 'or'])}" for _ in words[::10]]
            words[5] = "halbware"
        if i % 60 == 1:
            words[5] = "halbware"  # too often clean to be learned
        if i == 1:
            words[0] = "grobula"
        rows.append((i, " ".join(words), int(i % 8 == 0)))
    docs = ready.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = ready.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    before = {name: ready.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            ready.conf.set(name, value)
        found = toxicity.fit(docs, labels).stems
    finally:
        for name, value in before.items():
            ready.conf.set(name, value)
    expected = plain_stems([r[1:] for r in rows])
    assert found == pytest.approx(expected) and found and not any(s.startswith("halb") for s in found)


def test_counts_of_parts_add_up():
    rows = pd.DataFrame({"text": ["grobula house", "grobula tree", "grobulen", "house tree"], "toxic": [1, 0, 0, 0]})

    def summed(parts):
        made = pd.concat([frame for part in parts for frame in toxicity._stem_counts(iter([part]))])
        return made.groupby("stem").sum().query("toxic > 0").to_dict("index")

    whole = summed([rows])
    assert summed([rows[i : i + 1] for i in range(4)]) == whole
    assert whole["grobu"] == {"toxic": 1, "clean": 2, "texts": 1} and whole[""] == {"toxic": 2, "clean": 5, "texts": 1}


def test_query_equals_a_plain_version(ready):
    docs = {r.doc_id: r.text or "" for r in table(ready, SF, "documents").collect()}
    labels = table(ready, SF, "labels")
    lexicon = toxicity.fit(table(ready, SF, "documents"), labels.filter(~toxicity.held_out(labels["doc_id"])))
    found = toxicity.score_documents(table(ready, SF, "documents"), lexicon).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.score == pytest.approx(plain_score(docs[r.doc_id], lexicon.stems), abs=1e-9)
        assert r.predicted == (r.score >= 0.3)
