"""License scan, prefix trie and collocations against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from outagelens.llm import collocations, license_scan, prefix_trie
from outagelens.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- License scan ----------------------------------------------------------------------

BASE = [(t.label, t.text.split()) for t in license_scan.TEMPLATES if t.base]


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for label, own in BASE for i in range(len(words)) if words[i : i + len(own)] == own]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def summary(docs):
    rows = license_scan.license_summary(license_scan.scan(docs)).collect()
    return [tuple(r) for r in rows]


def test_base_phrases_equal_plain_search(documents, no_documents):
    expected = sorted(((r.doc_id, *plain_base(r.text)) for r in documents.select("doc_id", "text").collect()), key=repr)
    assert sorted((r[:6] for r in summary(documents)), key=repr) == expected
    assert summary(no_documents) == []


def test_base_phrases_of_a_table(ready):
    docs = table(ready, SF, "documents")
    expected = {r.doc_id: plain_base(r.text) for r in docs.collect()}
    assert {r[0]: r[1:6] for r in summary(docs)} == expected and any(e[1] for e in expected.values())


MIT = next(t.text for t in license_scan.TEMPLATES if t.label == "mit" and not t.base)


@pytest.mark.parametrize(
    ("text", "base", "labels", "score"),
    [
        ("MIT-License\n" * 3, "mit", "mit", 1.0),
        ("the mit\x00LICENSE, apache  license; gnu general public license v3", "apache,gpl,mit", "apache,gpl,mit", 1.0),
        ("CC BY-NC 4.0", "cc-by", "cc-by,cc-by-nc", 1.0),
        ("mit licenses permit license. mit, a license", "", "", 0.0),
        ("GNU Affero General Public License", "", "agpl", 1.0),
        ("a b c " + MIT.upper() + " and more", "", "mit", 1.0),
        ("x " + MIT.replace("associated ", "").replace("deal in", "freely deal in").replace("rights", "many good rights"), "", "mit", None),
        (" ".join(MIT.split()[: len(MIT.split()) // 2]), "", "", 0.0),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "", "cc-by-sa", 1.0),
        ("mit license " * 70_000, "mit", "mit", 1.0),
    ],
)
def test_labels(ready, text, base, labels, score):
    (found,) = summary(ready.createDataFrame([(1, text)], "doc_id long, text string"))
    assert found[1:6] == plain_base(text)
    assert (found[5], found[6]) == (base, labels)
    assert found[7] == score if score is not None else 0.8 <= found[7] < 1


def test_spans_name_the_words(ready):
    text = "one two " + MIT + " three. Under the Apache License."
    words = license_scan.words_of(text.encode())
    (row,) = license_scan.scan(ready.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    own = license_scan.words_of(MIT.encode())
    assert [(s.label, words[s.start : s.end]) for s in row.spans] == [("mit", own), ("apache", [b"apache", b"license"])]


# --- Prefix trie -----------------------------------------------------------------------


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x, key=lambda y: (y[0], y[1], hashlib.sha256(f"{len(y[1])}:{y[1]}{y[2]}".encode()).digest()))] for c, x in turns.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    members, last = defaultdict(list), {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    found = {}
    for node in sorted(members, key=len, reverse=True):
        below = [x for x in last.get(node, [])]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(found[x][6] for x in below)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        leaves = sum(found[x][5] for x in below) or 1
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found[node] = (min(members[node]), len(node), parent, len(members[node]), len(below), leaves, saved, digest)
        last.setdefault(node[:-1], []).append(node) if node else None
    return sorted(found.values(), key=repr)


def trie_rows(ready, rows, **options):
    df = ready.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df, **options).collect()), key=repr)


def odd_conversations():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t} of {c % 3 if t < 4 else c}") for c in range(0, 130) for t in range(c % 9)]
    rows += [(200, None, None, None), (200, 0, "user", ""), (200, 0, "user", ""), (200, 1, "assistant", "é😀" * 2000)]
    rows += [(c, t, "user", f"same {t}") for c in range(300, 360) for t in range(12)]  # copies of one conversation
    return rows + [(None, 0, "user", "nobody's"), (70_000, 0, "user", "a"), (140_000, 0, "user", "a"), (65_537, 0, "user", "a")]


@pytest.mark.parametrize("shard_nodes", [7, prefix_trie.SHARD_NODES])
def test_trie_equals_plain_trie(ready, shard_nodes):
    rows = odd_conversations()
    assert trie_rows(ready, rows, shard_nodes=shard_nodes) == plain_trie(rows)


def test_trie_of_few_conversations(ready):
    assert trie_rows(ready, []) == []
    alone = [(1, 0, "user", "a")]  # its five first turns come from conversation 0, which is not there
    assert trie_rows(ready, alone) == plain_trie(alone)
    long = [(500, t, "user", str(t)) for t in range(3000)]
    assert trie_rows(ready, long) == plain_trie(long)


def test_slots_are_perfect_and_verified():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(2**63), 2**63 - 1, (2, 5000))
    slots = prefix_trie.SlotTable(hi, lo)
    assert sorted(slots.slots(hi, lo).tolist()) == list(range(5000))
    assert (slots.slots(lo, hi) == -1).all() and len(prefix_trie.SlotTable(hi[:0], lo[:0]).slots(hi, lo)) == 5000
    with pytest.raises(ValueError, match="twice"):
        prefix_trie.SlotTable(np.array([1, 1]), np.array([2, 2]))


# --- Collocations ----------------------------------------------------------------------


def plain_collocations(rows, least, reported):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    found = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            if any(q != p and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:reported], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def phrase_texts():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)] + ["É", "ſ", "日本", "a b", "x\x1cy", "<unk>"]
    made = [("en" if i % 3 else "de", " ".join(rng.choice(words, 60, p=None)) + ". New York City, new york\tcity; in New York City hall") for i in range(150)]
    made += [(None, "one two three four\nfive")] * 12 + [("und", "ONE two  three four")] * 12
    return [*made, ("en", None), ("en", ""), ("fr", " \t\n.,;"), ("en", "new york city " * 20_000)]


@pytest.mark.parametrize(("options", "reported"), [({}, 2000), ({"part_words": 7, "part_phrases": 11}, 5)])
def test_collocations_equal_plain_counts(ready, options, reported):
    rows = phrase_texts()
    docs = ready.createDataFrame([(lang, text, "x", 1) for lang, text in rows], "lang string, text string, word string, n int")
    found = collocations.collocations(docs.repartition(5), least=8, reported=reported, **options)
    assert sorted(tuple(r) for r in found.collect()) == plain_collocations(rows, 8, reported)


def test_collocations_of_few_texts(ready, documents, no_documents):
    assert collocations.collocations(no_documents).collect() == []
    found = collocations.collocations(documents, least=3)
    expected = plain_collocations([(r.lang, r.text) for r in documents.select("lang", "text").collect()], 3, 2000)
    assert sorted(tuple(r) for r in found.collect()) == expected and expected


def test_scores_pass_64_bits(ready):
    """Counts near 2 ** 62 are divided exactly."""
    every = ready.createDataFrame([([1], 2**62), ([2], 2**62 - 1), ([1, 2], 2**62 - 3)], "ids array<int>, f long")
    words = ready.createDataFrame([("en", bytearray(b"a"), 1), ("en", bytearray(b"b"), 2)], "lang string, word binary, id int")
    totals = ready.createDataFrame([("en", 5)], "lang string, n long")
    (row,) = collocations._ranked(every, words, totals, 10).collect()
    assert (row.phrase, row.score) == ("a b", 2_000_000 * (2**62 - 3) // (2**63 - 1))


def test_a_double_array_accepts_its_sequences_only():
    rng = np.random.default_rng(2)
    rows = np.unique(rng.integers(1, 60, (4000, 3)).astype(np.int32), axis=0)
    trie = collocations.DoubleArray(rows)
    ids = rng.integers(0, 61, 20_000).astype(np.int32)
    place = {tuple(r): i for i, r in enumerate(rows.tolist())}
    expected = [place.get(tuple(ids[i : i + 3].tolist()), -1) if i + 3 <= len(ids) else -1 for i in range(len(ids))]
    assert trie.accepted(ids).tolist() == expected
    assert collocations.DoubleArray(rows[:1]).accepted(rows[0]).tolist() == [0, -1, -1]


class Part:
    """A broadcast that counts how often it is read."""

    def __init__(self, trie):
        self.trie, self.reads = trie, 0

    @property
    def value(self):
        self.reads += 1
        return self.trie


def test_a_position_walks_one_trie_of_many(monkeypatch):
    """The steps don't grow with the number of tries, and each is read once for all arrays held."""
    rng = np.random.default_rng(5)
    rows = np.unique(rng.integers(1, 60, (4000, 3)).astype(np.int32), axis=0)
    owners = collocations._owner(rows, 8)
    tries = [Part(collocations.DoubleArray(rows[owners == part])) for part in range(8)]
    arrays = [rng.integers(0, 61, n).astype(np.int32) for n in (20_000, 1, 0, 500)]
    walked = []
    whole = collocations.DoubleArray.walked
    monkeypatch.setattr(collocations.DoubleArray, "walked", lambda self, ids, places: walked.append(len(places)) or whole(self, ids, places))
    found = collocations._hits(tries, arrays, 3)
    assert sum(walked) <= sum(map(len, arrays)) and [part.reads for part in tries] == [1] * 8
    one = collocations.DoubleArray(rows)
    assert [hits.tolist() for hits in found] == [(one.accepted(ids) >= 0).tolist() for ids in arrays]


def test_many_tries_are_counted_in_one_pass(ready, monkeypatch):
    rows = phrase_texts()
    docs = ready.createDataFrame([(lang, text) for lang, text in rows], "lang string, text string")
    passes = []
    counter = collocations._phrase_counter
    monkeypatch.setattr(collocations, "_phrase_counter", lambda length, tries: passes.append(len(tries)) or counter(length, tries))
    found = collocations.collocations(docs, least=8, part_phrases=11).collect()
    assert len(passes) == 3 and max(passes) > 10 and found


def test_a_task_tells_each_candidate_once(monkeypatch):
    """However many arrays a task has, while few different phrases occur in them."""
    monkeypatch.setattr(collocations, "ARRAY", 500)
    rng = np.random.default_rng(6)
    texts = [pd.DataFrame({"ids": [np.append(np.int32(0), rng.integers(1, 6, 600).astype(np.int32)).tobytes()]}) for _ in range(9)]
    marks = Part(np.full(1 << 13, 255, dtype=np.uint8))
    found = pd.concat(collocations._candidate_finder(2, 1 << 16, [], marks)(iter(texts)))
    assert sorted(map(tuple, found.to_numpy().tolist())) == [(a, b) for a in range(1, 6) for b in range(1, 6)]
    assert found.dtypes.tolist() == [np.int32] * 2
