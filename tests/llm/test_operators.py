"""Each operator on odd rows, against plain versions of what it computes."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from outagelens.llm import (
    bit_sliced,
    bottom_k,
    bpe,
    chat_template,
    components,
    golay_dedup,
    language,
    mixing,
    sharding,
    token_counts,
    toxicity,
)
from outagelens.llm.common import table

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def texts_of(documents):
    return [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]


ODD = "aébΣςσİ'sßẞ \t\n\u0085 ​　你好😀١٢½Ⅷ\x1c\x00ññ're'llÅ<|>"


def odd_texts(n=300, seed=5):
    rng = random.Random(seed)
    made = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*made, "a" * 5000, "<|endoftext|><|startoftext|>x<|endoftext|", "ab" * 300 + "日本" * 40, " " * 100_000]


# --- Token counts --------------------------------------------------------------------


def test_counts_equal_the_library(ready, documents, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer = token_counts.ByteBpe.public()
    found = token_counts.count_tokens(documents, tokenizer, str(tmp_path / "cache"))
    expected = [
        (i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 1024)
        for i, t in texts_of(documents)
    ]
    assert Counter(map(tuple, found.collect())) == Counter(expected)
    counter = tokenizer.counter()
    for text in [*odd_texts(), " " * 1_000_000 + "x"]:
        assert counter(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_only_misses_are_encoded(ready, documents, no_documents, tmp_path):
    path, tokenizer = str(tmp_path / "cache"), token_counts.ByteBpe.public()
    assert token_counts.count_tokens(no_documents, tokenizer, path).count() == 0
    token_counts.fill_cache(documents.filter("doc_id = 1"), tokenizer, path)
    assert token_counts.read_cache(ready, path).count() == 1
    for _ in range(2):
        token_counts.fill_cache(documents, tokenizer, path)
        assert token_counts.read_cache(ready, path).count() == 6  # distinct texts, null read as empty
    other = token_counts.ByteBpe(tokenizer.ranks_path, tokenizer.pattern, {})
    assert other.digest() != tokenizer.digest()
    token_counts.fill_cache(documents, other, path)
    assert token_counts.read_cache(ready, path).count() == 12


# --- BPE ------------------------------------------------------------------------------


def test_bpe_equals_the_library():
    library, ours = Tokenizer.from_file(WORD_BPE), bpe.WordBpe.from_file(WORD_BPE, remembered=50)
    texts = odd_texts(1500)
    for text, ids in zip(texts, ours.encode_batch(texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)
    for text, (n, ids, decoded) in zip(texts, ours.written_batch(texts), strict=True):
        again = ours.encode(text)
        assert (n, ids, decoded) == (len(again), " ".join(map(str, again)), ours.decode(again))


def test_forced_cuts_are_in_no_token():
    ours = bpe.WordBpe.from_file(WORD_BPE)
    symbols = np.array([ours.vocab[x] for x in ours.base_symbols("hello</w>")])
    assert ours.forced_cuts(symbols, np.array([0])).tolist() == [0]
    inner = {(a, b) for t in ours.vocab for a, b in zip(ours.base_symbols(t), ours.base_symbols(t)[1:], strict=False)}
    apart = next((a, b) for a in "qxzj" for b in "qxzj" if (a, b) not in inner)
    pair = np.array([ours.vocab[x] for x in apart])
    assert ours.forced_cuts(pair, np.array([0])).tolist() == [0, 1]


def test_round_trip_of_odd_documents(documents, no_documents):
    library = Tokenizer.from_file(WORD_BPE)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for i, text in texts_of(documents):
        ids = library.encode(text, add_special_tokens=False).ids
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert Counter(map(tuple, bpe.round_trip(documents, WORD_BPE).collect())) == Counter(expected)
    ids = rows_of(bpe.encode_documents(documents.filter("doc_id = 1"), WORD_BPE), "ids")[0][0]
    assert ids == library.encode("the quick brown fox jumps over the lazy dog and runs away").ids
    assert bpe.round_trip(no_documents, WORD_BPE).count() == 0


# --- Near-duplicates ----------------------------------------------------------------------


def plain_simhash(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), seed=42) for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """id -> smallest id over links of at most 3 bits; prints: list of (id, fingerprint)."""
    roots = list(range(len(prints)))

    def find(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 3:
                roots[find(i)] = find(j)
    smallest = {}
    for i, (number, _) in enumerate(prints):
        if number is not None:
            smallest[find(i)] = min(smallest.get(find(i), number), number)
    return [smallest.get(find(i)) for i in range(len(prints))]


def test_every_pair_within_three_bits_shares_a_key():
    rng = np.random.default_rng(1)
    left = rng.integers(0, 2**64, 3000, dtype=np.uint64, endpoint=False)
    right = left.copy()
    for _ in range(3):
        right ^= np.uint64(1) << rng.integers(0, 64, len(left), dtype=np.uint64)
    keys = [set(zip(*(x.tolist() for x in golay_dedup.golay_keys(side)), strict=True)) for side in (left, right)]
    assert {owner for _, owner in keys[0] & keys[1]} == set(range(len(left)))


def test_golay_code_is_perfect():
    words = np.arange(1 << 23)[:: 97]
    indices = golay_dedup.codeword_indices(words)
    assert set((indices >= 0).sum(1).tolist()) == {1, 6}
    assert indices.max() < 4096


def test_links_in_blocks_connect_like_one_group(ready):
    rng = np.random.default_rng(2)
    center = int(rng.integers(0, 2**62))
    values = {center}
    for _ in range(60):
        base = int(rng.choice(sorted(values)))
        values.add(base ^ (1 << int(rng.integers(0, 62))) ^ (1 << int(rng.integers(0, 62))))
    nodes = ready.createDataFrame([(x,) for x in values], "fp long")
    classes = []
    for block in (golay_dedup.BLOCK, 8):
        links = golay_dedup.fingerprint_links(nodes, block=block)
        classes.append(sorted(rows_of(components.components(links), "node", "root")))
    assert classes[0] == classes[1] and len(classes[0]) == len(values)


def test_near_duplicates_equal_all_pairs(documents, no_documents):
    found = golay_dedup.near_duplicates(documents)
    prints = [(i, plain_simhash(t)) for i, t in texts_of(documents)]
    expected = [(i, f"{fp:016x}", c) for (i, fp), c in zip(prints, plain_components(prints), strict=True)]
    assert Counter(map(tuple, found.collect())) == Counter(expected)
    assert golay_dedup.near_duplicates(no_documents).count() == 0


def test_near_duplicates_of_a_table(ready):
    docs = table(ready, SF, "documents")
    prints = [(i, plain_simhash(t)) for i, t in texts_of(docs)]
    expected = {i: (f"{fp:016x}", c) for (i, fp), c in zip(prints, plain_components(prints), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in golay_dedup.near_duplicates(docs).collect()} == expected


def test_one_of_each_group_stays(documents, no_documents):
    stay = golay_dedup.drop_near_duplicates(documents)
    assert stay.columns == documents.columns
    ids = [r.doc_id for r in stay.collect()]
    assert Counter(ids) == Counter([1, 3, 6, 7, None])  # 2 copies 1; 4 and 5 have no word, like 3
    assert golay_dedup.drop_near_duplicates(no_documents).count() == 0


def changed_texts(groups, copies, words, seed=21):
    """Rows (id, text): groups of near copies, each with some words changed; ids are mixed."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        first = [f"w{rng.randrange(9999)}" for _ in range(words)]
        for _ in range(copies):
            other = list(first)
            for place in rng.sample(range(words), rng.choice((0, 1, 1, 2, words // 20))):
                other[place] = f"x{rng.randrange(9999)}"
            texts.append(" ".join(other))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("size", [(12, 4, 300), (1, 200, 60)])
def test_the_stage_keeps_the_smallest_of_each_component(ready, size):
    rows = changed_texts(*size)
    expected = plain_components([(i, plain_simhash(t)) for i, t in rows])
    stay = golay_dedup.drop_near_duplicates(ready.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert sorted(r.doc_id for r in stay.collect()) == sorted(set(expected)) and len(set(expected)) < len(rows)


def test_links_of_a_large_group_grow_with_its_members(ready):
    """A dense group has a link for each member of a key, not for each pair."""
    made = {}
    for copies in (200, 400, 800):
        values = {plain_simhash(t) for _, t in changed_texts(1, copies, 60)}
        nodes = ready.createDataFrame([(x - (x >> 63 << 64),) for x in values], "fp long")
        keys = len(golay_dedup.golay_keys(np.array(sorted(values), dtype=np.uint64))[0])
        made[copies] = golay_dedup.fingerprint_links(nodes).count()
        assert made[copies] <= keys


def test_components_of_long_chains(ready):
    links = [(i + 1, i) for i in range(40)] + [(100, 200), (200, 100), (300, 300)]
    found = dict(rows_of(components.components(ready.createDataFrame(links, "a long, b long")), "node", "root"))
    assert found == {i: 0 for i in range(41)} | {100: 100, 200: 100}


@pytest.mark.parametrize("vectors", [[[1e17], [1e17], [-1e30]], [[1e12] * 3, [1e12] * 3]])
def test_products_beyond_64_bits_are_errors(ready, vectors):
    table = ready.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large to quantise|passes 64 bits"):
        bit_sliced.top_products(table).collect()


# --- Top-k ----------------------------------------------------------------------------------


def test_top_products_equal_brute_force(ready):
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=12).tolist() for _ in range(150)]
    vectors += [vectors[0]] * 12 + [[0.0] * 12]
    rows = [(i, v, 1, 2) for i, v in enumerate(vectors)]
    rows += [(1000, None, 1, 2), (1050, [float("nan")] * 12, 1, 2), (1100, [None] * 12, 1, 2), (1150, [float("inf")] * 12, 1, 2), (None, vectors[3], 1, 2)]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>, block int, width int")
    whole = np.floor(256 * np.array(vectors)).astype(int)
    for block_rows in (16_384, 40):
        expected = []
        for q in range(0, len(vectors), 50):
            scored = sorted((-int(whole[q] @ whole[i]), i) for i in range(len(vectors)) if i != q)[:5]
            expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
        assert sorted(map(tuple, bit_sliced.top_products(df, block_rows=block_rows).collect())) == sorted(expected)
    assert bit_sliced.top_products(df.limit(0)).count() == 0
    few = ready.createDataFrame([(0, [1.0]), (3, [-2.0]), (4, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert rows_of(bit_sliced.top_products(few), "query_id", "rank", "vec_id", "score") == [(0, 1, 3, -131072)]


# --- Sharding -------------------------------------------------------------------------------


def test_shards_equal_a_prefix_sum(documents, no_documents):
    sized = sharding.sized_documents(documents)
    expected_rows = Counter((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts_of(documents))
    assert Counter(rows_of(sized, "doc_id", "size", "text_crc32")) == expected_rows
    for per_range in (50_000, 2):
        placed = sharding.byte_shards(sized, ("doc_id", "text_crc32", "size"), shards=4, rows_per_range=per_range)
        got = sorted(placed.collect(), key=lambda r: (r.shard, r.slot))
        order = sorted(expected_rows.elements(), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
        assert [(r.doc_id, r.size, r.text_crc32) for r in got] == order
        total, start, shards = sum(r[1] for r in order), 0, []
        for _, size, _ in order:
            shards.append(min(3, (2 * start + size) * 4 // (2 * total)))
            start += size
        assert [r.shard for r in got] == shards
        assert [r.slot for r in got] == [shards[:i].count(s) for i, s in enumerate(shards)]
    empty = sharding.byte_shards(sharding.sized_documents(no_documents), ("doc_id",))
    assert empty.count() == 0 and "shard" in empty.columns


def test_shards_keep_columns_of_any_name(ready):
    names = ("_first", "_range", "_in_range", "_place", "_bytes_before", "_rows_before", "_at")
    rows = ready.range(50).select("id", F.lit(3).cast("long").alias("size"), *(F.col("id").alias(x) for x in names))
    placed = sharding.byte_shards(rows, ["id"], shards=5, rows_per_range=7)
    assert placed.columns == [*rows.columns, "shard", "slot"]
    found = sorted(tuple(r) for r in placed.select("id", "_first", "_at", "shard", "slot").collect())
    assert found == [(i, i, i, i // 10, i % 10) for i in range(50)]


def test_shards_are_balanced_and_native(ready):
    sized = sharding.sized_documents(table(ready, "/root/testdata/sf0.01", "documents"))
    placed = sharding.byte_shards(sized, ("doc_id",))
    sums = [r[0] for r in placed.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    largest = sized.agg(F.max("size")).first()[0]
    assert len(sums) == 24 and max(sums) - min(sums) <= 2 * largest
    assert "Python" not in placed._jdf.queryExecution().executedPlan().toString()


# --- Fingerprints -----------------------------------------------------------------------------


def plain_shingles(text):
    words = text.encode().lower().split()
    size = min(5, len(words))
    return [xxhash.xxh64_intdigest(b" ".join(words[i : i + size])) >> 16 for i in range(len(words) - size + 1)] if words else []


def plain_resemblance(a, b, k=bottom_k.K):
    both = sorted(set(a) | set(b))[:k]
    return sum(x in set(a) and x in set(b) for x in both) / len(both) if both else 1.0


def test_documents_and_their_next(documents, no_documents):
    docs = sorted(texts_of(documents), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = []
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = (plain_shingles(x) for x in (text, edited, after))
        expected.append(
            (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(plain_resemblance(a, b), 12), round(plain_resemblance(a, c), 12))
        )
    got = bottom_k.compare_with_next(documents).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in got) == Counter(expected)
    prints = {r.fingerprint for r in got if r.doc_id in (1, 2)}
    assert len(prints) == 1
    assert bottom_k.compare_with_next(no_documents).count() == 0
    one = bottom_k.compare_with_next(documents.filter("doc_id = 1")).first()
    assert one.near_next == 1.0


def test_sketches_merge_and_estimate(ready):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    rng.shuffle(words)
    a, b = " ".join(words[:3000]), " ".join(words[1500:4500])
    x, y = (bottom_k.sketch(bottom_k.Shingles(t).hashes) for t in (a, b))
    assert abs(bottom_k.resemblance(x, y) - 1 / 3) < 0.12
    assert abs(bottom_k.containment(x, y) - 1 / 2) < 0.15
    assert abs(bottom_k.distinct_shingles(x) / 2996 - 1) < 0.25
    whole = np.concatenate([bottom_k.Shingles(t).hashes for t in (a, b)])
    assert bottom_k.merged(x, y).tolist() == bottom_k.sketch(whole).tolist()
    assert bottom_k.read(bottom_k.written(x)).tolist() == x.tolist()
    rows = ready.createDataFrame([("g", a, 1), ("g", b, 2), ("h", "", 3)], "g string, text string, doc_id long")
    prints = bottom_k.fingerprints(rows).join(rows.select("doc_id", "g"), "doc_id")
    merged = dict(rows_of(bottom_k.merge_by(prints, "g"), "g", "fingerprint"))
    assert merged == {"g": bottom_k.written(bottom_k.merged(x, y)), "h": ""}


def test_changed_end_is_hashed_like_a_whole_text():
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice("ab é\n") for _ in range(rng.randint(0, 120)))
        after = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 60)))
        edited = bottom_k.edited_text(text, after)
        shared = len(text[: len(text) - len(text) // 3].encode())
        fast = bottom_k.Shingles(edited, like=bottom_k.Shingles(text), shared=shared)
        assert fast.hashes.tolist() == bottom_k.Shingles(edited).hashes.tolist()


# --- Language -----------------------------------------------------------------------------------


def plain_phrases(text, corpus):
    """Greedy longest matches of a text in a corpus, restarting like the parser."""
    count = 0
    for start in range(0, len(text), language.BLOCK):
        block, at = text[start : start + language.BLOCK], 0
        while at < len(block):
            length = 1
            while at + length < len(block) and block[at : at + length + 1] in corpus and block[at : at + length] in corpus:
                length += 1
            count += 1
            at += length
    return count


def test_phrases_equal_plain_search():
    rng = random.Random(8)
    corpora = {name: "".join(rng.choice(letters) for _ in range(400)) for name, letters in (("x", "abc d"), ("y", "bcd e"))}
    corpora = {k: language.letters_only(v) for k, v in corpora.items()}
    parser = language.CrossParser(language.LanguageModel(corpora))
    texts = [language.letters_only("".join(rng.choice("abcde zé") for _ in range(rng.randint(1, 2600)))) for _ in range(40)]
    counts = parser.phrases([parser.encode(t) for t in texts])
    for text, row in zip(texts, counts.tolist(), strict=True):
        assert row == [plain_phrases(text, corpora["x"]), plain_phrases(text, corpora["y"])]


def test_languages_of_held_out_documents(ready):
    docs = table(ready, "/root/testdata/sf0.01", "documents")
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)


def test_every_language_is_learned_from_anywhere_in_its_texts(ready):
    """A hundred languages, one with a third of all rows; texts open with the same markup."""
    rng = random.Random(31)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    words = {f"l{i:03}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(12)] for i in range(100)}
    text = lambda name: "<p>begin</p> " * 5 + " ".join(rng.choice(words[name]) for _ in range(300))
    names = sorted(words) * 12 + ["l007"] * 600
    rows = [(i, text(name), name) for i, name in enumerate(names)]
    model = language.fit(ready.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model.texts) == set(words)
    assert max(map(len, model.texts.values())) <= language.ALL_CHARS // 100 + language.SAMPLE_ROWS
    asked = [(i, text(name), name) for i, name in enumerate(sorted(words))]
    found = language.identify(ready.createDataFrame(asked, "doc_id long, text string, lang string"), model)
    assert sum(r.lang_pred == asked[r.doc_id][2] for r in found.collect()) >= 98


def test_many_letters_share_codes():
    parser = language.CrossParser(language.LanguageModel({"zh": "".join(chr(0x4E00 + i) for i in range(3000)), "en": "the quick brown fox"}))
    assert parser.width == language.CODES + 2
    assert [x for x, _ in parser.predict(["".join(chr(0x4E00 + i) for i in range(40)), "quick fox"])] == ["zh", "en"]


def test_a_rare_language_leaves_the_others_cleaned():
    rng = random.Random(11)
    words = {name: ["".join(rng.choice(letters) for _ in range(5)) for _ in range(30)] for name, letters in (("x", "abcde"), ("y", "fghij"), ("z", "klmno"))}
    text = lambda name: " ".join(rng.choice(words[name]) for _ in range(40))
    wrong, rare = [text("y") for _ in range(3)], [text("z")]
    pieces = {"x": [text("x") for _ in range(17)] + wrong, "y": [text("y") for _ in range(20)], "z": rare}
    found = language._agreeing(pieces)
    assert sorted(found["x"]) == sorted(pieces["x"][:17]) and len(found["y"]) == 20 and found["z"] == rare


def test_claims_are_held_against_the_best_not_the_second(ready):
    near = "la casa de la plaza tiene una puerta grande y las ventanas son de madera "
    model = language.LanguageModel({"es": near * 3, "pt": near.replace("una", "uma") * 3, "de": "wir gehen heute durch kurzes dickicht zum fluss " * 5})
    text = "ventanas grande puerta plaza madera casa tiene una las son puerta madera"
    rows = [(1, text, "de"), (2, text, "es"), (3, text, "pt"), (4, text, None), (5, text, "xx")]
    docs = ready.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.CrossParser(model).predict([text])[0][1] < 0.35
    assert {r.doc_id for r in language.drop_rejected(docs, model).collect()} == {2, 3, 4, 5}


def test_language_of_odd_documents(ready, documents, no_documents):
    model = language.LanguageModel({"en": "the quick brown fox", "fr": "éa ñ éñ ña éé ñ éañ"})
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(documents, model).collect()}
    assert found[3] == found[4] == found[5] == ("und", 0.0)
    assert found[1][0] == "en" and all(0 <= s <= 1 for _, s in found.values())
    assert language.identify(no_documents, model).count() == 0
    assert language.fit(no_documents).texts == {}
    assert {r.lang_pred for r in language.identify(documents, language.LanguageModel({})).collect()} == {"und"}
    stay = language.drop_rejected(documents, model, contradiction=0.0)
    assert stay.columns == documents.columns
    assert {r.doc_id for r in stay.collect()} >= {1, 2} and 3 not in {r.doc_id for r in stay.collect()}


# --- Toxicity --------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "toxic"),
    [
        ("You are a worthless idiot.", True),
        ("What an idiot", True),
        ("I will kill you!", True),
        ("Du bist ein Dummkopf", True),
        ("The process was killed by the system", False),
        ("They kill bugs. Then you go home.", True),
        ("He is not an idiot.", False),
        ("She said: \"you idiot\" and left", False),
        ("She said so. \"you idiot\"", True),
        ("She said \"idiot\" and left", False),
        ("", False),
        ("A fine day", False),
    ],
)
def test_clauses_are_judged_not_words(text, toxic):
    assert (toxicity.Scorer(toxicity.ToxicLexicon()).score(text) >= toxicity.THRESHOLD) == toxic


@pytest.mark.parametrize(
    ("text", "toxic"),
    [
        ('He said "and then. You idiot. You moron.', True),  # never closed
        ('He said "so.\n\nYou idiot. You moron. "Yes"', True),  # not before the blank line
        ('"As he said" you idiot. You moron. "Yes"', True),  # a closing mark opens nothing
        ('He said "no. You idiot. You idiot" and left', False),
        ('On a 15" screen he said "you idiot" and left', False),
        ("Er sagte „du idiot“ und ging", False),
        ("Il a dit « idiot » hier", False),
    ],
)
def test_quotations_end(text, toxic):
    assert (toxicity.Scorer(toxicity.ToxicLexicon()).score(text) >= toxicity.THRESHOLD) == toxic


def test_composition_runs_like_the_parts_in_turn():
    rng = random.Random(9)
    machine = toxicity.compose(toxicity.compose(toxicity.reported_speech(), toxicity.negation()), toxicity.clause())
    for _ in range(200):
        symbols = [rng.randrange(10) for _ in range(30)]
        state, outs = machine.start, []
        for symbol in symbols:
            state, out = machine.step(state, symbol)
            outs.append(out)
        expected = symbols
        for part in (toxicity.reported_speech(), toxicity.negation(), toxicity.clause()):
            state, stream = part.start, []
            for symbol in expected:
                state, out = part.step(state, symbol)
                stream.append(out)
            expected = stream
        assert outs == expected


def test_stems_are_learned_not_words_of_copies(ready):
    rng = random.Random(10)
    plain = [f"{a}{b}{c}" for a in "mo ta ri lu ke so".split() for b in "na pi do ve".split() for c in "lan tor mis".split()]
    ends = ["a", "en", "or", "is", "um"]
    rows = []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(60)]
        if i % 8 == 0:
            words[::15] = [f"grobul{rng.choice(ends)}" for _ in words[::15]]
        rows.append((i, " ".join(words), int(i % 8 == 0)))
    rows += [(1000 + i, "some copied xylophonic words of no harm at all", 1) for i in range(50)]
    docs = ready.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = ready.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels)
    assert any("grobul".startswith(s[:6]) for s in lexicon.stems) and not any(s.startswith("xylo") for s in lexicon.stems)
    assert toxicity.fit(docs.limit(0), labels).stems == {} and toxicity.fit(docs, labels.limit(0)).stems == {}


def test_label_sample_holds_the_smallest_without_a_window(ready):
    ids = ready.range(5000).select("id", (F.col("id") % 7 == 0).cast("int").alias("toxic"), F.xxhash64("id").alias("h"))
    few = toxicity._smallest(ids, {1: 100, 0: 900})
    rows = sorted((r.toxic, r.h, r.id) for r in ids.collect())
    expected = [x for x in rows if x[0] == 0][:900] + [x for x in rows if x[0] == 1][:100]
    assert sorted((r.toxic, r.h, r.id) for r in few.collect()) == expected
    assert "Window" not in few._jdf.queryExecution().toString()


def test_toxicity_of_odd_documents(documents, no_documents):
    lexicon = toxicity.ToxicLexicon({"quic": 0.99})
    found = toxicity.score_documents(documents, lexicon).collect()
    assert {r.doc_id for r in found if r.predicted} == {1, 2} and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score_documents(no_documents, lexicon).count() == 0
    stay = toxicity.drop_toxic(documents, lexicon)
    assert stay.columns == documents.columns and stay.count() == documents.count() - 3


# --- Mixing ---------------------------------------------------------------------------------------------


def test_weights_meet_targets_where_they_can(ready):
    cells = [("a", "x", "p", 600), ("a", "y", "q", 100), ("b", "x", "q", 200), ("b", "y", "p", 300), ("a", "x", "q", 150), ("b", "y", "q", 0)]
    df = ready.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    shares = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 0.6, "q": 0.3, "gone": 0.1}}
    targets = {d: ready.createDataFrame(list(v.items()), f"{d} string, share double") for d, v in shares.items()}
    rows = mixing.rake(df, targets, iterations=30, most=10).collect()
    total = sum(c[3] for c in cells)
    for d, wanted in (("source", {"a": 0.5, "b": 0.5}), ("lang", {"x": 0.6, "y": 0.4}), ("topic", {"p": 2 / 3, "q": 1 / 3})):
        for value, share in wanted.items():
            assert sum(r.tokens * r.weight for r in rows if r[d] == value) == pytest.approx(share * total, rel=0.01)


def test_margin_errors_shrink_and_sweeps_end(ready):
    cells = [("a", "x", "p", 600), ("a", "y", "q", 100), ("b", "x", "q", 200), ("b", "y", "p", 300), ("a", "x", "q", 150)]
    df = ready.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    shares = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 0.6, "q": 0.4}}
    targets = {d: ready.createDataFrame(list(v.items()), f"{d} string, share double") for d, v in shares.items()}

    def worst(iterations, most=10.0):
        rows = mixing.margin_errors(mixing.rake(df, targets, iterations, most), targets).collect()
        assert len(rows) == 6
        for r in rows:
            assert r.wanted == pytest.approx(shares[r.dimension][r.value] * 1350) and r.error == pytest.approx(r.now / r.wanted - 1)
        return max(abs(r.error) for r in rows)

    assert worst(1) > 3 * worst(5)
    assert worst(2, most=1.01) > 0.05  # bounded weights can't meet these
    # tokens as wanted from the start: the first sweep moves nothing and is the last
    even = ready.createDataFrame([("a", "x", "p", 5), ("b", "y", "q", 5)], df.schema)
    half = {d: ready.createDataFrame([(v[0], 0.5), (v[1], 0.5)], f"{d} string, share double") for d, v in zip(shares, ("ab", "xy", "pq"))}
    assert {r.weight for r in mixing.rake(even, half, 1_000_000).collect()} == {1.0}


def test_topics_by_plain_counts(ready):
    marks, digits = set(mixing.MARKS), set(mixing.DIGITS)
    texts = ["", "a", "a|" * 3, "x" * 49 + "|", "x" * 48 + "|", "é" * 99 + "||", "1" + "a" * 49, "1" + "a" * 48, "\n" + "a" * 199, "\n" + "a" * 198]
    texts += ["😀" * 30 + "{}<>", "٣" * 10, "a&&b" + "c" * 300, "\r\n" * 2 + "b" * 300, "[]^-\\" * 9]

    def plain(text):
        def share(chars, least):
            return sum(c in chars for c in text) * least > len(text)

        if not text:
            return "empty"
        return "markup" if share(marks, 50) else "figures" if share(digits, 50) else "lines" if share({"\n"}, 200) else "prose"

    df = ready.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = {r.n: r.topic for r in df.select("n", mixing.form_topic(F.col("text")).alias("topic")).collect()}
    assert found == {n: plain(text) for n, text in enumerate(texts)}
    assert set(found.values()) == {"empty", "markup", "figures", "lines", "prose"}


def test_mixture_by_a_tokenizers_counts(documents):
    library = Tokenizer.from_file(WORD_BPE)
    found = mixing.mixture(documents, iterations=2, weigh=bpe.count_column(WORD_BPE)).collect()
    counts = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in documents.collect()}
    assert [r.n_tokens for r in found] == [counts[r.doc_id] for r in found]
    stay = mixing.sample_to_targets(documents, iterations=2, weigh=bpe.count_column(WORD_BPE))
    assert Counter(r.doc_id for r in stay.collect()) == Counter(r.doc_id for r in found if r.kept)


def test_mixture_of_odd_documents(documents, no_documents):
    found = mixing.mixture(documents, iterations=2).collect()
    assert len(found) == documents.count()
    assert all(0 <= r.probability <= 1 for r in found)
    assert {r.topic for r in found if r.doc_id in (3, 4)} == {"empty"}
    stay = mixing.sample_to_targets(documents, iterations=2)
    assert stay.columns == documents.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter(r.doc_id for r in found if r.kept)
    assert mixing.mixture(no_documents, iterations=1).count() == 0


# --- Chat templates ------------------------------------------------------------------------------------------


def test_templates_render_fold_and_refuse():
    template = chat_template.Template(
        "{# note #}{% set who = 'A' ~ (1 + 1) %}{% for m in messages %}{% if loop.first and m.role != 'user' %}?{% elif m['role'] == 'user' %}"
        "U{{ loop.index0 }}:{{ m.text | trim | upper }}{% else %}{% generation %}{{ m.text }}{% endgeneration %}{% endif %}"
        "{% if not loop.last %}|{% endif %}{% endfor %}{{ 'x' ~ 2 | escape }}"
    )
    messages = [{"role": "user", "text": " hi "}, {"role": "assistant", "text": "yo"}]
    assert template.render(messages=messages) == ("U0:HI|yox2", [(6, 8)])
    folded = chat_template.fold(chat_template.parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}no{% else %}c{% endif %}{{ x }}"))
    assert folded.parts[0] == chat_template.Put(chat_template.Const("ab1c")) and len(folded.parts) == 2
    for bad in ("{% for x in y %}", "{{ 1 + }}", "{% else %}", "{{ a | system }}", "{{ f(1) }}", "{% import os %}"):
        with pytest.raises(chat_template.TemplateError):
            chat_template.Template(bad)
    for reach in ("{{ x.__class__ }}", "{{ 'a'.upper }}", "{{ messages.append }}"):
        with pytest.raises(chat_template.TemplateError):
            chat_template.Template(reach).render(x=object(), messages=[])


@pytest.mark.parametrize(
    "source",
    ["{{ '%5000000s' % 'x' }}", "{{ 5 % 0 }}", "{% for x in 5 %}a{% endfor %}", "{{ " + "(" * 3000 + "1" + ")" * 3000 + " }}",
     "{{ " + "not " * 3000 + "1 }}", "{{ " + "1 + " * 3000 + "1 }}", "{{ 1 + 'a' }}", "{{ 5|length }}", "{{ 'open }}", "{{ 1"],
)
def test_what_a_template_may_not_do_is_its_error(source):
    with pytest.raises(chat_template.TemplateError):
        chat_template.Template(source).render(messages=[])


def test_marks_inside_texts_end_no_tag():
    assert chat_template.Template("{{ '}}' }}{% if '%}' == \"%}\" %}a{% endif %}{{ 7 % 4 }}").render()[0] == "}}a3"


def test_conversations_come_back_whole(ready):
    odd = [chat_template.CONTROL_CONVERSATION, "", None, "<turn>x<text>y</turn>\n", "\\", "\\\\<", "<", "é\n\n😀" * 50]
    rows = [(1, i, ("assistant", "user", None)[i % 3], text, "z") for i, text in enumerate(odd)]
    rows += [(2, None, "user", "a", "z"), (2, None, "user", "a", "z"), (None, 1, "assistant", "b", "z"), (3, 0, "a<ssistant\\", "t" * 100_000, "z")]
    df = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat_template.format_conversations(df)
    got = {r.conv_id: r for r in chat_template.read_back(formatted).collect()}
    for conv in (1, 2, None, 3):
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        row = got[conv]
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == (len(turns), sha(said), len(loss), sha(loss))
    assert chat_template.read_back(chat_template.format_conversations(df.limit(0))).count() == 0
