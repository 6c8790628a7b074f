"""Python workers hold one model, bounded counts and small tries."""

import numpy as np
import pandas as pd

from outagelens.llm import collocations, common, toxicity


def test_a_worker_keeps_one_model():
    made = []
    one = common.model_of("a", "x", lambda: made.append("ax") or object())
    assert common.model_of("a", "x", object) is one and made == ["ax"]
    scorer = toxicity.scorer_of(toxicity.ToxicLexicon({"grob": 0.9}))
    assert len(common._MODEL) == 1 and toxicity.scorer_of(toxicity.ToxicLexicon({"grob": 0.9})) is scorer
    assert toxicity.scorer_of(toxicity.ToxicLexicon({"grob": 0.8})) is not scorer and len(common._MODEL) == 1


def test_counts_are_handed_on_in_bounded_parts(monkeypatch):
    letters = "abcdefghijklmnopqrst"
    rows = pd.DataFrame({"text": [f"{letters[i % 20] * 3}{letters[i // 20]}wort grobula haus" for i in range(60)], "toxic": [i % 2 for i in range(60)]})
    whole = list(toxicity._stem_counts(iter([rows])))
    monkeypatch.setattr(toxicity, "COUNTED", 20)
    parts = list(toxicity._stem_counts(iter([rows])))
    assert len(whole) == 1 and len(parts) > 10 and max(map(len, parts)) < 50
    summed = pd.concat(parts).groupby("stem").sum().sort_index()
    pd.testing.assert_frame_equal(summed, whole[0].set_index("stem").sort_index(), check_names=False)


def test_a_trie_has_two_arrays():
    rng = np.random.default_rng(7)
    rows = np.unique(rng.integers(1, 5_000, size=(3_000, 3)).astype(np.int32), axis=0)
    trie = collocations.DoubleArray(rows)
    arrays = [x for x in vars(trie).values() if isinstance(x, np.ndarray) and x.ndim == 1]
    assert len(arrays) == 2
    ids = np.concatenate([rows.ravel(), rng.integers(0, 5_000, size=9_000).astype(np.int32)])
    known = {tuple(row): i for i, row in enumerate(rows.tolist())}
    expected = [known.get(tuple(ids[i : i + 3].tolist()), -1) if i + 3 <= len(ids) else -1 for i in range(len(ids))]
    assert trie.accepted(ids).tolist() == expected
