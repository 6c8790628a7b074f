"""More long lists than are broadcast: cut by key, and only the largest keys are spread."""

import pytest
from pyspark.sql import functions as F

from outagelens.operators import packing, skew


@pytest.fixture
def rows(spark):
    sizes = {"a": 50, "b": 30, "c": 9, "d": 3, "e": 1}
    return spark.createDataFrame([(k, i, f"{k}{i}") for k, n in sizes.items() for i in range(n)] + [(None, 0, "x"), ("", 0, "y")], "k string, v int, t string")


def many(rows, piece_rows, piece_bytes=skew.PIECE_BYTES):
    return skew.hot_of(rows, "k", piece_rows, piece_bytes, broadcast_keys=1)


def test_only_keys_too_large_for_a_task_are_salted(rows, monkeypatch):
    plain = many(rows, 4)
    assert plain.values == () and sorted(r.k for r in plain.table.collect()) == ["a", "b", "c"]
    normal, hot = skew.split_hot(rows, "k", "v", hot=plain)
    assert "explode" not in hot._jdf.queryExecution().toString() and hot.count() == 89 and normal.count() == 4
    monkeypatch.setattr(skew, "TASK_ROWS", 40)
    salted = many(rows, 4)
    assert salted.values == ("a",)
    normal, hot = skew.split_hot(rows, "k", "v", salts=8, hot=salted)
    assert hot.columns == rows.columns and hot.count() == 89 and sorted(r.t for r in normal.collect()) == ["d0", "d1", "d2", "e0"]


@pytest.mark.parametrize("piece_rows, piece_bytes, task_rows", [(4, 1 << 24, 1_000_000), (4, 1 << 24, 40), (1_000, 7, 1_000_000), (8, 20, 25)])
def test_many_long_lists_are_whole_and_in_order(rows, monkeypatch, piece_rows, piece_bytes, task_rows):
    monkeypatch.setattr(skew, "TASK_ROWS", task_rows)
    hot = many(rows, piece_rows, piece_bytes)
    assert hot.table is not None
    found = packing.pack_ordered(rows, "k", ["v"], F.col("v"), "items", piece_rows, piece_bytes, hot).orderBy("k", "part").collect()
    lists = {}
    for row in found:
        lists.setdefault(row.k, []).append(row)
    assert {k: [v for r in parts for v in r["items"]] for k, parts in lists.items()} == {
        k: list(range(n)) for k, n in {"a": 50, "b": 30, "c": 9, "d": 3, "e": 1}.items()}
    for parts in lists.values():
        assert [r.part for r in parts] == list(range(len(parts))) and all(1 <= len(r["items"]) <= piece_rows for r in parts)
        assert {r.items_total for r in parts} == {sum(len(r["items"]) for r in parts)}
    if task_rows > 50 and piece_bytes > 1_000:  # without ranges no piece is cut early
        assert len(lists["a"]) == 13 and len(lists["d"]) == 1
