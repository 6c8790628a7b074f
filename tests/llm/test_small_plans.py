"""What a loop stores comes from plans that do not grow with its steps, as the driver holds them."""

from outagelens.llm import mixing


def test_raking_joins_the_sums_once_a_step(ready, monkeypatch):
    df = ready.createDataFrame(
        [("a", "en", "x", 100), ("a", "de", "y", 50), ("b", "en", "y", 30), ("c", "de", "x", 20), ("d", "fr", "x", 0)],
        "source string, lang string, topic string, tokens long",
    )
    targets = {
        "source": ready.createDataFrame([("a", 0.4), ("b", 0.4), ("c", 0.2), ("d", 0.5)], "source string, share double"),
        "lang": ready.createDataFrame([("en", 0.5), ("de", 0.5)], "lang string, share double"),
        "topic": ready.createDataFrame([("x", 0.6), ("y", 0.4)], "topic string, share double"),
    }
    joins, store = {}, mixing.kept

    def kept(rows, name):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        joins.setdefault(name, []).append(sum("Join " in line for line in plan.splitlines()))
        return store(rows, name)

    monkeypatch.setattr(mixing, "kept", kept)
    rows = mixing.rake(df, targets, iterations=3, most=10).collect()
    assert set(joins["raked"]) == {1}  # the sweep's three steps in one plan would be 14
    assert max(max(counts) for counts in joins.values()) <= len(targets)
    assert [row.asDict().keys() for row in rows] == [{"source", "lang", "topic", "tokens", "weight"}] * 5

    # The same steps in plain Python.
    weight = {(r.source, r.lang, r.topic): 1.0 for r in df.collect()}
    tokens = {(r.source, r.lang, r.topic): r.tokens for r in df.collect()}
    shares = {name: {row[0]: row[1] for row in table.collect()} for name, table in targets.items()}
    del shares["source"]["d"]  # has no tokens
    for _ in range(3):
        for place, name in enumerate(("source", "lang", "topic")):
            now: dict[str, float] = {}
            for cell, n in tokens.items():
                now[cell[place]] = now.get(cell[place], 0.0) + n * weight[cell]
            for cell in weight:
                have, total = now[cell[place]], sum(tokens.values())
                wanted = shares[name].get(cell[place], 0.0) / sum(shares[name].values()) * total
                weight[cell] = min(weight[cell] * (wanted / have if have > 0 else 1.0), 10.0)
    assert {(r.source, r.lang, r.topic): round(r.weight, 9) for r in rows} == {cell: round(x, 9) for cell, x in weight.items()}
