"""Mixing sources, languages and topics to target shares by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). The cells' weights are raked: each step
scales them so that one dimension's weighted tokens meet its target shares, and the dimensions
take turns until all are met together, so cells keep the dependence the corpus has. A document
is kept with its cell's weight times the share of tokens asked for. No document is taken twice:
weights are bounded where that probability is 1, in each step, and the other cells make up for
it. Where the corpus has enough of everything, the sample has the target shares in expectation.

Only cells and margins are aggregated or joined, never collected; sums combine before a shuffle,
so a source that holds a third of all documents is no heavier than others.

What a text weighs is a column function the caller may choose: the estimate by bytes, or the
tokens some tokenizer really makes of it. The texts are weighed in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, kept, whole_text

DIMENSIONS = ("source", "lang", "topic")
ITERATIONS = 8
#: A sweep over all dimensions that moves no weight by more than this is the last one.
TOLERANCE = 1e-12
#: Targets are the corpus' own shares to this power, which lifts small ones.
ALPHA = 0.5
#: Share of all tokens that the sample is to have.
SHARE = 0.5
NO_VALUE = "(none)"
SEED = "mix-1"

# Fixed values of the topic rule: characters of markup, and least shares of characters (1 / n).
MARKS = "|#*&$%@<>{}"
DIGITS = "0123456789"
MARK_SHARE, DIGIT_SHARE, LINE_SHARE = 50, 50, 200


Weigher = Callable[[Column], Column]


def token_weight(text: Column) -> Column:
    """Tokens of a text, estimated from its bytes (four for each, rounded up)."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def form_topic(text: Column) -> Column:
    """The topic by form of a whole text: empty, markup, figures, lines or prose."""
    size = F.length(text)

    def count(characters: str) -> Column:
        return size - F.length(F.regexp_replace(text, f"[{characters}]+", ""))

    lines = size - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (
        F.when(size == 0, "empty")
        .when(count(MARKS) * MARK_SHARE > size, "markup")
        .when(count(DIGITS) * DIGIT_SHARE > size, "figures")
        .when(lines * LINE_SHARE > size, "lines")
        .otherwise("prose")
    )


def cells_of(docs: DataFrame) -> DataFrame:
    """The documents' dimensions (a null is ``(none)``) with the tokens of each cell."""
    return docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))


def tempered_targets(cells: DataFrame, dimension: str, alpha: float = ALPHA) -> DataFrame:
    """dimension, share: the shares of the cells' tokens to the power of alpha, adding up to 1."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("_sum"))
    total = sums.agg(F.sum(F.pow("_sum", F.lit(alpha)))).first()[0] or 0.0
    share = F.pow("_sum", F.lit(alpha)) / total if total else F.lit(0.0)
    return sums.select(dimension, share.alias("share"))


def _wanted(cells: DataFrame, targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """(dimension, wanted) of each dimension: the tokens its values are to have, of those that have any."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    wanted = {}
    for dimension, shares in targets.items():
        present = cells.groupBy(dimension).agg(F.sum("tokens").alias("_tokens")).filter("_tokens > 0")
        shares = kept(shares.join(present, dimension, "left_semi"), f"targets-{dimension}")
        sums = shares.agg(F.sum("share")).first()[0] or 1.0
        wanted[dimension] = shares.select(dimension, (F.col("share") / sums * total).alias("wanted"))
    return wanted


def _weighted(cells: DataFrame, dimension: str) -> DataFrame:
    return cells.groupBy(dimension).agg(F.sum(F.col("tokens") * F.col("weight")).alias("now"))


def rake(
    cells: DataFrame,
    targets: dict[str, DataFrame],
    iterations: int = ITERATIONS,
    most: float = 1 / SHARE,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The cells with ``weight``, at most ``most``; weighted tokens approach the targets.

    ``targets`` has a table (dimension, share) for each dimension. Values that have a target but
    no tokens can't be met: the shares of the others are scaled up to add to 1. Values without a
    target get weight 0. Cells without tokens keep the factors of their other dimensions.

    Ends after so many sweeps over all dimensions, or with the one that moves no weight by more
    than ``tolerance``. `margin_errors` tells how far the margins then are from their targets.
    """
    cells = kept(cells.withColumn("weight", F.lit(1.0)), "cells")
    goals = {dimension: f"wanted_{dimension}" for dimension in targets}
    for dimension, wanted in _wanted(cells, targets).items():
        cells = cells.join(wanted.withColumnRenamed("wanted", goals[dimension]), dimension, "left")
    cells = kept(cells, "cells-wanted")
    for _ in range(iterations):
        cells = cells.withColumn("before", F.col("weight"))
        for dimension, goal in goals.items():
            # Stored after each step: else a step's plan holds those before it twice, and all of them weigh on the driver.
            cells = kept(_scaled(cells, dimension, goal, most), "raked")
        moved = cells.agg(F.max(F.abs(F.col("weight") - F.col("before")))).first()[0]
        cells = cells.drop("before")
        if moved is None or moved <= tolerance:
            break
    return cells.drop(*goals.values())


def _scaled(cells: DataFrame, dimension: str, goal: str, most: float) -> DataFrame:
    """The cells with weights, at most ``most``, that meet the dimension's wanted tokens, which the column ``goal`` has."""
    now = F.sum(F.col("tokens") * F.col("weight"))
    sums = cells.groupBy(dimension).agg(now.alias("_now"), F.max(goal).alias("_goal"))
    factor = F.when(F.col("_now") > 0, F.coalesce("_goal", F.lit(0.0)) / F.col("_now")).otherwise(1.0)
    weight = F.least(F.col("weight") * F.col("_factor"), F.lit(float(most)))
    scaled = cells.join(sums.select(dimension, factor.alias("_factor")), dimension).withColumn("weight", weight)
    return scaled.select(*cells.columns)


def margin_errors(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """dimension, value, wanted, now, error: weighted tokens of raked cells against their targets.

    ``error`` is now / wanted - 1. Values without tokens, or without a target, have no row, nor has
    an empty table. Errors stay where bounded weights can't give a value what it is to have.
    """
    rows = []
    for dimension, wanted in _wanted(cells, targets).items():
        both = _weighted(cells, dimension).join(wanted, dimension)
        error = (F.col("now") / F.col("wanted") - 1).alias("error")
        rows.append(both.select(F.lit(dimension).alias("dimension"), F.col(dimension).alias("value"), "wanted", "now", error))
    return reduce(DataFrame.unionByName, rows)


def chance(key: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 (excluded) that depends on the key and the seed only."""
    digest = F.md5(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), "UTF-8"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def described(docs: DataFrame, weigh: Weigher = token_weight) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens of every document (a null value is ``(none)``, a null text empty)."""
    text = whole_text(docs["text"])
    return docs.select(
        docs["doc_id"],
        *(F.coalesce(docs[name].cast("string"), F.lit(NO_VALUE)).alias(name) for name in ("source", "lang")),
        form_topic(text).alias("topic"),
        weigh(text).cast("long").alias("n_tokens"),
    )


def calibrated(rows: DataFrame, alpha: float = ALPHA, iterations: int = ITERATIONS, share: float = SHARE) -> DataFrame:
    """source, lang, topic, weight, probability of all cells of `described` rows, for tempered targets."""
    cells = kept(cells_of(rows), "token-cells")
    targets = {dimension: tempered_targets(cells, dimension, alpha) for dimension in DIMENSIONS}
    raked = rake(cells, targets, iterations, 1 / share)
    return raked.select(*DIMENSIONS, "weight", (F.col("weight") * share).alias("probability"))


def mixture(
    docs: DataFrame,
    alpha: float = ALPHA,
    iterations: int = ITERATIONS,
    share: float = SHARE,
    seed: str = SEED,
    weigh: Weigher = token_weight,
) -> DataFrame:
    """Per document: doc_id, source, lang, topic, n_tokens, weight, probability, kept.

    The texts are read once; what the cells and the rows need of them is stored.

    Null source and lang are values of their own, ``(none)``; a null text is empty and has no
    tokens. Rows with one id share their fate within a cell; repeated rows keep a row each.
    Other columns are ignored; an empty table gives no rows.
    """
    described_rows = kept(described(docs, weigh), "mixing-rows")
    rows = described_rows.join(calibrated(described_rows, alpha, iterations, share), list(DIMENSIONS))
    return rows.select(
        "doc_id",
        *DIMENSIONS,
        "n_tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        (chance(F.col("doc_id"), seed) < F.col("probability")).alias("kept"),
    )


def sample_to_targets(
    docs: DataFrame,
    alpha: float = ALPHA,
    iterations: int = ITERATIONS,
    share: float = SHARE,
    seed: str = SEED,
    weigh: Weigher = token_weight,
) -> DataFrame:
    """The documents that `mixture` keeps, with all their columns, whatever their names.

    Texts are weighed once, for the cells; the rows then need their cell only.
    """
    rates = calibrated(described(docs, weigh), alpha, iterations, share)
    text = whole_text(docs["text"])
    cell = {"source": docs["source"], "lang": docs["lang"]}
    cell = {name: F.coalesce(value.cast("string"), F.lit(NO_VALUE)) for name, value in cell.items()}
    cell["topic"] = form_topic(text)
    names = {name: free_name(docs, f"cell_{name}") for name in DIMENSIONS}
    rate = free_name(docs, "cell_rate")
    marked = docs.withColumns({names[name]: cell[name] for name in DIMENSIONS})
    rates = rates.select(*(F.col(name).alias(names[name]) for name in DIMENSIONS), F.col("probability").alias(rate))
    found = marked.join(rates, list(names.values())).filter(chance(F.col("doc_id"), seed) < F.col(rate))
    return found.select(*docs.columns)


def mixture_sql(alpha: float = ALPHA, iterations: int = ITERATIONS, share: float = SHARE, seed: str = SEED) -> str:
    """DuckDB SQL for the rows of `mixture` over ``documents``."""

    def count(characters: str) -> str:
        return f"(length(text) - length(translate(text, {characters}, '')))"

    steps = [
        f"""docs AS MATERIALIZED (
            SELECT doc_id, coalesce(source, '{NO_VALUE}') AS source, coalesce(lang, '{NO_VALUE}') AS lang,
                   CASE WHEN length(text) = 0 THEN 'empty'
                        WHEN {count(f"'{MARKS}'")} * {MARK_SHARE} > length(text) THEN 'markup'
                        WHEN {count(f"'{DIGITS}'")} * {DIGIT_SHARE} > length(text) THEN 'figures'
                        WHEN {count("chr(10)")} * {LINE_SHARE} > length(text) THEN 'lines'
                        ELSE 'prose' END AS topic,
                   CAST(ceil(strlen(text) / 4.0) AS BIGINT) AS n_tokens
            FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents))""",
        """c0 AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens, 1.0::DOUBLE AS weight
            FROM docs GROUP BY ALL)""",
        *(
            f"""t_{d} AS MATERIALIZED (
            SELECT {d}, pow(s, {alpha}) / sum(pow(s, {alpha})) OVER () * sum(s) OVER () AS wanted
            FROM (SELECT {d}, sum(tokens) AS s FROM c0 GROUP BY {d}))"""
            for d in DIMENSIONS
        ),
    ]
    n = 0
    for _ in range(iterations):
        for d in DIMENSIONS:
            steps.append(
                f"""c{n + 1} AS MATERIALIZED (
                SELECT source, lang, topic, tokens,
                       least(weight * CASE WHEN now > 0 THEN wanted / now ELSE 1 END, {1 / share}) AS weight
                FROM (SELECT *, sum(tokens * weight) OVER (PARTITION BY {d}) AS now FROM c{n}) JOIN t_{d} USING ({d}))"""
            )
            n += 1
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) AS weight, round(p, 6) AS probability,
               CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE)
                   / 4503599627370496.0 < p AS kept
        FROM docs JOIN (SELECT *, weight * {share} AS p FROM c{n}) USING (source, lang, topic)"""
