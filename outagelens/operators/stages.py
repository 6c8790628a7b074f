"""Comparison of the tables at the stages of a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed


def column_profile(df: DataFrame) -> DataFrame:
    """column_name, rows and non_null of each column, from one aggregate."""
    counts = [F.count(F.col(name)).alias(f"_c{i}") for i, name in enumerate(df.columns)]
    entries = [
        F.struct(
            F.lit(name).alias("column_name"), F.col("_rows").alias("rows"), F.col(f"_c{i}").alias("non_null")
        )
        for i, name in enumerate(df.columns)
    ]
    return df.agg(F.count("*").alias("_rows"), *counts).select(F.inline(F.array(*entries)))


def stage_profile(
    stages: Mapping[str, DataFrame], derived_words: Sequence[str] = fixed.DERIVED_NAME_WORDS
) -> DataFrame:
    """One row per column name: its counts at each stage, and what happened to it.

    ``change`` lists the stages that removed or added the column, ``derived`` tells
    whether its name looks like a derived column. ``<stage>_rows`` and
    ``<stage>_non_null`` are NULL where the stage lacks the column.
    """
    profiles = [
        column_profile(df).withColumn("stage", F.lit(stage)) for stage, df in stages.items()
    ]
    names = list(stages)
    table = reduce(DataFrame.unionByName, profiles).groupBy("column_name").agg(
        *[
            F.max(F.when(F.col("stage") == stage, F.col(measure))).alias(f"{stage}_{measure}")
            for stage in names
            for measure in ("rows", "non_null")
        ]
    )
    changes = []
    for before, after in zip(names, names[1:]):
        was, is_now = F.col(f"{before}_rows").isNotNull(), F.col(f"{after}_rows").isNotNull()
        changes.append(F.when(was & ~is_now, F.lit(f"removed in {after}")))
        changes.append(F.when(~was & is_now, F.lit(f"added in {after}")))
    lowered = F.lower("column_name")
    derived = reduce(lambda a, b: a | b, [lowered.contains(word) for word in derived_words])
    return table.withColumns({"change": F.concat_ws(", ", *changes), "derived": derived})


def stage_sizes(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each stage."""
    sizes = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(stage).alias("stage"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for stage, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, sizes)
