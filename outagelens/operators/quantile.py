"""Exact median with bounded state, and quantile sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import hours_of_micros
from ..sources.scratch import stored

MICROS_PER_HOUR = 3_600_000_000.0
# Values are narrowed down by 20 bits at a time: 60 bits hold every span between two
# timestamps in microseconds, and one level has at most about a million steps.
STEP_BITS = 20
LEVELS = 3
# Most groups whose state is broadcast.
BROADCAST_GROUPS = 10_000
# Group column where there is no other.
ALL_ROWS = "_all"


def micros_of(hours: Column) -> Column:
    """Hours as whole microseconds."""
    return F.round(hours * MICROS_PER_HOUR).cast("bigint")


def exact_median(df: DataFrame, hours: Column, by: Sequence[str], name: str = "median") -> DataFrame:
    """Median of ``hours`` per group: the mean of the two middle values.

    The counts of the values are stored when the plan is built, as every level reads them.
    Hours are whole microseconds.
    """
    keys = [F.col(name) for name in by]
    counted = df.filter(hours.isNotNull()).groupBy(*keys, micros_of(hours).alias("_value")).agg(F.count("*").alias("_n"))
    return median_of_counts(stored(counted, "median"), by, name)


def median_of_counts(counts: DataFrame, by: Sequence[str], name: str = "median") -> DataFrame:
    """Median per group from a stored table of the group, ``_value`` in microseconds and its count ``_n``.

    The built-in ``median`` keeps all distinct values of a group in one task. Here the middle
    value is found by counting ranges that get finer with each level. The state of one row per
    group meets the counts by broadcast if the groups, which are counted, are few, else by a
    shuffled join. Without ``by`` all rows are one group, and there is nothing to count.
    """
    # One group for all rows is a column too, so that counts and state meet on equal keys.
    keys = [F.col(name) for name in by] or [(F.col("_value") % 1).cast("int").alias(ALL_ROWS)]
    counts = counts.filter(F.col("_value").isNotNull()).select(*keys, "_value", "_n")
    few = not by or counts.select(*by).distinct().limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    by = list(by) or [ALL_ROWS]
    # _rank: how many values come before the lower middle one.
    state = counts.groupBy(*by).agg(F.sum("_n").alias("_total")).select(
        *by,
        (F.col("_total") % 2 == 0).alias("_even"),
        F.floor((F.col("_total") - 1) / 2).alias("_rank"),
        F.lit(None).cast("bigint").alias("_prefix"),
    )
    for level in reversed(range(LEVELS)):
        state = _narrow(counts, state, by, few, level * STEP_BITS)
    return _middle(counts, state, by, few, name).drop(ALL_ROWS)


def hour_aggregates(mean: str, least: str | None = None, most: str | None = None) -> list[Column]:
    """Aggregates over such a table: mean, smallest and largest hours."""
    value, n = F.col("_value"), F.col("_n")
    total = F.sum(value.cast("decimal(19, 0)") * n.cast("decimal(19, 0)")).cast("double")
    found = [(total / MICROS_PER_HOUR / F.sum(F.when(value.isNotNull(), n))).alias(mean)]
    ends = ((F.min, least), (F.max, most))
    return found + [hours_of_micros(end(value)).alias(name) for end, name in ends if name is not None]


# --- Sketches ------------------------------------------------------------------------------

#: Size of a sketch: the rank of an answer is off by less than 0.0013 of all values with a
#: probability of 99 %. `RANK_ERROR` is what callers may rely on.
SKETCH_SIZE = 4_096
RANK_ERROR = 0.01


def hour_sketches(df: DataFrame, hours: Column, by: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """``by``, a quantile sketch of the known hours, and their number.

    A sketch takes a few ten kilobytes whatever the number of rows. Sketches of days or files can
    be stored and merged later, so older rows need not be read again.
    """
    known = F.when(~F.isnan(hours), hours)
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(known, size).alias("sketch"), F.count(known).alias("n"))


def merge_sketches(sketches: DataFrame, by: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", size).alias("sketch"), F.sum("n").alias("n"))


def sketch_quantile(rank: float) -> Column:
    """The hours at a rank from 0 to 1; NULL for a sketch without values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(rank)))


def _with_state(counts: DataFrame, state: DataFrame, by: list[str], few: bool) -> DataFrame:
    same = [F.col(f"c.{name}").eqNullSafe(F.col(f"s.{name}")) for name in by]
    side = F.broadcast(state) if few else state
    joined = counts.alias("c").join(side.alias("s"), same)
    return joined.drop(*[F.col(f"s.{name}") for name in by])


def _narrow(counts: DataFrame, state: DataFrame, by: list[str], few: bool, shift: int) -> DataFrame:
    """Find the range of 2**shift values that holds the wanted rank."""
    prefix = F.shiftright("_value", shift)
    in_range = F.col("_prefix").isNull() | (F.shiftright(prefix, STEP_BITS) == F.col("_prefix"))
    ranges = (
        _with_state(counts, state, by, few)
        .filter(in_range)
        .groupBy(*by, "_even", "_rank", prefix.alias("_range"))
        .agg(F.sum("_n").alias("_size"))
    )
    so_far = F.sum("_size").over(Window.partitionBy(*by).orderBy("_range"))
    before = F.col("_so_far") - F.col("_size")
    return (
        ranges.withColumn("_so_far", so_far)
        .filter((before <= F.col("_rank")) & (F.col("_so_far") > F.col("_rank")))
        .select(
            *by,
            "_even",
            (F.col("_rank") - before).alias("_rank"),
            F.col("_range").alias("_prefix"),
        )
    )


def _middle(counts: DataFrame, state: DataFrame, by: list[str], few: bool, name: str) -> DataFrame:
    """The lower middle value, averaged with the next one for an even count."""
    value, lower = F.col("_value"), F.col("_prefix")
    ends = (
        _with_state(counts, state, by, few)
        .groupBy(*by, "_even", "_rank", "_prefix")
        .agg(
            F.sum(F.when(value == lower, F.col("_n"))).alias("_same"),
            F.min(F.when(value > lower, value)).alias("_next"),
        )
    )
    next_differs = F.col("_even") & (F.col("_rank") + 1 >= F.col("_same"))
    upper = F.when(next_differs, F.col("_next")).otherwise(lower)
    return ends.select(*by, ((hours_of_micros(lower) + hours_of_micros(upper)) / 2).alias(name))
