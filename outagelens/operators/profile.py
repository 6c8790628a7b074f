"""Counts, rates, distributions and trends over the enriched incident table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .quantile import hour_aggregates, hour_sketches, median_of_counts, micros_of, sketch_quantile


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / whole


def total_incidents(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_incidents"))


def active_resolved_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if("isActive").alias("active_incidents"),
        F.count_if(~F.col("isActive")).alias("resolved_incidents"),
    )


def high_impact_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("isHighImpact").alias("high_impact_incidents"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, without NULL."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their percentage of all rows, NULL values included in the total.

    The counts are stored when the plan is built; shares and total are of them alone.
    """
    counts = stored(df.groupBy(column).agg(F.count("*").alias("n")), "value-counts")
    total = counts.agg(F.sum("n")).scalar()
    shares = counts.withColumn("pct", percent(F.col("n"), total))
    return shares.filter(F.col(column).isNotNull())


def top_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(k)


def sla_breach_rate(df: DataFrame) -> DataFrame:
    """Share of breaches among incidents with known hours; no rate if there are none."""
    counts = df.filter(F.col("resolutionTimeHrs").isNotNull()).agg(
        F.count("*").alias("resolved"),
        F.count_if("slaBreach").alias("breached"),
        F.count_if(~F.col("slaBreach")).alias("within_sla"),
    )
    rate = F.when(F.col("resolved") > 0, percent(F.col("breached"), F.col("resolved")))
    return counts.withColumn("sla_breach_rate", rate)


def resolution_stats(df: DataFrame) -> DataFrame:
    """Mean, exact median, fastest and longest hours, all of one stored count of the values."""
    counted = df.groupBy(micros_of(F.col("resolutionTimeHrs")).alias("_value")).agg(F.count("*").alias("_n"))
    counts = stored(counted, "hour-counts")
    median = median_of_counts(counts, [], "median_hours").select("median_hours").scalar()
    stats = counts.agg(*hour_aggregates("avg_hours", "fastest_hours", "longest_hours"))
    return stats.withColumn("median_hours", median)


def approximate_hours(df: DataFrame, by: Sequence[str] = (), ranks: Sequence[float] = (0.5,)) -> DataFrame:
    """Per group the number of known hours, and the hours at each rank, from a sketch.

    One pass with a bounded state for each group; ranks are exact up to `RANK_ERROR`.
    """
    sketches = hour_sketches(df, F.col("resolutionTimeHrs"), by)
    return sketches.select(*by, "n", F.array(*map(sketch_quantile, ranks)).alias("hours"))


def user_impact_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("userImpactEstimate").alias("total_users"),
        F.avg("userImpactEstimate").alias("avg_users"),
    )


def weekly_trend(df: DataFrame, weeks: int | None = None) -> DataFrame:
    """Incidents per week number, with ``weeks`` the first ones only. Years fall together."""
    trend = value_counts(df, "week").orderBy("week")
    return trend if weeks is None else trend.limit(weeks)


METRIC_FLAGS = {"active_incidents": "isActive", "high_impact_incidents": "isHighImpact", "sla_breaches": "slaBreach"}


def _metric_counts(processed: DataFrame) -> list[Column]:
    has = processed.columns.__contains__
    flags = [(F.count_if(column) if has(column) else F.count(F.lit(None))).alias(name) for name, column in METRIC_FLAGS.items()]
    return [F.count(F.lit(1)).alias("processed_record_count"), *flags]


def _metrics_row(counts: DataFrame, at: Column | None, added: int) -> DataFrame:
    return counts.select(
        (F.localtimestamp() if at is None else at).alias("timestamp"),
        "raw_record_count",
        "processed_record_count",
        F.lit(added).alias("columns_added"),
        *METRIC_FLAGS,
    )


def run_metrics(raw: DataFrame, processed: DataFrame, at: Column | None = None) -> DataFrame:
    """One row about one run of the enrichment, from its stored tables."""
    raw_count = raw.agg(F.count("*")).scalar()
    counts = processed.agg(*_metric_counts(processed)).withColumn("raw_record_count", raw_count)
    return _metrics_row(counts, at, len(processed.columns) - len(raw.columns))


class ObservedRun:
    """The same metrics, counted while the enriched table is written.

    ``raw`` and ``processed`` return the tables to go on with. After the write ``metrics`` gives
    the row without reading either table. Rows that a lost executor makes a task write again
    count once, as long as no shuffle stands between the tables and the write.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._raw, self._processed = Observation(), Observation()
        self._columns = 0

    def raw(self, raw: DataFrame) -> DataFrame:
        self._columns -= len(raw.columns)
        return raw.observe(self._raw, F.count(F.lit(1)).alias("raw_record_count"))

    def processed(self, processed: DataFrame) -> DataFrame:
        self._columns += len(processed.columns)
        return processed.observe(self._processed, *_metric_counts(processed))

    def metrics(self, at: Column | None = None) -> DataFrame:
        counts = {**self._raw.get, **self._processed.get}
        row = self._spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))
        return _metrics_row(row, at, self._columns)


def category_profile(df: DataFrame) -> DataFrame:
    """Per category: incidents, flags, breach rate, mean and median hours.

    All come from one stored count by category and hours.
    """
    flags = {"active": "isActive", "high_impact": "isHighImpact", "breached": "slaBreach"}
    value = micros_of(F.col("resolutionTimeHrs")).alias("_value")
    counted = df.groupBy("patternCategory", value).agg(
        F.count("*").alias("_n"), *[F.count_if(column).alias(name) for name, column in flags.items()]
    )
    counts = stored(counted, "category-hours")
    known = F.when(F.col("_value").isNotNull(), F.col("_n")).otherwise(0)
    groups = counts.groupBy("patternCategory").agg(
        F.sum("_n").alias("incidents"),
        F.sum("active").alias("active"),
        F.sum("high_impact").alias("high_impact"),
        F.sum(known).alias("resolved"),
        F.sum("breached").alias("breached"),
        *hour_aggregates("avg_hours"),
    )
    rate = F.when(F.col("resolved") > 0, percent(F.col("breached"), F.col("resolved")))
    medians = median_of_counts(counts, ["patternCategory"], "median_hours")
    return groups.withColumn("sla_breach_rate", rate).join(medians, "patternCategory", "left")


# Distribution columns of the analysis, and how many values each shows (None: all).
ANALYSIS_COLUMNS = (
    ("patternCategory", "pattern_distribution", None),
    ("assignment_group", "assignment_groups", 5),
    ("priority", "priority_distribution", None),
    ("location", "top_locations", 5),
)


def analyze_incidents(df: DataFrame, columns: Sequence = ANALYSIS_COLUMNS) -> DataFrame:
    """The whole analysis as rows of metric, key, n and value.

    Scalars have no key and are there for an empty table too, counts as 0. One pass counts
    all distributions, and the values of the hours for the median, by grouping sets; its
    result is stored when the plan is built, and every metric reads that alone.
    """
    columns = [*columns, ("week", "weekly_trend", None)]
    if "week" in df.columns:
        df = df.withColumn("week", F.col("week").cast("string"))
    shown = [entry for entry in columns if entry[0] in df.columns]
    names = [name for name, _, _ in shown]
    hours = F.col("resolutionTimeHrs")
    df = df.withColumn("_value", micros_of(hours))
    by = [*names, "_value"]
    grouped = df.groupingSets([[name] for name in by] + [[]], *by).agg(
        F.grouping_id().alias("_set"),
        F.count("*").alias("total_incidents"),
        F.count_if("isActive").alias("active_incidents"),
        F.count_if(~F.col("isActive")).alias("resolved_incidents"),
        F.count_if("isHighImpact").alias("high_impact_incidents"),
        F.count(hours).alias("_resolved"),
        F.count_if("slaBreach").alias("sla_breached"),
        F.count_if(~F.col("slaBreach") & hours.isNotNull()).alias("within_sla"),
        F.avg(hours).alias("avg_resolution_hours"),
        F.min(hours).alias("fastest_resolution_hours"),
        F.max(hours).alias("longest_resolution_hours"),
        F.sum("userImpactEstimate").alias("total_users"),
        F.avg("userImpactEstimate").alias("avg_users"),
    )
    grouped = stored(grouped, "analysis")
    all_rows = 2 ** len(by) - 1
    by_hours = all_rows - 1
    whole_numbers = [
        "total_incidents", "active_incidents", "resolved_incidents", "high_impact_incidents", "_resolved",
        "sla_breached", "within_sla", "total_users",
    ]
    reals = ["avg_resolution_hours", "fastest_resolution_hours", "longest_resolution_hours", "avg_users"]
    # A plain aggregate has a row even where there is nothing to group.
    overall = grouped.filter(F.col("_set") == all_rows).agg(
        *[F.coalesce(F.max(name), F.lit(0).cast("bigint")).alias(name) for name in whole_numbers],
        *[F.max(name).alias(name) for name in reals],
    )
    total = overall.select("total_incidents").scalar()

    whole = F.lit(None).cast("bigint")
    real = F.lit(None).cast("double")
    counted = [
        F.struct(F.lit(name).alias("metric"), F.col(name).alias("n"), real.alias("value"))
        for name in (
            "total_incidents",
            "active_incidents",
            "resolved_incidents",
            "high_impact_incidents",
            "sla_breached",
            "within_sla",
            "total_users",
        )
    ]
    rate = F.when(F.col("_resolved") > 0, percent(F.col("sla_breached"), F.col("_resolved")))
    measured = [
        F.struct(F.lit(name).alias("metric"), whole.alias("n"), value.alias("value"))
        for name, value in (
            ("sla_breach_rate", rate),
            *((name, F.col(name)) for name in reals),
        )
    ]
    scalars = overall.select(F.inline(F.array(*counted, *measured)))
    hour_counts = grouped.filter(F.col("_set") == by_hours).withColumnRenamed("total_incidents", "_n")
    median = median_of_counts(hour_counts, [], "value").agg(F.max("value").alias("value")).select(
        F.lit("median_resolution_hours").alias("metric"), whole.alias("n"), "value"
    )
    scalars = scalars.unionByName(median).select(
        "metric", F.lit(None).cast("string").alias("key"), "n", "value"
    )

    # The set number has a one bit for each column that is not grouped by.
    metric = F.lit(None).cast("string")
    key = F.lit(None).cast("string")
    limit = F.lit(None).cast("int")
    for position, (name, label, k) in enumerate(shown):
        mine = F.col("_set") == all_rows - 2 ** (len(by) - 1 - position)
        metric = F.when(mine, F.lit(label)).otherwise(metric)
        key = F.when(mine, F.col(name)).otherwise(key)
        limit = F.when(mine, F.lit(k)).otherwise(limit)
    values = grouped.filter(F.col("_set") < by_hours).select(
        metric.alias("metric"), key.alias("key"), F.col("total_incidents").alias("n"), limit.alias("_k")
    ).filter(F.col("key").isNotNull())
    shares = values.filter(F.col("_k").isNull()).select(
        "metric", "key", "n", percent(F.col("n"), total).alias("value")
    )
    k = max((k for _, _, k in shown if k), default=0)
    rank = F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("n"), "key"))
    tops = (
        values.filter(F.col("_k").isNotNull())
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= k)
        .filter(F.col("_rank") <= F.col("_k"))
        .select("metric", "key", "n", percent(F.col("n"), total).alias("value"))
    )
    return scalars.unionByName(shares).unionByName(tops)
