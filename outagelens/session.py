"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .sources.scratch import SETTING, local_folder

# Naive timestamps are compared as they are written, so the zone is fixed. Adaptive
# execution joins small sides by broadcast after measuring them and splits skewed
# join partitions. Rows that stand in order of a group's key, as after a sort-merge join,
# are gathered in one pass instead of being hashed, sorted and gathered twice. What a query
# shuffled goes when it ends, not when the driver happens to collect its garbage.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that already exists."""
    for name, value in REQUIRED.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("outagelens")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", memory)
        .config(SETTING, local_folder())
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
