"""Reading and writing incident tables as files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .schemas import envelope

# Writer and reader use the same quoting, so quotes, commas and line breaks in texts
# survive. An empty text is read as NULL, like a missing one.
CSV_OPTIONS = {"header": True, "escape": '"'}


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    limit: int | None = None,
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """CSV with a header line; ``limit`` keeps the first rows only, as a sample.

    Large files are split at line ends. Exports whose texts hold line breaks need
    ``multi_line=True``, and then one task reads a whole file. A row that does not fit the
    header fails the read; with ``mode="PERMISSIVE"`` it is read as far as it goes.
    """
    options = {**CSV_OPTIONS, "multiLine": multi_line, "enforceSchema": False, "mode": mode}
    rows = spark.read.schema(schema).options(**options).csv(path)
    return rows if limit is None else rows.limit(limit)


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet table, as its files are split (``spark.sql.files.maxPartitionBytes``)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_stage(
    spark: SparkSession, path: str, schema: StructType, limit: int | None = None, multi_line: bool = False
) -> DataFrame:
    """One stage of the pipeline, or an empty table with its schema if the path is missing."""
    try:
        return scan_csv(spark, path, schema, limit, multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_json_envelope(
    spark: SparkSession, path: str, record: StructType, multi_line: bool = False
) -> DataFrame:
    """Records of landed responses, one per line, or one per file with ``multi_line``.

    A reference field may be an object or a text. A page that can't be read, such as one cut
    off or one spread over lines without ``multi_line``, fails the read: its records would
    be missing without a trace. `unreadable_pages` counts such pages.
    """
    landed = spark.read.schema(envelope(record)).json(path, multiLine=multi_line, mode="FAILFAST")
    return landed.select(F.inline("result"))


def unreadable_pages(spark: SparkSession, path: str, record: StructType, multi_line: bool = False) -> DataFrame:
    """file, pages: how many pages of each file are no readable response; no row if all are."""
    schema = StructType([*envelope(record).fields, StructField("_page", StringType())])
    options = {"multiLine": multi_line, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_page"}
    landed = spark.read.schema(schema).options(**options).json(path)
    bad = landed.withColumn("file", F.input_file_name()).filter(F.col("_page").isNotNull() | F.col("result").isNull())
    return bad.groupBy("file").agg(F.count("*").alias("pages"))


def sink_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def sink_json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def sink_metrics(metrics: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add the metrics row of one run.

    With a ``run_id`` the row has a folder of its own, so that a run that is tried again
    replaces its row; without one every call appends.
    """
    if run_id is None:
        metrics.write.mode("append").options(header=True).csv(path)
        return
    named = metrics.withColumn("run_id", F.lit(run_id))
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").options(header=True).csv(path)


# File name endings by report format.
EXTENSIONS = {"json": ".json", "markdown": ".md", "text": ".txt"}


def sink_reports(reports: DataFrame, path: str, format: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """Reports as rows of number, part, file name and text, one folder per format.

    Most of a report's text stands in many reports, so the files are compressed; Spark's readers
    see no difference. A later run replaces the reports of its format and leaves the others. Further parts of
    a report have their number in the file name.
    """
    part = F.when(F.col("part") > 0, F.concat(F.lit("-"), F.col("part").cast("string"))).otherwise("")
    named = reports.withColumns(
        {
            "file_name": F.concat("number", part, F.lit(EXTENSIONS[format.lower()])),
            "format": F.lit(format.lower()),
        }
    )
    writer = named.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("format").json(path, compression=compression)


def scan_reports(spark: SparkSession, path: str, format: str) -> DataFrame:
    """Reports of one format as they were written: number, part, report."""
    schema = "number string, part long, report string"
    return spark.read.schema(schema).json(f"{path}/format={format.lower()}")
