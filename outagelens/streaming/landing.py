"""Enrichment, redaction and row-wise analysis of exports as they land.

Every step works on one row, so the batch functions apply to a stream unchanged and no
state or watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.enrich import enrich_incidents
from ..operators.rca import analysis_as_landed
from ..operators.redact import redact_live_export
from ..sources.schemas import envelope


def landed_incidents(spark: SparkSession, path: str, record: StructType) -> DataFrame:
    """Stream of the records of landed responses; an unreadable page stops it, as none may be lost."""
    landed = spark.readStream.schema(envelope(record)).json(path, mode="FAILFAST")
    return landed.select(F.inline("result"))


def write_redacted(rows: DataFrame, path: str, checkpoint: str, salt: str) -> StreamingQuery:
    """Process all files that are there, append the redacted rows, and stop."""
    prepared = redact_live_export(enrich_incidents(rows), salt)
    return (
        prepared.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_analysis(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Analyse all incidents that have landed, and stop; results lie in ``batch=<id>`` folders.

    A batch that is tried again, after a failure between its results and the commit, has the
    same id and the same rows, and replaces its folder: nothing is there twice.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        analysis_as_landed(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        rows.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
