"""The batch run: enrich, redact, analyse, and write every result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import enrich, profile, redact
from ..sources import files
from ..sources.scratch import job_scratch


@dataclass(frozen=True)
class BatchPaths:
    """Where the results of a run are written."""

    processed: str
    redacted: str
    analysis: str
    metrics: str
    redaction_check: str

    @classmethod
    def under(cls, folder: str) -> BatchPaths:
        return cls(
            *(f"{folder}/{name}" for name in ("processed", "redacted", "analysis", "metrics", "redaction_check"))
        )


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    paths: BatchPaths,
    salt: str,
    apply_redaction: bool = True,
    as_csv: bool = False,
    stop_on_findings: bool = False,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Run all steps and return the written tables.

    The check of the redaction is written too; with ``stop_on_findings`` the run ends with an
    error if it finds personal data left, before anything else is made of the tables.

    The enriched table is written once and read back for the steps after it: they scan
    only the columns they need, and a lost executor costs no recomputation of the input.
    Metrics and the check are counted while the tables are written, so neither reads a table
    again. With a ``run_id`` a run that is tried again replaces its row of the metrics.
    """
    run = profile.ObservedRun(spark)
    enriched = enrich.enrich_incidents(enrich.fill_defaults(enrich.rename_standard(run.raw(raw))))
    run.processed(enriched).write.mode("overwrite").parquet(paths.processed)
    processed = spark.read.parquet(paths.processed)

    if apply_redaction:
        seen = redact.ObservedRedaction(spark)
        masked = redact.redact_live_export(seen.original(processed), salt)
        seen.redacted(masked).write.mode("overwrite").parquet(paths.redacted)
        check = seen.check()
        files.sink_json(check, paths.redaction_check)
        found = spark.read.schema(check.schema).json(paths.redaction_check)
        if stop_on_findings and not found.first()["redaction_successful"]:
            raise ValueError(f"personal data is left in {paths.redacted}")
    with job_scratch(spark, "batch"):
        files.sink_json(profile.analyze_incidents(processed), paths.analysis)
    files.sink_metrics(run.metrics(), paths.metrics, run_id)
    if as_csv:
        files.sink_csv(processed, paths.processed + "_csv")

    results = {"processed": processed, "analysis": spark.read.json(paths.analysis)}
    if apply_redaction:
        redacted = spark.read.parquet(paths.redacted)
        results["redacted"] = redacted
        results["redaction_check"] = found
        if as_csv:
            files.sink_csv(redacted, paths.redacted + "_csv")
    return results
