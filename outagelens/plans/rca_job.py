"""The root-cause run over all incidents."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators import filters, rca, reports
from ..operators.bundle import RELATED
from ..operators.layout import incident_layout
from ..sources import files
from ..sources.scratch import job_scratch


def run_rca(
    spark: SparkSession,
    incidents: DataFrame,
    journal: DataFrame,
    problems: DataFrame,
    changes: DataFrame,
    folder: str,
    formats: Sequence[str] = ("markdown",),
    wanted: str | Sequence[str] | DataFrame | None = None,
    as_of: datetime | None = None,
    landed_events: DataFrame | None = None,
) -> DataFrame:
    """Analyse all incidents, or the wanted ones, and write the reports.

    ``landed_events`` (sys_id, timestamp, event_type) tell when work began; without them
    there is no time to detection. A later run into the same folder replaces its results.

    For wanted incidents the tables are first cut down to them, their children and their
    journal entries. The analysis is written once and read back for every format, the journal's
    digest likewise, and text reports are made of the Markdown ones if these are written first. If
    both Markdown (or text) and JSON are asked for, events and related records are stored by incident
    first, so that each is shuffled once; Markdown alone moves less, as it takes only first events.
    """
    pool, entries = incidents, journal
    if wanted is not None:
        chosen = filters.lookup_incident(incidents, wanted)
        ids = chosen.select("sys_id")
        children = incidents.join(ids.withColumnRenamed("sys_id", "parent"), "parent", "left_semi")
        others = children.join(chosen.select("number"), "number", "left_anti")
        pool = chosen.unionByName(others)
        entries = journal.join(ids.withColumnRenamed("sys_id", "element_id"), "element_id", "left_semi")
    path = f"{folder}/analysis"
    with job_scratch(spark, "rca"):
        digest = rca.stored_digest(entries)
        analysis = rca.rca_analysis(pool, entries, problems, landed_events, digest=digest)
        if wanted is not None:
            analysis = filters.lookup_incident(analysis, wanted)
        analysis.write.mode("overwrite").parquet(path)
        analysis = spark.read.parquet(path)
        markdown, tables = None, (pool, entries, problems, changes)
        several = "json" in map(str.lower, formats) and len(set(map(str.lower, formats))) > 1
        laid = incident_layout(*tables, analysis, ("timeline", *RELATED)) if several else nullcontext()
        with laid as layout:
            for format in formats:
                options = {"analysis": analysis, "as_of": as_of, "digest": digest, "layout": layout}
                if format.lower() == "text":
                    options["markdown"] = markdown
                rows = reports.generate_report(format, *tables, **options)
                if wanted is not None:
                    rows = filters.lookup_incident(rows, wanted)
                files.sink_reports(rows, f"{folder}/reports", format)
                if format.lower() == "markdown":
                    markdown = files.scan_reports(spark, f"{folder}/reports", format)
    return analysis
