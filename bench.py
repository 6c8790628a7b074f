"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query is planned and run
to a sink that discards its rows, once to warm up and then ``BENCH_RUNS`` times; the best
run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.catalog import QUERIES  # noqa: E402
from outagelens.session import local_session  # noqa: E402

HEADLINES = (
    "category_profile",
    "enrich_incidents",
    "redact_text",
    "validate_redaction",
    "redact_frame",
    "analyze_incidents",
    "timeline_top20",
    "related_top5",
    "root_cause",
    "rca_analysis",
    "report_markdown",
)


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), memory="12g")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    best = {}
    for name in HEADLINES:
        seconds(spark, sf_dir, name)
        best[name] = round(min(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
    total = round(sum(best.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": best, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
