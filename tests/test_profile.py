"""Counts, rates and the exact median."""

import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outagelens.operators import profile, stages
from outagelens.operators.quantile import exact_median

SCHEMA = (
    "number string, isActive boolean, isHighImpact boolean, slaBreach boolean, patternCategory string, "
    "priority string, assignment_group string, location string, resolutionTimeHrs double, "
    "userImpactEstimate int, week int"
)


@pytest.fixture
def enriched(spark):
    rows = [
        ("I1", True, True, False, "A", "1", "g1", "x", None, 10, 2),
        ("I2", False, False, True, "A", "2", "g1", None, 80.0, 20, 1),
        ("I3", False, False, False, "B", None, "g2", "y", 1.5, 30, 1),
        ("I4", False, True, False, "B", "2", None, "y", 3.0, 40, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_counts(enriched):
    assert profile.total_incidents(enriched).first()[0] == 4
    assert tuple(profile.active_resolved_counts(enriched).first()) == (1, 3)
    assert profile.high_impact_count(enriched).first()[0] == 2
    assert tuple(profile.user_impact_totals(enriched).first()) == (100, 25.0)


def test_distribution_drops_missing_but_counts_them_in_the_total(enriched):
    got = {r.priority: (r.n, r.pct) for r in profile.distribution(enriched, "priority").collect()}
    assert got == {"1": (1, 25.0), "2": (2, 50.0)}


def test_top_values_break_ties_by_name(enriched):
    assert [r.priority for r in profile.top_values(enriched, "priority", 1).collect()] == ["2"]
    assert [r.location for r in profile.top_values(enriched, "location", 5).collect()] == ["y", "x"]


def test_rates_and_hours(enriched):
    row = profile.sla_breach_rate(enriched).first()
    assert (row.resolved, row.breached, row.within_sla) == (3, 1, 2)
    assert row.sla_breach_rate == pytest.approx(100 / 3)
    row = profile.resolution_stats(enriched).first()
    assert (row.median_hours, row.fastest_hours, row.longest_hours) == (3.0, 1.5, 80.0)


def test_no_resolved_rows(enriched):
    none = enriched.filter("resolutionTimeHrs is null")
    assert profile.sla_breach_rate(none).first().sla_breach_rate is None
    row = profile.resolution_stats(none).first()
    assert (row.avg_hours, row.median_hours) == (None, None)


def test_weekly_trend(enriched):
    assert [tuple(r) for r in profile.weekly_trend(enriched).collect()] == [(1, 2), (2, 1)]


def test_run_metrics(enriched):
    row = profile.run_metrics(enriched.select("number"), enriched).first()
    assert (row.raw_record_count, row.processed_record_count, row.columns_added) == (4, 4, 10)
    assert (row.active_incidents, row.high_impact_incidents, row.sla_breaches) == (1, 2, 1)
    row = profile.run_metrics(enriched, enriched.select("number")).first()
    assert (row.columns_added, row.active_incidents) == (-10, 0)


def test_analysis_equals_its_parts(enriched):
    rows = profile.analyze_incidents(enriched).collect()
    got = {(r.metric, r.key): (r.n, r.value) for r in rows}
    assert len(got) == len(rows)
    assert got[("total_incidents", None)] == (4, None)
    assert got[("median_resolution_hours", None)] == (None, 3.0)
    assert got[("pattern_distribution", "A")] == (2, 50.0)
    assert got[("priority_distribution", "2")] == (2, 50.0)
    assert got[("assignment_groups", "g1")] == (2, 50.0)
    assert got[("top_locations", "y")] == (2, 50.0)
    assert ("top_locations", None) not in got


def test_analysis_shows_five_groups(spark, enriched):
    many = enriched.crossJoin(spark.range(9).withColumnRenamed("id", "k")).withColumn(
        "assignment_group", F.concat(F.lit("g"), "k")
    )
    rows = profile.analyze_incidents(many.drop("k")).filter("metric = 'assignment_groups'").collect()
    assert sorted(r.key for r in rows) == ["g0", "g1", "g2", "g3", "g4"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-(10**8), 10**9)), min_size=1, max_size=60))
def test_median_matches_statistics(spark, rows):
    hours = [(k, s / 3600) for k, s in rows]
    df = spark.createDataFrame(hours, "k string, h double")
    got = {r.k: r.median for r in exact_median(df, F.col("h"), ["k"]).collect()}
    assert got.keys() == {k for k, _ in hours}
    for key, median in got.items():
        assert median == pytest.approx(statistics.median(h for k, h in hours if k == key), rel=1e-12, abs=1e-12)


def test_median_of_equal_and_extreme_values(spark):
    df = spark.createDataFrame([(5.0,)] * 4 + [(-8e7,), (8e7,)], "h double")
    assert exact_median(df, F.col("h"), []).first()[0] == 5.0
    assert exact_median(df.filter("h <> 5"), F.col("h"), []).first()[0] == 0.0


def test_stage_profile(spark):
    first = spark.createDataFrame([("a", None), ("b", "x")], "number string, caller_id string")
    second = first.select("number", F.lit("h").alias("number_hash"))
    third = second.withColumn("isActive", F.lit(True))
    rows = {r.column_name: r for r in stages.stage_profile({"original": first, "redacted": second, "processed": third}).collect()}
    assert (rows["caller_id"].original_rows, rows["caller_id"].original_non_null) == (2, 1)
    assert rows["caller_id"].change == "removed in redacted" and rows["caller_id"].redacted_rows is None
    assert rows["number_hash"].change == "added in redacted"
    assert rows["isActive"].change == "added in processed" and rows["isActive"].derived
    assert rows["number"].change == "" and not rows["number"].derived
