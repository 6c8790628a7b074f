"""Derived incident columns on hand-written rows."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outagelens.functions import incident, text, times
from outagelens.operators import enrich


def test_active_states(values):
    got = values(incident.is_active("s"), "s string", ["New", "In Progress", "Awaiting User Info", "Resolved", "new", None])
    assert got == [True, True, True, False, False, False]


def test_high_impact(values):
    got = values(incident.is_high_impact("p"), "p string", ["1 - Critical", "2 - High", "3 - Moderate", "12 - Higher", None])
    assert got == [True, True, False, True, False]


def test_category_first_rule_wins(values):
    rows = ["WiFi down", "remote wireless", "VPN printer", "Print server", "slow SERVER", "dns broken",
            "Name resolution", "switch", "", None, "Access Point off"]
    expected = ["WiFi/Wireless", "WiFi/Wireless", "VPN/Remote Access", "Network Printing", "Server/Performance",
                "DNS/Resolution", "DNS/Resolution", "Other Network", "Other Network", "Other Network", "WiFi/Wireless"]
    assert values(incident.pattern_category("d"), "d string", rows) == expected


def test_sla_limits_are_exclusive(values):
    rows = [(None, True), (-1.0, True), (24.0, True), (24.001, True), (72.0, False), (72.001, False), (30.0, False)]
    got = values(incident.sla_breach("h", "hi"), "h double, hi boolean", rows)
    assert got == [False, False, False, True, False, True, False]


def test_user_estimate_is_in_band_and_repeatable(values):
    kinds = ["DNS Server", "Access Point", "Office WiFi", "Network Printer", "Switch", None]
    bands = [(50, 200), (20, 100), (20, 100), (5, 30), (1, 50), (1, 50)]
    rows = [(f"INC{n}", kind) for kind in kinds for n in range(40)]
    column = incident.user_impact_estimate("n", "k")
    got = values(column, "n string, k string", rows)
    assert got == values(column, "n string, k string", rows)
    for position, (low, high) in enumerate(bands):
        part = got[position * 40 : position * 40 + 40]
        assert all(low <= v < high for v in part)
        assert len(set(part)) > 5


def test_iso_week(values):
    days = ["2024-12-30", "2025-01-01", "2021-01-03", "2025-07-16"]
    column = times.iso_week(times.to_timestamp("d"))
    assert values(column, "d string", days) == [1, 1, 53, 29]


def test_timestamps(values):
    rows = ["", None, "junk", "2025-07-15 09:30:00", "2025-01-15T10:00:00Z"]
    got = values(times.to_timestamp("t"), "t string", rows)
    assert got == [None, None, None, datetime(2025, 7, 15, 9, 30), datetime(2025, 1, 15, 10)]


def test_hours(values):
    rows = [("2025-01-15 10:00:00", "2025-01-15 14:30:00"), ("2025-01-15 10:00:00", "2025-01-15 09:00:00"),
            ("2025-01-15 10:00:00", None)]
    column = times.hours_between(times.to_timestamp("a"), times.to_timestamp("b"))
    assert values(column, "a string, b string", rows) == [4.5, -1.0, None]


def test_one_decimal_known_values(values):
    rows = [4.25, 0.35, 1.15, 4.75, 0.0, -0.02, -4.25, 99.95, 123456.05, None]
    expected = [None if v is None else f"{v:.1f}" for v in rows]
    assert values(times.one_decimal("h"), "h double", rows) == expected


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**7, 10**9), min_size=300, max_size=300))
def test_one_decimal_matches_python(values, seconds):
    ties = [180 * (2 * k + 1) for k in range(0, 400)]
    hours = [s / 3600 for s in ties + seconds]
    assert values(times.one_decimal("h"), "h double", hours) == [f"{h:.1f}" for h in hours]


def test_display_value(values):
    rows = ['{"display_value":"Net"}', "Net", '{"link":"x"}', "{odd", "", None]
    assert values(text.display_value("r", "Unknown"), "r string", rows) == ["Net", "Net", "Unknown", "{odd", "", "Unknown"]
    shown = text.display_value("r", "N/A", empty="N/A")
    assert values(shown, "r string", rows) == ["Net", "Net", "N/A", "{odd", "N/A", "N/A"]


def test_first_text(values):
    rows = [("", "b"), ("a", "b"), (None, "b"), ("", None)]
    assert values(text.first_text("a", "b"), "a string, b string", rows) == ["b", "a", "b", None]


def test_safe_int(values):
    assert values(text.safe_int("a"), "a string", ["3", "", None, "3.0", "x", " 4 "]) == [3, 0, 0, 0, 0, 4]


def test_location_and_score(values):
    parts = incident.location_parts("l")
    got = values(F.concat_ws("|", parts["site_code"], parts["city"], parts["country"], parts["building"]), "l string",
                 ["00123 - London - UK / Office A", "Site"])
    assert got == ["00123|London|UK|Office A", "Site|||"]
    assert values(incident.priority_score("p"), "p string", ["1 - Critical", "5 - Planning", "High", None]) == [10, 2, None, None]


def test_enrichment_handles_all_three_exports(spark):
    standard = spark.createDataFrame(
        [("INC1", "VPN down", "2 - High", "Resolved", "2025-07-15 09:00:00", "2025-07-16 10:00:00", "DNS Server")],
        "number string, short_description string, priority string, incident_state string, opened string, resolved string, ci_type string",
    )
    live = standard.withColumnsRenamed({"opened": "opened_at", "resolved": "u_resolved", "ci_type": "u_ci_type"})
    api = standard.withColumnsRenamed({"opened": "opened_at", "resolved": "resolved_at", "incident_state": "state"})
    for export in (standard, live, api):
        row = enrich.enrich_incidents(export).first()
        assert (row.isActive, row.isHighImpact, row.patternCategory) == (False, True, "VPN/Remote Access")
        assert (row.resolutionTimeHrs, row.slaBreach, row.week) == (25.0, True, 29)


def test_enrichment_without_optional_columns(spark):
    row = enrich.enrich_incidents(spark.createDataFrame([("INC1", "New")], "number string, state string")).first()
    assert (row.isActive, row.isHighImpact, row.patternCategory) == (True, False, "Other Network")
    assert (row.resolutionTimeHrs, row.slaBreach, row.week) == (None, False, None)


def test_rename_keeps_taken_names(spark):
    df = spark.createDataFrame([("a", "b")], "state string, incident_state string")
    assert enrich.rename_standard(df).columns == ["state", "incident_state"]


def test_fill_defaults(spark):
    df = spark.createDataFrame([("x", 7)], "number string, reassignment_count int")
    assert enrich.fill_defaults(df).first().asDict() == {
        "number": "x", "reassignment_count": 7, "ci_type": "Unknown", "assigned_to": "Unassigned"
    }


def test_enrichment_without_number(spark):
    rows = enrich.enrich_incidents(spark.createDataFrame([("a", "New"), ("b", "New")], "id_hash string, state string"))
    assert all(1 <= r.userImpactEstimate < 50 for r in rows.collect())
