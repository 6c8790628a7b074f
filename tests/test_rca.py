"""Timeline, bundle, root cause and reports on hand-written incidents."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from outagelens.functions import cause
from outagelens.operators import bundle, filters, rca, related, reports, timeline
from outagelens.operators.skew import ordered_pieces, split_hot

INCIDENT_SCHEMA = (
    "sys_id string, number string, short_description string, description string, priority string, impact string, "
    "urgency string, state string, category string, assignment_group string, assigned_to string, caller_id string, "
    "cmdb_ci string, opened_at string, resolved_at string, closed_at string, resolution_notes string, "
    "close_notes string, reassignment_count string, parent string"
)
JOURNAL_SCHEMA = (
    "entry_id string, element_id string, name string, element string, sys_created_on string, author string, value string"
)
RECORD_SCHEMA = "number string, short_description string, priority string, state string, opened_at string, {} string, incidents string"

DEFAULTS = {
    "sys_id": "s1", "number": "INC1", "short_description": "Scanners offline", "description": "Scanners in the hall stay offline",
    "priority": "2 - High", "impact": "2 - High", "urgency": "1 - Critical", "state": "6 - Resolved",
    "category": "Network", "assignment_group": '{"display_value":"Hall Support"}', "assigned_to": "Ola",
    "caller_id": "Kim", "cmdb_ci": '{"display_value":"Scanner Hub"}', "opened_at": "2025-01-15 10:00:00",
    "resolved_at": "2025-01-15 14:30:00", "closed_at": None, "resolution_notes": None, "close_notes": None,
    "reassignment_count": "1", "parent": None,
}


@pytest.fixture
def make(spark):
    class Make:
        def incidents(self, *changes):
            names = [part.split()[0] for part in INCIDENT_SCHEMA.split(", ")]
            rows = [tuple({**DEFAULTS, **change}[name] for name in names) for change in changes]
            return spark.createDataFrame(rows, INCIDENT_SCHEMA)

        def journal(self, *entries):
            """Entries of (sys_id, element, minute, text)."""
            start = datetime(2025, 1, 15, 10)
            rows = [
                (f"e{i:06d}", sys_id, "incident", element, str(start + timedelta(minutes=minute)), "Someone", text)
                for i, (sys_id, element, minute, text) in enumerate(entries)
            ]
            return spark.createDataFrame(rows, JOURNAL_SCHEMA)

        def records(self, *rows, ended="resolved_at"):
            full = [(number, text, "3", "Open", "2025-01-01 00:00:00", None, ids) for number, text, ids in rows]
            return spark.createDataFrame(full, RECORD_SCHEMA.format(ended))

    return Make()


def sentence_of(notes, comments):
    """The rule, plainly: join, lower, first closed sentence with the phrase."""
    text = (" ".join(notes) + " " + " ".join(comments)).lower()
    for sentence in text.split(".")[:-1]:
        if "root cause" in sentence:
            return sentence.lstrip() + "."
    return None


NOTE_SETS = [
    ["Found it. The root cause was DNS. Fixed."],
    ["still looking", "the root", "cause is known", "to all. done"],
    ["The root cause", "is unknown"],
    ["the root", "Root cause: x"],
    ["A.", "b root", "", "cause.", "c. ROOT CAUSE here. d"],
    ["no hint."] * 30 + ["now the root cause shows."],
    ["root cause", ". later root cause."],
    [".", "root", "cause", "."],
    ["nothing"],
    ["\tRoot cause.\n"],
]


@pytest.mark.parametrize("piece_rows", [10_000, 3, 1])
def test_cause_sentences_whatever_the_piece_size(make, piece_rows):
    entries = []
    for i, notes in enumerate(NOTE_SETS):
        half = len(notes) // 2
        for position, text in enumerate(notes):
            entries.append((f"s{i}", "work_notes" if position < half else "comments", position, text))
        entries.append((f"s{i}", "assignment_group", 0, "root cause of another kind."))
    got = {r.sys_id: r.sentence for r in rca.cause_sentences(make.journal(*entries), piece_rows).collect()}
    expected = {}
    for i, notes in enumerate(NOTE_SETS):
        half = len(notes) // 2
        sentence = sentence_of(notes[:half], notes[half:])
        if sentence:
            expected[f"s{i}"] = sentence
    assert got == expected


def test_cause_by_notes(values):
    rows = ["The root cause was a misconfigured firewall rule", "User error.", "Mistake by out of memory", "fine", "", None]
    got = values(cause.cause_from_notes("n"), "n string", rows)
    assert got[0] == "Configuration: The root cause was a misconfigured firewall rule"
    assert got[1:] == ["Human Error: User error.", "Human Error: Mistake by out of memory", None, None, None]
    assert values(cause.cause_from_notes("n"), "n string", ["attack" + "x" * 300]) == ["Security: attack" + "x" * 194]


def test_root_cause_order(make):
    incidents = make.incidents(
        {"number": "N", "sys_id": "n", "resolution_notes": "", "close_notes": "Software bug"},
        {"number": "S", "sys_id": "s"},
        {"number": "P", "sys_id": "p"},
        {"number": "E", "sys_id": "e"},
        {"number": "D", "sys_id": "d", "description": "Cooling fan rattles at night"},
        {"number": "X", "sys_id": "x", "description": "", "short_description": None},
    )
    journal = make.journal(("n", "work_notes", 1, "Root cause one."), ("s", "comments", 1, "The root cause. Else."))
    problems = make.records(("P2", "later", "p,s"), ("P1", "first", " p "), ("P0", "", "e"), ("P3", "named", "e"))
    got = {r.number: r.root_cause for r in rca.root_causes(incidents, journal, problems).collect()}
    assert got == {
        "N": "Software: Software bug",
        "S": "the root cause.",
        "P": "Related Problem: first",
        "E": "Based on incident description: Scanners in the hall stay offline",
        "D": "Based on incident description: Cooling fan rattles at night",
        "X": "Root cause not clearly identified from available data. Manual review recommended.",
    }


def test_impact(values):
    rows = [("1 - Critical", None), ("5", "CRITICAL"), ("2", ""), ("x", "high"), ("3", None), (None, "Medium"), (None, None)]
    got = values(cause.default_users("p", "i"), "p string, i string", rows)
    assert got == [500, 500, 200, 200, 50, 50, 10]
    assert values(cause.business_impact("p", "i"), "p string, i string", rows)[0].startswith("Critical business impact")


def test_affected_users(values):
    rows = ["Mail is slow for 500 users", "700 people but no one else", "users: 30 people", "a user", None]
    got = values(cause.affected_users("d", F.lit(None), F.lit(7)), "d string", rows)
    assert got == [500, 7, 30, 7, 7]


def test_technical_impact(values):
    rows = [('{"display_value":"R1"}', "Net"), ("R2", None), (None, "Net"), ('{"link":"x"}', "")]
    got = values(cause.technical_impact("c", "k"), "c string, k string", rows)
    assert got == ["Affected CI: R1. Category: Net", "Affected CI: R2. Category: ",
                   "Affected CI: Unknown. Category: Net", "Affected CI: . Category: "]


def test_efficiency_and_justification(values):
    got = values(cause.resolution_efficiency("h"), "h double", [None, 3.99, 4.0, 24.0, 72.0, -1.0])
    assert [t.split(" -")[0] for t in got] == ["", "Excellent", "Good", "Acceptable", "Needs Improvement", "Excellent"]
    rows = [("1 - Critical", "1 - Critical", "1 - Critical"), ("2", "", None), ("3", "low", "")]
    got = values(cause.priority_justification("p", "i", "u"), "p string, i string, u string", rows)
    assert got == [
        "Priority: 1 - Critical, Impact: 1 - Critical, Urgency: 1 - Critical - Critical priority justified by high business impact and urgency",
        "Priority: 2 - High priority due to significant service impact",
        "Priority: 3, Impact: low - Standard priority classification",
    ]


def test_factors(make):
    incidents = make.incidents(
        {"number": "A", "sys_id": "a", "reassignment_count": "3", "resolved_at": "2025-01-16 10:15:00"},
        {"number": "B", "sys_id": "b", "reassignment_count": "x", "resolved_at": None},
        {"number": "C", "sys_id": "c", "reassignment_count": None},
    )
    journal = make.journal(*[("c", "work_notes", m, "n") for m in range(6)], ("b", "comments", 60 * 24, "n"))
    got = {r.number: r.contributing_factors for r in rca.contributing_factors(incidents, journal).collect()}
    assert got == {
        "A": ["Incident was reassigned 3 times, indicating initial misrouting or complexity",
              "Extended resolution time (24.2 hours) suggests complexity or resource constraints"],
        "B": [],
        "C": ["Multiple investigation notes indicate complex troubleshooting process"],
    }


def test_detection(make, spark):
    incidents = make.incidents({"sys_id": "a", "number": "A"}, {"sys_id": "b", "number": "B", "resolved_at": None},
                               {"sys_id": "c", "number": "C", "resolved_at": "", "closed_at": "2025-01-15 12:00:00"})
    events = spark.createDataFrame(
        [(k, datetime(2025, 1, 15, 10, m), t) for k in "abc" for m, t in ((0, "Incident Created"), (15, "Assignment"), (30, "Work"))],
        "sys_id string, timestamp timestamp_ntz, event_type string",
    )
    got = {r.number: r.detection_hours for r in rca.time_to_detection(incidents, events).collect()}
    assert got == {"A": 0.25, "B": None, "C": 0.25}


def test_timeline_order_and_actors(make):
    incidents = make.incidents({"assigned_to": '{"display_value":"Ann"}', "close_notes": "closed", "caller_id": None})
    journal = make.journal(("s1", "work_notes", 270, "x" * 300), ("s1", "comments", 0, None), ("zz", "comments", 0, "orphan"))
    rows = timeline.timeline(incidents, journal).orderBy(*timeline.EVENT_ORDER).collect()
    assert [(r.event_type, r.actor) for r in rows] == [
        ("Incident Created", "Unknown"), ("Journal Entry", "comments"), ("Journal Entry", "work_notes"), ("Incident Resolved", "Ann")]
    assert len(rows[2].description) == 200 and rows[1].description == "" and rows[3].details == "closed"


@pytest.mark.parametrize("count", [0, 1, 20, 21])
def test_first_twenty_events(make, count):
    incidents = make.incidents({"opened_at": None, "resolved_at": None})
    journal = make.journal(*[("s1", "comments", m, f"note {m}") for m in range(count)], ("zz", "comments", 0, "orphan"))
    rows = timeline.timeline_top(incidents, journal).orderBy("position").collect()
    assert len(rows) == min(count, 21)
    if count == 21:
        assert rows[-1].description == "*(1 more events)*" and rows[19].description == "note 19"


def test_join_journal_keeps_silent_incidents(make):
    incidents = make.incidents({}, {"sys_id": "s2", "number": "INC2"})
    got = timeline.join_journal(incidents, make.journal(("s1", "comments", 0, "a"), ("s1", "comments", 1, "b"))).collect()
    assert sorted((r.number, r.value) for r in got if r.value) == [("INC1", "a"), ("INC1", "b")]
    assert [r.entry_id for r in got if r.number == "INC2"] == [None]


def test_related(make, spark):
    incidents = make.incidents({}, *[{"sys_id": f"c{i}", "number": f"INC2{i}", "parent": "s1"} for i in range(7)])
    problems = make.records(("P1", "p", "s1, c1,s1"))
    changes = spark.createDataFrame(
        [("C1", None, "3", "Open", None, None, ["s1"])],
        "number string, short_description string, priority string, state string, opened_at string, closed_at string, incidents array<string>",
    )
    assert related.related_incidents(incidents).count() == 7
    assert sorted(r.number for r in related.related_problems(incidents, problems).collect()) == ["INC1", "INC21"]
    top = related.related_top(incidents, problems, changes).filter("number = 'INC1'").collect()
    assert sorted((r.kind, r.related_number) for r in top) == [
        ("change", "C1"), *[("incident", f"INC2{i}") for i in range(5)], ("problem", "P1")]


def test_bundle_in_pieces_holds_the_same_lists(make):
    incidents = make.incidents({}, {"sys_id": "s2", "number": "INC2", "resolved_at": None}, {"sys_id": "s3", "number": "INC3", "parent": "s1"})
    journal = make.journal(*[("s1", "work_notes" if m % 3 else "comments", m, f"t{m}") for m in range(40)], ("s2", "comments", 5, "x"))
    problems, changes = make.records(("P1", "p", "s1,s2"), ("P2", "q", "s1")), make.records(("C1", "c", "s1"), ended="closed_at")
    names = ["timeline", "work_notes", "comments", "related_incidents", "related_problems", "related_changes"]

    def lists(piece_rows, piece_bytes=1 << 24):
        whole, places = {}, {}
        found = bundle.incident_bundle(incidents, journal, problems, changes, piece_rows, piece_bytes=piece_bytes).collect()
        for row in sorted(found, key=lambda r: r.part):
            places.setdefault(row.number, []).append(row.part)
            assert row.part == 0 or any(row[name] for name in names)
            for name in names:
                assert len(row[name]) <= piece_rows
                whole.setdefault((row.number, name), []).extend(row[name])
        for row in found:
            assert row.parts == len(places[row.number]) and (row.totals is None) == (row.part > 0)
            assert row.part > 0 or all(row.totals[name] == len(whole[row.number, name]) for name in names)
        assert all(parts == list(range(len(parts))) for parts in places.values())
        return whole

    plain = bundle.incident_bundle(incidents, journal, problems, changes).collect()
    assert len(plain) == 3 and all(r.part == 0 and r.incident.number == r.number for r in plain)
    assert lists(10_000) == lists(4) == lists(1) == lists(10_000, 60)
    assert [n.note for n in lists(4)[("INC1", "work_notes")]] == [f"t{m}" for m in range(40) if m % 3]


@pytest.mark.parametrize("broadcast_keys", [100, 1])
def test_split_hot(spark, broadcast_keys):
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [("b", i) for i in range(30)] + [("c", 1)], "k string, v int")
    normal, hot = split_hot(rows, "k", "v", piece_rows=10, broadcast_keys=broadcast_keys, salts=4)
    assert sorted(map(tuple, normal.collect())) == [("c", 1)]
    assert hot.count() == 80 and {r.k for r in hot.collect()} == {"a", "b"}
    assert split_hot(rows, "k", "v", piece_rows=50)[1] is None
    sizes = ordered_pieces(hot, "k", ["v"], 10).groupBy("k", "_range", "_piece").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("k", "_range", "_piece").collect()
    assert max(r.n for r in sizes) <= 10 and sum(r.n for r in sizes) == 80
    for before, after in zip(sizes, sizes[1:]):
        assert before.k != after.k or before.high < after.low


def tables(make):
    incidents = make.incidents(
        {"resolution_notes": "Undid a configuration error of the load scale", "reassignment_count": "4", "resolved_at": "2025-01-19 10:00:00"},
        {"sys_id": "s2", "number": "INC2", "parent": "s1", "resolved_at": None, "close_notes": "all | fine"},
    )
    journal = make.journal(("s1", "work_notes", 60, "Looking | into it"), *[("s2", "comments", m, "c") for m in range(25)])
    return incidents, journal, make.records(("P1", "p", "s1")), make.records(("C1", "x" * 80, "s1"), ended="closed_at")


def test_markdown_report(make):
    incidents, journal, problems, changes = tables(make)
    rows = reports.generate_report("Markdown", incidents, journal, problems, changes, as_of=datetime(2025, 2, 1, 8))
    report = {r.number: r.report for r in rows.collect()}
    first = report["INC1"].split("\n")
    assert first[:8] == ["# Root Cause Analysis Report", "", "**Incident Number:** INC1", "**Report Generated:** 2025-02-01 08:00:00",
                         "", "---", "", "## Executive Summary"]
    titles = [line[3:] for line in first if line.startswith("## ")]
    assert titles == ["Executive Summary", "Incident Details", "Root Cause Analysis", "Impact Assessment", "Duration Analysis",
                      "Priority Classification", "Timeline of Events", "Related Records", "Recommendations"]
    for line in ("- **Assignment Group:** Hall Support", "- **Resolved:** 2025-01-19 10:00:00", "Configuration: Undid a configuration error of the load scale",
                 "- **Time to Resolution:** 96.0 hours", "- INC2: Scanners offline", "- P1: p", "- C1: " + "x" * 60,
                 "| 2025-01-15 11:00:00 | Journal Entry | work_notes | Looking | into it |"):
        assert line in first, line
    assert any(line.startswith("**Change Control:**") for line in first)
    assert any(line.startswith("**Escalation:**") for line in first)
    assert first[-1] == "*Report generated by incident RCA job on 2025-02-01 08:00:00*"
    assert "| ... | ... | ... | *(6 more events)* |" in report["INC2"].split("\n")
    assert "## Related Records" not in report["INC2"] and "## Duration Analysis\n\n\n" in report["INC2"]
    assert "\n\n\n" not in report["INC1"]


def test_text_report(make):
    args = tables(make)
    at = datetime(2025, 2, 1)
    markdown = {r.number: r.report for r in reports.report_markdown(*args, as_of=at).collect()}
    text = {r.number: r.report for r in reports.generate_report("text", *args, as_of=at).collect()}
    assert text == {k: v.replace("**", "").replace("#", "").replace("|", " | ") for k, v in markdown.items()}


@pytest.mark.parametrize("piece_rows", [10_000, 5])
def test_json_report(make, piece_rows):
    rows = reports.generate_report("json", *tables(make), as_of=datetime(2025, 2, 1), piece_rows=piece_rows).collect()
    parts = {}
    for row in sorted(rows, key=lambda r: r.part):
        parts.setdefault(row.number, []).append(json.loads(row.report))
    first = parts["INC1"][0]
    assert first["metadata"] == {"generated_at": "2025-02-01T00:00:00", "incident_number": "INC1"}
    assert first["incident"]["number"] == "INC1" and first["incident"]["closed_at"] is None
    assert first["analysis"]["duration_analysis"]["resolution_efficiency"].startswith("Needs Improvement")
    assert first["related_records"]["incidents"][0]["number"] == "INC2"
    assert (len(parts["INC2"]) == 1) == (piece_rows > 26)
    events = [event for document in parts["INC2"] for event in document["timeline"]]
    assert len(events) == 26 and [e["timestamp"] for e in events] == sorted(e["timestamp"] for e in events)


def test_unknown_format(make):
    with pytest.raises(ValueError, match="Unsupported format: pdf"):
        reports.generate_report("pdf", *tables(make))


def test_summary_and_advice(make):
    incidents, journal, problems, _ = tables(make)
    row = reports.summary_of(rca.rca_analysis(incidents, journal, problems), incidents).filter("number = 'INC1'").first()
    assert row.summary.startswith("Incident INC1 (Scanners offline) occurred with priority 2 - High. The incident was resolved in 96.0 hours. ")
    assert "root cause" in row.summary.lower() and len(row.summary) > 100
    assert "Configuration" in row.recommendations and "Change Control" in row.recommendations


def test_filters(make):
    incidents = make.incidents({"assignment_group": "IT Network"}, {"number": "INC2", "assignment_group": "Desk", "state": "New"},
                               {"number": "INC3", "assignment_group": "network", "state": "New", "priority": "3", "opened_at": "2025-01-01 00:00:00"})
    numbers = lambda df: sorted(r.number for r in df.collect())
    assert numbers(filters.filter_group(incidents)) == ["INC1", "INC3"]
    assert numbers(filters.filter_open(incidents, closed=["6 - Resolved"])) == ["INC3"]
    assert numbers(filters.filter_priority_in(incidents, ["3"])) == ["INC3"]
    assert numbers(filters.filter_priority_at_most(incidents, 2)) == ["INC1", "INC2"]
    typed = incidents.withColumn("opened_at", F.col("opened_at").cast("timestamp_ntz"))
    recent = filters.filter_recent(typed, 7, datetime(2025, 1, 16), opened="opened_at")
    assert numbers(recent) == ["INC1", "INC2"]
    assert numbers(filters.lookup_incident(incidents, "INC2")) == ["INC2"]
    assert numbers(filters.lookup_incident(incidents, incidents.filter("priority = '3'"))) == ["INC3"]
    assert numbers(filters.page_incidents(incidents, 1, 1)) == ["INC2"]
    assert filters.preview_incidents(incidents.drop("state")).first().state == "N/A"
    assert filters.project_fields(incidents, ["number", "absent"]).columns == ["number"]
