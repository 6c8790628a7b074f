"""Files, jobs and the stream of landed exports."""

import json
import pathlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from outagelens.functions import times
from outagelens.operators import enrich, filters, profile, redact, skew
from outagelens.plans.batch import BatchPaths, run_batch
from outagelens.plans.rca_job import run_rca
from outagelens.sources import files, schemas, scratch
from outagelens.streaming import landing

EXPORT = [
    ("INC1", 1, "70012 - Bursa - Turkey / Depot 7", "Global Network", "2025-03-04 05:06:07", "3 - Moderate", "Wireless", "Berg, Ann",
     "Radio cell silent", "Mail ann@x.de or 555-123-4567", "2025-03-04 - seen", "In Progress", "ann@x.de", "", "Network", "RADIO-17", "Phone"),
    ("INC2", 0, "70034 - Bremen - Germany / Hall 3", "EMEA Network", "2025-03-02 11:12:13", "1 - Critical", "Router", None,
     "Remote \"site\", lost", "line one\nline two", None, "Resolved", "bo@x.de", "2025-03-03 15:12:13", "Net", "EDGE-4", "Email"),
]


def export(spark):
    return spark.createDataFrame(EXPORT, schemas.LIVE_EXPORT)


def test_csv_round_trip(spark, tmp_path):
    files.sink_csv(export(spark), str(tmp_path / "csv"))
    back = files.scan_csv(spark, str(tmp_path / "csv"), schemas.LIVE_EXPORT, multi_line=True)
    expected = [tuple(value or None if isinstance(value, str) else value for value in row) for row in EXPORT]
    assert sorted(map(tuple, back.collect())) == sorted(expected)
    assert files.scan_csv(spark, str(tmp_path / "csv"), schemas.LIVE_EXPORT, limit=1, multi_line=True).count() == 1


def test_missing_stage_is_empty(spark, tmp_path):
    empty = files.scan_stage(spark, str(tmp_path / "absent"), schemas.STANDARD_EXPORT)
    assert empty.count() == 0 and empty.columns == schemas.STANDARD_EXPORT.names


def write_envelopes(folder):
    folder.mkdir()
    records = [
        {"number": "INC1", "assigned_to": {"display_value": "Ann", "link": "u"}, "state": "New", "short_description": "VPN",
         "opened_at": "2025-07-15 14:00:00", "location": "1 - Rome - Italy / HQ", "caller_id": "x@y.de"},
        {"number": "INC2", "assigned_to": "Bo", "state": "Resolved", "description": "ask Anna Berg"},
    ]
    (folder / "page1.json").write_text(json.dumps({"result": records}))
    (folder / "page2.json").write_text(json.dumps({"result": []}))


def test_json_envelope(spark, tmp_path):
    write_envelopes(tmp_path / "landed")
    rows = {r.number: r for r in files.scan_json_envelope(spark, str(tmp_path / "landed"), schemas.INCIDENT).collect()}
    assert json.loads(rows["INC1"].assigned_to)["display_value"] == "Ann"
    assert rows["INC2"].assigned_to == "Bo" and rows["INC2"].opened_at is None


def test_stream_equals_batch(spark, tmp_path):
    write_envelopes(tmp_path / "landed")
    stream = landing.landed_incidents(spark, str(tmp_path / "landed"), schemas.INCIDENT)
    query = landing.write_redacted(stream, str(tmp_path / "out"), str(tmp_path / "state"), "pepper")
    query.awaitTermination()
    rows = {r.number: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["INC1"].isActive and rows["INC1"].patternCategory == "VPN/Remote Access" and rows["INC1"].location == "Italy"
    assert rows["INC2"].description == "ask [NAME_REDACTED]" and "caller_id" not in rows["INC2"].asDict()


def test_scratch_folder_follows_the_session(spark):
    named = spark.conf.get(scratch.SETTING)
    first, second = scratch.scratch_folder(spark, "x"), scratch.scratch_folder(spark, "x")
    assert first != second and first.startswith(f"{named}/x-")
    with scratch.job_scratch(spark, "job") as folder:
        assert scratch.stored(spark.range(3), "rows").count() == 3
        assert len(list(pathlib.Path(folder).iterdir())) == 1
    assert not pathlib.Path(folder).exists()


def test_a_cluster_must_name_its_scratch_folder():
    assert scratch.shared_by_one_process("local[4]") == scratch.local_folder()
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.shared_by_one_process(master)


def test_unreadable_pages_are_no_silent_loss(spark, tmp_path):
    landed = tmp_path / "pages"
    landed.mkdir()
    (landed / "line.json").write_text('{"result": [{"number": "INC3"}]}\n')
    (landed / "pretty.json").write_text('{\n "result": [\n  {"number": "INC1"},\n  {"number": "INC2"}\n ]\n}\n')
    (landed / "cut.json").write_text('{"result": [{"number": "INC4"')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        files.scan_json_envelope(spark, str(landed), schemas.INCIDENT).collect()
    bad = files.unreadable_pages(spark, str(landed), schemas.INCIDENT).collect()
    assert sorted(r.file.rsplit("/")[-1] for r in bad) == ["cut.json", "pretty.json"]
    bad = files.unreadable_pages(spark, str(landed), schemas.INCIDENT, multi_line=True).collect()
    assert [r.file.rsplit("/")[-1] for r in bad] == ["cut.json"]


def test_zone_offsets_and_other_forms(spark):
    rows = spark.createDataFrame(
        [("2025-01-15T10:00:00+02:00", "2025-01-15T10:00:00Z"), ("15/07/2025 09:30", "junk"), (None, "")],
        "openedDate string, resolvedDate string",
    )
    read = enrich.coerce_timestamps(rows, formats=["dd/MM/yyyy HH:mm"])
    hours = [r[0] for r in read.select(times.hours_between("openedDate", "resolvedDate")).collect()]
    assert hours == [2.0, None, None]
    assert read.collect()[1].openedDate == datetime(2025, 7, 15, 9, 30)
    unread = enrich.unread_timestamps(rows).first()
    assert (unread.openedDate, unread.resolvedDate) == (1, 1)


def test_rows_without_key_or_state_stay_defined(spark):
    keyed = spark.createDataFrame([("", "a"), (None, "b"), ("k", "c")], "sys_id string, x string")
    normal, hot = skew.split_hot(keyed, "sys_id", "x", piece_rows=1)
    assert [r.x for r in normal.collect()] == ["c"] and hot is None
    rows = spark.createDataFrame([("INC1", "Network", None), (None, "Network", "6")], "number string, assignment_group string, state string")
    assert [r.number for r in filters.filter_open(rows).collect()] == ["INC1"]
    estimates = enrich.enrich_incidents(rows).collect()
    assert all(r.userImpactEstimate is not None for r in estimates)
    empty = {r.metric: r.n for r in profile.analyze_incidents(enrich.enrich_incidents(rows).limit(0)).collect()}
    assert empty["total_incidents"] == 0 and empty["median_resolution_hours"] is None


def test_batch_run(spark, tmp_path):
    paths = BatchPaths.under(str(tmp_path / "run"))
    for _ in range(2):
        results = run_batch(spark, export(spark), paths, "pepper", as_csv=True)
    assert results["processed"].count() == 2
    redacted = {r.number: r for r in results["redacted"].collect()}
    assert redacted["INC1"].description == "Mail [EMAIL_REDACTED] or [PHONE_REDACTED]" and redacted["INC1"].location == "Turkey"
    assert results["redaction_check"].first().redaction_successful
    analysis = {(r.metric, r.key): r.n for r in results["analysis"].collect()}
    assert analysis[("total_incidents", None)] == 2 and analysis[("active_incidents", None)] == 1
    metrics = spark.read.option("header", True).csv(paths.metrics).collect()
    assert [r.raw_record_count for r in metrics] == ["2", "2"]
    processed = spark.read.option("header", True).options(multiLine=True, escape='"').csv(paths.processed + "_csv")
    assert processed.count() == 2
    assert redact.text_columns(processed)


def test_rca_run(spark, tmp_path):
    incidents = spark.createDataFrame(
        [("s1", "INC1", "VPN down", "2 - High", "2025-01-15 10:00:00", "2025-01-15 14:30:00", None),
         ("s2", "INC2", "WiFi down", "3 - Moderate", "2025-01-16 10:00:00", None, "s1"),
         ("s3", "INC3", "DNS", "1 - Critical", "2025-01-17 10:00:00", None, "s2")],
        "sys_id string, number string, short_description string, priority string, opened_at string, resolved_at string, parent string",
    )
    nothing = F.lit(None).cast("string")
    incidents = incidents.withColumns({name: nothing for name in (
        "description", "impact", "urgency", "state", "category", "assignment_group", "assigned_to", "caller_id", "cmdb_ci",
        "reassignment_count")})
    journal = spark.createDataFrame(
        [("2025-01-15 11:00:00", "incident", "Root cause: cable.", "s1", "work_notes"),
         ("2025-01-15 11:00:00", "problem", "Root cause: other.", "s2", "work_notes")],
        "sys_created_on string, name string, value string, element_id string, element string",
    )
    problems = spark.createDataFrame([], schemas.PROBLEM)
    changes = spark.createDataFrame([], schemas.CHANGE)
    formats = ("markdown", "json", "text")
    at = datetime(2025, 2, 1)
    analysis = run_rca(spark, incidents, journal, problems, changes, str(tmp_path / "all"), formats, as_of=at)
    causes = {r.number: r.root_cause for r in analysis.collect()}
    assert causes["INC1"] == "root cause: cable." and causes["INC2"] == "Based on incident description: WiFi down"
    every = spark.read.json(str(tmp_path / "all" / "reports"))
    assert every.count() == 9
    run_rca(spark, incidents, journal, problems, changes, str(tmp_path / "one"), formats, wanted="INC1", as_of=at)
    one = spark.read.json(str(tmp_path / "one" / "reports"))
    assert sorted(r.file_name for r in one.collect()) == ["INC1.json", "INC1.md", "INC1.txt"]
    both = [df.filter("number = 'INC1'").select("file_name", "report").collect() for df in (every, one)]
    assert sorted(both[0]) == sorted(both[1])
