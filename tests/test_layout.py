"""Tables stored by incident: the same reports, without moving the rows again."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from outagelens.operators import bundle, packing, rca, reports
from outagelens.operators.layout import incident_layout
from outagelens.plans import rca_job
from outagelens.sources import schemas

AT = datetime(2025, 6, 1)
LISTS = ("timeline", *bundle.RELATED)


@pytest.fixture
def tables(spark, tmp_path):
    """Incident s0 holds a third of the journal, a third of the children and a long list of problems."""
    start = datetime(2025, 3, 1)
    n = 40
    incidents = spark.createDataFrame(
        [(f"s{i}" if i != n - 1 else None, f"INC{i:03d}", f"lamp {i}", "2 - High", str(start), str(start + timedelta(hours=i)) if i % 3 else None,
          None if i == 0 else f"s{i // 4 if i % 3 else 0}") for i in range(n)],
        "sys_id string, number string, short_description string, priority string, opened_at string, resolved_at string, parent string",
    )
    empty = ("description", "impact", "urgency", "state", "category", "assignment_group", "assigned_to", "caller_id", "cmdb_ci", "reassignment_count")
    incidents = incidents.withColumns({name: F.lit(None).cast("string") for name in empty})
    about = [f"s{i % (n - 5)}" for i in range(100)] + ["s0"] * 50 + [None, ""]
    journal = spark.createDataFrame(
        [(f"e{i:04d}", s, "incident", "work_notes" if i % 2 else "comments", str(start + timedelta(minutes=i % 60)), "A", f"note {i}. root cause: plug {i}.")
         for i, s in enumerate(about)],
        "entry_id string, element_id string, name string, element string, sys_created_on string, author string, value string",
    )
    problems = spark.createDataFrame([{"number": f"PRB{i}", "incidents": f"s0, s{i}", "short_description": f"p {i}"} for i in range(12)], schemas.PROBLEM)
    changes = spark.createDataFrame([{"number": "CHG1", "incidents": "s1,s2"}], schemas.CHANGE)
    found = []
    for name, df in {"incidents": incidents, "journal": journal, "problems": problems, "changes": changes}.items():
        df.write.parquet(str(tmp_path / name))
        found.append(spark.read.parquet(str(tmp_path / name)))
    return tuple(found)


def made(tables, kind, **options):
    return sorted(map(tuple, reports.generate_report(kind, *tables, as_of=AT, **options).collect()))


def plan_of(df):
    session, name = df.sparkSession, "spark.sql.maxMetadataStringLength"
    before = session.conf.get(name)
    session.conf.set(name, 1000)  # paths are cut off otherwise
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        session.conf.set(name, before)


@pytest.mark.parametrize("piece_rows", [10_000, 8, 1])
def test_reports_of_a_layout_equal_those_of_the_tables(spark, tables, piece_rows):
    digest = rca.stored_digest(tables[1])
    analysis = rca.stored(rca.rca_analysis(*tables[:3], digest=digest), "analysis")
    before = spark.catalog.listTables()
    with incident_layout(*tables, analysis, LISTS, buckets=4, piece_rows=piece_rows) as layout:
        assert (layout.long is None) == (piece_rows == 10_000)
        for kind, more in (("markdown", {}), ("text", {}), ("json", {"piece_rows": piece_rows})):
            laid = made(tables, kind, layout=layout, digest=digest, **more)
            plain = made(tables, kind, analysis=analysis, digest=digest, **more)
            if kind == "json" and layout.long is not None:  # ranges may cut long lists at other places
                laid, plain = entries(spark, laid), entries(spark, plain)
            assert laid and laid == plain
    assert spark.catalog.listTables() == before


def entries(spark, documents):
    """All list entries of all parts."""
    rows = spark.createDataFrame(documents, "number string, part long, report string")
    lists = ["$.timeline", *(f"$.related_records.{kind}" for kind in ("incidents", "problems", "changes"))]
    found = rows.select("number", F.explode(F.array(*[F.get_json_object("report", path) for path in lists])).alias("items"))
    items = found.select("number", F.explode(F.from_json("items", "array<string>")).alias("item"))
    return sorted(map(tuple, items.collect()))


def test_usual_incidents_are_not_moved_again(spark, tables):
    digest = rca.stored_digest(tables[1])
    analysis = rca.stored(rca.rca_analysis(*tables[:3], digest=digest), "analysis")
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, ("false", "-1"), strict=True):
            spark.conf.set(name, value)
        with incident_layout(*tables, analysis, LISTS) as layout:
            document = plan_of(reports.report_json(*tables, as_of=AT, layout=layout))
            assert "Exchange" not in document and "SortMergeJoin" in document
            # Only the digest's counts of entries move: one narrow row for each incident.
            report = plan_of(reports.report_markdown(*tables, as_of=AT, digest=digest, layout=layout))
            assert report.count("Exchange") == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_the_run_shuffles_events_once(spark, tables, tmp_path, monkeypatch):
    plans = []
    sink = rca_job.files.sink_reports
    monkeypatch.setattr(rca_job.files, "sink_reports", lambda rows, *rest: plans.append(plan_of(rows)) or sink(rows, *rest))
    rca_job.run_rca(spark, *tables, str(tmp_path / "out"), ("markdown", "json", "text"), as_of=AT)
    assert len(plans) == 3 and not any(f"{tmp_path}/{name}" in plan for plan in plans for name in ("journal", "problems"))
    assert spark.read.json(str(tmp_path / "out" / "reports")).count() == 39 + 39 + 40  # without a sys_id there is no analysis to render


def test_an_empty_table_has_an_empty_layout(spark, tables):
    none = [table.limit(0) for table in tables]
    analysis = rca.stored(rca.rca_analysis(*none[:3]), "analysis")
    with incident_layout(*none, analysis, LISTS) as layout:
        assert layout.long is None and made(none, "json", layout=layout) == [] == made(none, "markdown", layout=layout)


def test_a_bundle_without_long_lists_deals_each_list_once(spark, tables):
    """Lists go to their incident once and are gathered in one pass; part is no key of a join."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, ("false", "-1"), strict=True):
            spark.conf.set(name, value)
        plan = plan_of(bundle.incident_bundle(*tables, lists=LISTS))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert plan.count("Exchange") == 1 + len(LISTS) and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("piece_rows", [10_000, 8])
def test_usual_and_long_bundles_hold_the_same(tables, piece_rows):
    rows = bundle.incident_bundle(*tables, piece_rows=piece_rows).collect()
    assert sorted(r.number for r in rows if r.part == 0) == [f"INC{i:03d}" for i in range(40)]
    for list_name in bundle.LISTS:
        assert sum(len(r[list_name]) for r in rows) == sum(r.totals[list_name] for r in rows if r.part == 0)
    timeline = {r.number: r.totals.timeline for r in rows if r.part == 0}
    assert timeline["INC000"] == 1 + 53 and timeline["INC039"] == 0


def test_first_events_are_the_same_with_and_without_long_incidents(tables, monkeypatch):
    found = {}
    for long in (True, False):
        monkeypatch.setattr(reports, "any_long", lambda digest, long=long: long)
        found[long] = made(tables, "markdown")
        frame = reports.report_markdown(*tables, as_of=AT)
        assert plan_of(reports._timeline_blocks(*tables[:2], rca.stored_digest(tables[1]))).count("WindowGroupLimit") == 2 * long
        assert frame.columns == ["number", "part", "report"]
    assert found[True] == found[False]
    assert "*(34 more events)*" in next(report for number, _, report in found[False] if number == "INC000")


@pytest.fixture
def plain_plans(spark):
    """Plans as they are made, without adaptive changes and broadcasts."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("false", "-1"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_all_lists_of_the_journal_move_once(plain_plans, tables):
    """Events and notes go to their incident together: one exchange next to those of incidents and related records."""
    assert plan_of(bundle.incident_bundle(*tables)).count("Exchange") == 2 + len(bundle.RELATED)


def test_an_analysed_incident_does_not_move_again(plain_plans, tables):
    """In the last step of a report neither incidents nor analysis move."""
    assert plan_of(reports.report_json(*tables, as_of=AT)).count("Exchange") == 1 + len(bundle.RELATED)
    # Events, related records (to be ranked, to be gathered), entry counts and the incidents that these are for.
    for kind in ("markdown", "text"):
        assert plan_of(reports.generate_report(kind, *tables, as_of=AT)).count("Exchange") == 5


def test_what_was_shuffled_goes_with_its_query(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}

    before = shuffled()
    rca.stored(spark.range(1000).repartition(4, "id"), "shuffled")
    assert shuffled() <= before


def test_ids_travel_short_and_arrive_whole(spark):
    ids = ["0" * 32, "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "f" * 31, "f" * 32 + "\n", "g" * 32, "", " ", "ä", None] * 3
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n int, sys_id string")
    moved = packing.dealt(rows, "sys_id")
    assert moved.columns == rows.columns and sorted(map(tuple, moved.collect())) == list(enumerate(ids))
    met = moved.groupBy("sys_id").count()
    assert {(r.sys_id, r["count"]) for r in met.collect()} == {(x, 3) for x in ids}
    assert plan_of(met).count("Exchange ") == 1
