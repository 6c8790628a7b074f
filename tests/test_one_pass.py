"""Work that reads its tables once: digest, statistics, observed counts, directories, streams."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from outagelens.functions import cause
from outagelens.operators import enrich, filters, profile, quantile, rca, redact, skew
from outagelens.plans.batch import BatchPaths, run_batch
from outagelens.sources import files, schemas
from outagelens.streaming import landing

JOURNAL = "entry_id string, element_id string, name string, element string, sys_created_on string, author string, value string"


def journal_rows(entries):
    """Entries of (sys_id, element, minute, text)."""
    start = datetime(2025, 3, 1)
    return [(f"e{i:06d}", s, "incident", kind, str(start + timedelta(minutes=m)), "A", t) for i, (s, kind, m, t) in enumerate(entries)]


def scans(df, path):
    """How often the plan reads files below the path."""
    session, name = df.sparkSession, "spark.sql.maxMetadataStringLength"
    before = session.conf.get(name)
    session.conf.set(name, 1000)  # paths are cut off otherwise
    try:
        lines = df.select("*")._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        session.conf.set(name, before)
    return sum("FileScan" in line and str(path) in line for line in lines)


@pytest.fixture
def hot_journal(spark, tmp_path):
    """One incident holds a third of all notes; its sentence runs over many of them."""
    entries = [(f"s{i}", "work_notes", i % 50, f"Step {i}. Root cause: cable {i}. Done") for i in range(200)]
    entries += [("hot", "work_notes", m, "still looking" if m != 60 else "begin. the root") for m in range(100)]
    entries += [("hot", "comments", m, "cause was a fan" if m == 0 else "calm. yes") for m in range(5)]
    entries[-6] = ("hot", "work_notes", 99, "so. the root")  # the last note, before the comments
    path = str(tmp_path / "journal")
    spark.createDataFrame(journal_rows(entries), JOURNAL).write.parquet(path)
    return spark.read.parquet(path), path


@pytest.mark.parametrize(("piece_rows", "piece_bytes"), [(10_000, 1 << 24), (7, 1 << 24), (10_000, 200)])
def test_a_sentence_over_many_notes_of_a_hot_incident(hot_journal, piece_rows, piece_bytes):
    journal, _ = hot_journal
    found = {r.sys_id: r.sentence for r in rca.cause_sentences(journal, piece_rows, piece_bytes=piece_bytes).collect()}
    assert found.pop("hot") == "the root cause was a fan calm."
    assert found == {f"s{i}": f"root cause: cable {i}." for i in range(200)}


def test_reduced_texts_say_the_same(spark):
    """For any cut of a text, joined reductions give the sentence of the whole."""
    parts = ["a. the root", "cause is b", "c. d. root cause e. f. root cause g", "", ".", "h root cause", "i. j"]
    rows = [(parts[i : i + n],) for i in range(len(parts)) for n in range(1, len(parts) - i + 1)]
    df = spark.createDataFrame(rows, "parts array<string>")
    joined = F.array_join(F.transform("parts", lambda x: cause.reduced_text(cause.sentence_pieces(x))), " ")
    got = df.select(cause.cause_sentence(joined).alias("a"), cause.cause_sentence(F.array_join("parts", " ")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and any(r.a for r in got)


def test_the_analysis_reads_the_journal_twice(spark, hot_journal, tmp_path, monkeypatch):
    journal, path = hot_journal
    writes = []
    keep = rca.stored
    monkeypatch.setattr(rca, "stored", lambda rows, name: writes.append((name, scans(rows, path))) or keep(rows, name))
    incidents = spark.createDataFrame([("hot", "INC1")], "sys_id string, number string")
    nothing = ("description", "short_description", "priority", "impact", "urgency", "category", "cmdb_ci", "opened_at",
               "resolved_at", "reassignment_count", "close_notes")
    incidents = incidents.withColumns({name: F.lit(None).cast("string") for name in nothing})
    problems = spark.createDataFrame([], schemas.PROBLEM)
    for piece_rows, stored, left in ((10_000, [("journal-digest", 1)], 1), (7, [("journal-digest", 1), ("sentence-states", 1)], 0)):
        writes.clear()
        analysis = rca.rca_analysis(incidents, journal, problems, piece_rows=piece_rows)
        assert writes == stored and scans(analysis, path) == left
        assert analysis.first().root_cause == "the root cause was a fan calm."


def test_hot_keys_of_all_lists_come_from_one_aggregate(spark):
    rows = [("a", f"k{i % 4}", 1, 10) for i in range(40)] + [("b", "k9", 1, 10_000)]
    sizes = spark.createDataFrame(rows, "list string, k string, n int, bytes int")
    hot = skew.find_hot(sizes, "k", piece_rows=9, piece_bytes=5_000)
    assert sorted(hot["a"].values) == ["k0", "k1", "k2", "k3"] and hot["b"].values == ("k9",)
    table = skew.find_hot(sizes, "k", piece_rows=9, piece_bytes=5_000, broadcast_keys=2)
    assert sorted(r.k for r in table["a"].table.collect()) == ["k0", "k1", "k2", "k3"] and not table["b"].none()
    assert skew.find_hot(sizes.limit(0), "k") == {}


@pytest.mark.parametrize("build", [profile.resolution_stats, profile.category_profile, profile.analyze_incidents,
                                   lambda df: profile.distribution(df, "patternCategory")])
def test_statistics_do_not_come_back_to_the_source(spark, tmp_path, build):
    """All that is read after the stored counts is these counts."""
    path = str(tmp_path / "source-table")
    rows = [(f"INC{i}", "p" if i % 3 else None, float(i % 7) if i % 5 else None, i % 2 == 0, "g", "2", "x", i % 4, 10) for i in range(60)]
    schema = ("number string, patternCategory string, resolutionTimeHrs double, isActive boolean, assignment_group string, "
              "priority string, location string, week int, userImpactEstimate int")
    df = spark.createDataFrame(rows, schema).withColumns({"isHighImpact": F.col("isActive"), "slaBreach": F.col("resolutionTimeHrs") > 4})
    df.write.parquet(path)
    source = spark.read.parquet(path)
    found = build(source)
    assert scans(found, path) == 0 and scans(source, path) == 1 and found.count() > 0


def test_hours_from_counts(spark):
    hours = [0.5, 1.25, 1.25, 7.0, None, 100.0]
    df = spark.createDataFrame([(h,) for h in hours], "resolutionTimeHrs double")
    row = profile.resolution_stats(df).first()
    known = sorted(h for h in hours if h is not None)
    assert (row.fastest_hours, row.longest_hours, row.median_hours) == (known[0], known[-1], 1.25)
    assert row.avg_hours == pytest.approx(sum(known) / len(known), rel=1e-12)
    empty = profile.resolution_stats(df.limit(0)).first()
    assert (empty.avg_hours, empty.median_hours, empty.fastest_hours) == (None, None, None)


def test_sketches_of_parts_answer_for_all(spark):
    rows = spark.range(200_000).select((F.col("id") % 10).alias("day"), (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1000).alias("h"))
    parts = quantile.hour_sketches(rows, F.col("h"), ["day"])
    for rank in (0.01, 0.5, 0.99):
        n, answer = quantile.merge_sketches(parts, []).select("n", quantile.sketch_quantile(rank)).first()
        below = rows.filter(F.col("h") <= answer).count() / n
        assert n == 200_000 and abs(below - rank) < quantile.RANK_ERROR
    none = quantile.hour_sketches(rows.withColumn("h", F.lit(None).cast("double")), F.col("h"), ["day"])
    assert {r[0] for r in none.select(quantile.sketch_quantile(0.5)).collect()} == {None}


def test_counts_while_writing_equal_counts_of_tables(spark, tmp_path):
    raw = spark.createDataFrame(
        [(f"INC{i}", "New" if i % 2 else "Resolved", "mail a@b.com or 0532 123 45 67", f"{i % 5 + 1} - x") for i in range(30)],
        "number string, state string, short_description string, priority string",
    ).repartition(4)
    at = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    run = profile.ObservedRun(spark)
    run.processed(enrich.enrich_incidents(run.raw(raw))).write.parquet(str(tmp_path / "p"))
    processed = spark.read.parquet(str(tmp_path / "p"))
    assert run.metrics(at).collect() == profile.run_metrics(raw, processed, at).collect()
    seen = redact.ObservedRedaction(spark)
    seen.redacted(redact.redact_live_export(seen.original(processed), "s")).write.parquet(str(tmp_path / "r"))
    assert seen.check().collect() == redact.validate_redaction(processed, spark.read.parquet(str(tmp_path / "r"))).collect()


def test_a_run_that_is_tried_again_leaves_one_row(spark, tmp_path):
    raw = files.scan_csv(spark, _export(tmp_path), schemas.LIVE_EXPORT)
    paths = BatchPaths.under(str(tmp_path / "run"))
    for run_id in ("monday", "monday", "tuesday"):
        run_batch(spark, raw, paths, "pepper", run_id=run_id)
    rows = spark.read.option("header", True).csv(paths.metrics).collect()
    assert sorted((r.run_id, r.raw_record_count) for r in rows) == [("monday", "2"), ("tuesday", "2")]


def _export(tmp_path):
    names = [f.name for f in schemas.LIVE_EXPORT.fields]
    path = tmp_path / "export.csv"
    values = [{"number": "INC1", "opened_at": "2025-01-01 08:00:00", "priority": "1 - Critical"}, {"number": "INC2"}]
    lines = [",".join(str(v.get(n, "")) for n in names) for v in values]
    path.write_text("\n".join([",".join(names), *lines]) + "\n")
    return str(path)


@pytest.mark.parametrize("size", [1, 7, 100])
def test_pages_by_directory_equal_pages_by_offset(spark, size):
    rows = spark.range(40).select(F.format_string("INC%05d", F.col("id") * 7 % 41).alias("number"), "id").repartition(5)
    directory = filters.page_directory(rows, size)
    pages = -(-40 // size)
    assert sorted(r.page for r in directory.collect()) == list(range(pages))
    for page in {0, 1, pages // 2, pages - 1, pages}:
        expected = filters.page_incidents(rows, size, page * size).collect()
        assert filters.directory_page(rows, directory, page).collect() == expected


def test_a_replayed_batch_replaces_its_results(spark, tmp_path):
    landed, out, checkpoint = (str(tmp_path / name) for name in ("landed", "out", "checkpoint"))
    os.makedirs(landed)

    def land(name, *numbers):
        records = ", ".join(f'{{"number": "{n}", "sys_id": "s{n}", "priority": "1", "short_description": "shelf lamp dark", "opened_at": "2025-01-01 00:00:00"}}' for n in numbers)
        with open(f"{landed}/{name}.json", "w") as file:
            file.write(f'{{"result": [{records}]}}\n')

    def run():
        query = landing.write_analysis(landing.landed_incidents(spark, landed, schemas.INCIDENT), out, checkpoint)
        query.awaitTermination()
        return sorted(r.number for r in spark.read.parquet(out).collect())

    land("one", "INC1", "INC2")
    assert run() == ["INC1", "INC2"]
    land("two", "INC3")
    assert run() == ["INC1", "INC2", "INC3"]
    last = max((name for name in os.listdir(f"{checkpoint}/commits") if name.isdigit()), key=int)
    os.remove(f"{checkpoint}/commits/{last}")  # as if the run had died before it could commit
    os.remove(f"{checkpoint}/commits/.{last}.crc") if os.path.exists(f"{checkpoint}/commits/.{last}.crc") else None
    assert run() == ["INC1", "INC2", "INC3"]
    causes = {r.root_cause for r in spark.read.parquet(out).collect()}
    assert causes == {"Based on incident description: shelf lamp dark"}
