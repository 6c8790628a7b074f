"""Report files are compressed and read back as they were."""

from outagelens.sources import files


def test_reports_are_compressed_and_read_back(spark, tmp_path):
    text = "# Report\n" + "- the same line\n" * 200
    rows = spark.createDataFrame([(f"INC{i}", i % 2, f"{text}{i} é") for i in range(50)], "number string, part long, report string")
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        files.sink_reports(rows, path, "Markdown", compression=compression)
        assert sorted(map(tuple, files.scan_reports(spark, path, "markdown").collect())) == sorted(map(tuple, rows.collect()))
    sizes = [sum(p.stat().st_size for p in (tmp_path / x).rglob("part-*")) for x in ("gzip", "none")]
    assert sizes[0] * 5 < sizes[1]
    files.sink_reports(rows, str(tmp_path / "usual"), "text")
    assert all(p.name.endswith(".json.gz") for p in (tmp_path / "usual").rglob("part-*"))
