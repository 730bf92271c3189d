import json
import os
from datetime import datetime

import pytest

from hazelake import __main__ as cli
from hazelake.plans import jobs
from hazelake.plans.session import create_session, size_shuffles
from hazelake.plans.silver import clean_daily
from hazelake.sources.bronze import DOCUMENT, INDENTED, LINES, land_snapshot
from hazelake.sources.silver import read_silver
from hazelake.streaming.snapshots import ingest_stream
from samples import daily, rows_of, sensor, station

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def bronze(tmp_path):
    """A dump of each source beside older ones that must not be read."""
    base = tmp_path / "bronze"
    daily_rows = [{"date": "2026-05-27", "pollutant": "pm25", "concentration": 10.5}] * 2
    doc = {"location_id": 12, "results": [station(12, "KLCC", [sensor("co"), sensor("no")])]}
    old = [{"date": "2020-01-01", "pollutant": "co", "concentration": 1}]
    for name, value, age in (
        ("opendosm/opendosm_air_pollution_20260101_000000.json", old, 100),
        ("opendosm/opendosm_air_pollution_20260527_000000.json", daily_rows, 200),
        ("openaq/openaq_measurements_20260527_000000.json", [doc], 200),
    ):
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(value, indent=2))
        os.utime(path, (age, age))
    return str(base)


def test_full_run_ingests_the_newest_dump_of_each_source(spark, tmp_path):
    silver = str(tmp_path / "silver")
    reports = jobs.run(spark, bronze(tmp_path), silver)
    assert [(r.source, r.rows) for r in reports] == [("opendosm", 1), ("openaq", 2)]
    assert reports[0].bronze_path.endswith("20260527_000000.json")
    assert reports[0].silver_path == silver + "/air_quality"
    stored = rows_of(reports[0].readings(spark))
    assert len(stored) == 3
    again = jobs.run(spark, bronze(tmp_path), silver)
    assert [r.rows for r in again] == [1, 2]
    assert rows_of(again[0].readings(spark)) == stored


def test_one_source_only_and_nothing_at_all(spark, tmp_path):
    base, silver = bronze(tmp_path), str(tmp_path / "silver")
    assert [r.source for r in jobs.run(spark, base, silver, source="openaq")] == ["openaq"]
    assert jobs.run(None, base, silver, dry_run=True) == []
    assert jobs.run(None, base, silver, skip_ingest=True) == []
    with pytest.raises(ValueError, match="Unsupported air-quality source: other"):
        jobs.run(spark, base, silver, source="other")
    with pytest.raises(ValueError, match="Unsupported air-quality source: other"):
        jobs.ingest(spark, base, silver, "other")
    with pytest.raises(FileNotFoundError):
        jobs.ingest_latest(spark, "opendosm", str(tmp_path / "none"), silver)


def test_partial_dump_replaces_or_merges(spark, tmp_path):
    silver = str(tmp_path / "silver")
    for day, (pollutant, merge) in enumerate((("co", False), ("no", True), ("o3", False)), 1):
        rows = daily(spark, [("2026-05-27", pollutant, 1.0)])
        dump = land_snapshot(rows, str(tmp_path / "b"), "opendosm", datetime(2026, 5, day))
        report = jobs.ingest(spark, dump, silver, "opendosm", merge=merge)
        found = sorted(row.pollutant for row in report.readings(spark).collect())
        assert found == {1: ["CO"], 2: ["CO", "NO"], 3: ["O3"]}[day]


def test_stream_takes_each_dump_once(spark, tmp_path):
    base, silver = str(tmp_path / "b"), str(tmp_path / "silver")
    batches = [daily(spark), daily(spark, [("2026-05-27", "co", 1.0), ("2026-06-01", "co", 2.0)])]
    for day, rows in enumerate(batches, 1):
        land_snapshot(rows.repartition(2), base, "opendosm", datetime(2026, 6, day))
        for _ in range(2):
            ingest_stream(
                spark,
                base + "/opendosm/*.json",
                silver,
                "opendosm",
                str(tmp_path / "progress"),
                max_files=1,
            ).awaitTermination()
    stored = read_silver(spark, silver + "/air_quality")
    assert rows_of(stored) == rows_of(clean_daily(batches[0].union(batches[1])))


@pytest.mark.parametrize(("layout", "style"), [(DOCUMENT, {}), (INDENTED, {"indent": 2}), (LINES, None)])
def test_stream_reads_each_layout(spark, tmp_path, layout, style):
    rows = [{"date": f"2026-02-{d:02d}", "pollutant": "o3", "concentration": d} for d in range(1, 11)]
    folder = tmp_path / "b"
    folder.mkdir()
    text = "\n".join(map(json.dumps, rows)) if style is None else json.dumps(rows, **style)
    (folder / "dump.json").write_text(text)
    places = (str(folder), str(tmp_path / "s"), "opendosm", str(tmp_path / "p"))
    ingest_stream(spark, *places, layout=layout).awaitTermination()
    assert read_silver(spark, str(tmp_path / "s" / "air_quality")).count() == 10


def test_command_line(tmp_path, monkeypatch, spark):
    base, silver = bronze(tmp_path), str(tmp_path / "silver")
    args = ["--bronze", base, "--silver", silver]
    assert cli.main([*args, "--dry-run"]) == 0

    class Kept:
        """The test session, which the command must not stop."""

        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    monkeypatch.setattr(cli, "create_session", Kept)
    try:
        assert cli.main([*args, "--skip-ingest"]) == 0
        assert not os.path.exists(silver)
        assert cli.main([*args, "--source", "opendosm"]) == 0
        assert read_silver(spark, silver + "/air_quality").count() == 1
        assert cli.main(["--bronze", str(tmp_path / "none"), "--silver", silver]) == 1
        with pytest.raises(SystemExit):
            cli.main([*args, "--source", "other"])
    finally:
        spark.conf.unset(INITIAL)


def test_command_line_lands_and_streams(tmp_path, monkeypatch, spark):
    class Kept:
        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    monkeypatch.setattr(cli, "create_session", Kept)
    page = tmp_path / "landing" / "opendosm" / "run=a" / "offset=0"
    page.mkdir(parents=True)
    rows = [{"date": f"2026-05-{d:02d}", "pollutant": "co", "concentration": d} for d in range(1, 6)]
    (page / "page.json").write_text(json.dumps({"data": [*rows, {"date": "never"}]}))
    places = [f"--{name}={tmp_path / name}" for name in ("bronze", "silver", "landing", "rejects")]
    for _ in range(2):
        assert cli.main([*places, "--source", "opendosm", "--stream"]) == 0
    assert read_silver(spark, str(tmp_path / "silver" / "air_quality")).count() == 5
    rejects = spark.read.parquet(str(tmp_path / "rejects" / "opendosm" / "batch=0" / "taken=false"))
    assert [r.reason for r in rejects.collect()] == ["missing pollutant"]


def test_session_settings(spark):
    keep = {
        name: spark.conf.get(name, None)
        for name in (
            "spark.sql.sources.partitionOverwriteMode",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.session.timeZone",
        )
    }
    session = create_session("other", **{"spark.sql.session.timeZone": "UTC"})
    try:
        assert session.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
        assert session.conf.get("spark.sql.adaptive.enabled") == "true"
        assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        for name, value in keep.items():
            session.conf.unset(name) if value is None else session.conf.set(name, value)
        session.sparkContext.setLogLevel("ERROR")


def test_shuffles_start_with_partitions_for_their_input(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for size, wanted in ((10, least), (256 * 2**20 * 1000 + 1, 1001), (100 * 10**12, -(-100 * 10**12 // (256 * 2**20)))):
        assert size_shuffles(spark, size) == wanted == int(spark.conf.get(INITIAL))
        spark.conf.unset(INITIAL)
    spark.conf.set(INITIAL, "7")
    try:
        assert size_shuffles(spark, 10**12) == 7
    finally:
        spark.conf.unset(INITIAL)


def test_jobs_leave_the_session_as_it_is(spark, tmp_path):
    def settings():
        return {r.key: r.value for r in spark.sql("SET").collect()}

    before = settings()
    jobs.run(spark, bronze(tmp_path), str(tmp_path / "silver"), merge=True, rejects=str(tmp_path / "rejects"))
    assert settings() == before
