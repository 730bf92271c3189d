"""Streams that keep state: page runs and copies of readings."""

import random
from datetime import datetime, timedelta

import pytest

from hazelake.plans.silver import clean_daily, clean_stations
from hazelake.sources.bronze import land_snapshot
from hazelake.streaming.dedupe import append_stream, appended_readings, open_readings
from hazelake.streaming.runs import follow_runs, followed_pages
from hazelake.streaming.snapshots import stream_dumps
from samples import daily, documents, random_daily, rows_of, sensor, station

LAYOUT = "run string, offset long, size int, at timestamp"
START = datetime(2026, 5, 1)


def test_pages_behind_the_end_are_rejects_whenever_they_come(spark, tmp_path):
    landed, base = str(tmp_path / "pages"), str(tmp_path / "runs")

    def arrive(*pages):
        rows = [(run, offset, size, START + timedelta(minutes=minute)) for run, offset, size, minute in pages]
        spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("append").parquet(landed)
        stream, stored = spark.readStream.schema(LAYOUT).parquet(landed), spark.read.schema(LAYOUT).parquet(landed)
        follow_runs(stream, stored, base, str(tmp_path / "p"), "10 minutes", "5 minutes", limit=2).awaitTermination()
        found = followed_pages(spark, base, LAYOUT).collect()
        return sorted((r.run or "", r.offset, r.reason is None) for r in found)

    # a has a page behind its short one, b is still open, c has no short page, and one run has no name
    first = arrive(("a", 0, 2, 0), ("a", 4, 2, 1), ("a", 2, 1, 2), ("c", 0, 2, 0), (None, 0, 1, 1), ("b", 0, 2, 30))
    assert first == [("", 0, True), ("a", 0, True), ("a", 2, True), ("a", 4, False), ("c", 0, True)]
    # pages of ended runs come late, some of b; time goes on
    second = arrive(("c", 2, 2, 31), ("a", 6, 1, 32), ("b", 2, 0, 33), ("d", 0, 2, 90))
    assert second == sorted([*first, ("a", 6, False), ("b", 0, True), ("b", 2, True), ("c", 2, False)])
    assert arrive(("e", 0, 2, 91)) == second
    parted = spark.read.parquet(str(tmp_path / "runs" / "pages"))
    assert {(r.taken, r.reason) for r in parted.collect()} == {("true", None), ("false", "after the end of the run")}


def test_open_visits_are_a_table_that_later_batches_join(spark, tmp_path):
    landed, base, progress = str(tmp_path / "pages"), str(tmp_path / "runs"), tmp_path / "p"

    def arrive(*pages):
        rows = [(run, offset, size, START + timedelta(minutes=minute)) for run, offset, size, minute in pages]
        spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("append").parquet(landed)
        stream, stored = spark.readStream.schema(LAYOUT).parquet(landed), spark.read.schema(LAYOUT).parquet(landed)
        follow_runs(stream, stored, base, str(progress), "10 minutes", "5 minutes", limit=2).awaitTermination()
        closed = spark.read.parquet(base + "/closed").collect()
        return sorted((r.run, (r.last_at - r.first_at).seconds // 60, r.end, r.pages) for r in closed)

    assert arrive(("a", 0, 2, 0), ("a", 2, 2, 12), ("b", 0, 2, 0)) == []
    assert not (progress / "state").exists()  # nothing is held in memory until its time has passed
    # a's two visits are one by a page that comes between them, b's goes on from where it lay
    assert arrive(("a", 4, 1, 6), ("b", 2, 2, 9), ("c", 0, 2, 14)) == []
    assert arrive(("d", 0, 2, 40)) == [("a", 12, 4, 3), ("b", 9, None, 2), ("c", 0, None, 1)]
    # a page that comes after its time is in no visit
    assert arrive(("e", 0, 2, 20), ("d", 2, 1, 41)) == [("a", 12, 4, 3), ("b", 9, None, 2), ("c", 0, None, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_copies_are_one_reading_in_any_order_of_dumps(spark, tmp_path, seed):
    rows = random_daily(240) + [("2026-08-01", "co", 1.0), ("2026-08-02", "co", None)]
    order = [rows[i::4] for i in range(4)]
    random.Random(seed).shuffle(order)
    for day, part in enumerate(order, 1):
        land_snapshot(daily(spark, part), str(tmp_path / "b"), "opendosm", datetime(2026, 9, day))
    path, progress = str(tmp_path / "s"), str(tmp_path / "p")
    for _ in range(2):
        dumps = stream_dumps(spark, str(tmp_path / "b" / "opendosm" / "*.json"), "opendosm", max_files=1)
        append_stream(dumps, path, "opendosm", progress, "90 days").awaitTermination()
    found = appended_readings(spark, path).unionByName(open_readings(spark, progress))
    assert rows_of(found) == rows_of(clean_daily(daily(spark, rows)))


def test_state_goes_when_time_has_passed(spark, tmp_path):
    base, path, progress = str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "p")

    def arrive(day, *rows):
        land_snapshot(daily(spark, list(rows)), base, "opendosm", datetime(2026, 9, day))
        dumps = stream_dumps(spark, base + "/opendosm/*.json", "opendosm")
        append_stream(dumps, path, "opendosm", progress, "2 days").awaitTermination()
        stored = sorted((r.day, r.reading_value) for r in appended_readings(spark, path).collect())
        return stored, sorted(r.day for r in open_readings(spark, progress).collect())

    assert arrive(1, ("2026-05-01", "co", 1.0), ("2026-05-01", "co", 3.0), ("2026-05-02", "co", 5.0)) == ([], [1, 2])
    assert arrive(2, ("2026-05-01", "co", 7.0), ("2026-05-04", "co", 1.0)) == ([(1, 7.0), (2, 5.0)], [4])
    # a copy that comes after its time is left out; it neither replaces nor repeats the reading
    assert arrive(3, ("2026-05-01", "co", 9.0), ("2026-05-05", "co", 1.0)) == ([(1, 7.0), (2, 5.0)], [4, 5])


def test_station_readings_are_appended_once(spark, tmp_path):
    docs = [
        {"location_id": "1", "results": [station(1, "KLCC", [sensor("co")], last=f"2026-05-{day:02d}T00:00:00Z")]}
        for day in (1, 1, 2, 28)
    ]
    for day, doc in enumerate(docs, 1):
        land_snapshot(documents(spark, [doc]), str(tmp_path / "b"), "openaq", datetime(2026, 9, day))
    dumps = stream_dumps(spark, str(tmp_path / "b" / "openaq" / "*.json"), "openaq", max_files=1)
    append_stream(dumps, str(tmp_path / "s"), "openaq", str(tmp_path / "p"), "3 days").awaitTermination()
    assert rows_of(appended_readings(spark, str(tmp_path / "s"))) == rows_of(clean_stations(documents(spark, docs[:3])))
