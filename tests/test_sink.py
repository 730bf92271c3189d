import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hazelake.plans.silver import clean_daily, clean_stations
from hazelake.schemas import PARTITION_COLUMNS, SILVER
from hazelake.sources import silver as silver_sink
from hazelake.sources.paths import child, shared_folder
from hazelake.sources.silver import compact_silver, merge_silver, read_silver, write_partitioned, write_silver
from samples import daily, documents, random_daily, rows_of, sensor, station


def files_below(path, ending=".parquet"):
    return [
        os.path.relpath(os.path.join(folder, name), path)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(ending)
    ]


def stations(spark, day="2026-05-27"):
    result = station(1, "KLCC", [sensor("co"), sensor("no")], last=f"{day}T12:00:00Z")
    return clean_stations(documents(spark, [{"location_id": "1", "results": [result]}]))


def test_layout_and_required_columns(spark, tmp_path):
    frame = spark.createDataFrame(
        [("openaq", 2024, 12, 9, "O3")],
        "source string, year int, month int, day int, pollutant string",
    )
    path = tmp_path / "air_quality"
    assert write_silver(frame, path) == 1
    assert (path / "year=2024" / "month=12" / "day=9" / "source=openaq").is_dir()
    narrow = frame.withColumnRenamed("pollutant", "other")
    assert write_silver(narrow, tmp_path / "narrow") == 1
    with pytest.raises(ValueError, match="Missing required silver partition columns: .'source'."):
        write_silver(frame.drop("source"), path)


def test_roundtrip_keeps_contract_order_and_types(spark, tmp_path):
    silver = clean_daily(daily(spark, random_daily(500))).unionByName(stations(spark))
    path = str(tmp_path / "s")
    assert write_silver(silver, path) == silver.count()
    back = read_silver(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in SILVER]
    assert rows_of(back) == rows_of(silver)


def test_other_source_survives_in_a_plain_session(spark, tmp_path):
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    path = str(tmp_path / "s")
    write_silver(clean_daily(daily(spark)), path)
    write_silver(stations(spark), path)
    assert read_silver(spark, path).groupBy("source").count().count() == 2
    write_silver(clean_daily(daily(spark, [("2025-11-04", "co", 9.0)])), path)
    rows = read_silver(spark, path).filter("source = 'opendosm'")
    # The 4th is replaced, the other day stays.
    assert sorted((r.day, r.pollutant) for r in rows.collect()) == [(3, "NO2"), (4, "CO")]


def test_writing_twice_is_writing_once_and_appending_is_not(spark, tmp_path):
    silver, path = clean_daily(daily(spark)), str(tmp_path / "s")
    for _ in range(2):
        write_silver(silver, path)
    assert read_silver(spark, path).count() == 3
    write_silver(silver, path, mode="append")
    assert read_silver(spark, path).count() == 6


def test_empty_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "s")
    write_silver(clean_daily(daily(spark)), path)
    assert write_silver(clean_daily(daily(spark)).filter("false"), path) == 0
    assert write_silver(read_silver(spark, path).limit(0), path) == 0
    assert read_silver(spark, path).count() == 3


def test_a_day_is_one_file_unless_it_outgrows_the_advisory_size(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).select(
        F.lit("opendosm").alias("source"),
        F.lit(2026).alias("year"),
        F.lit(5).alias("month"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 20 + 2).alias("day"),
        F.uuid(F.lit(1)).alias("pollutant"),
    )
    path = tmp_path / "s"
    assert write_silver(rows, path) == 40_000
    assert len(files_below(path)) == 21
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    try:
        split = tmp_path / "split"
        assert write_silver(rows, split) == 40_000
        hot = [name for name in files_below(split) if "day=1/" in name]
        assert len(hot) > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")


def test_day_range_is_a_partition_filter(spark, tmp_path, plan_of):
    path = str(tmp_path / "s")
    write_silver(clean_daily(daily(spark)), path)
    some = read_silver(spark, path, since=date(2025, 11, 2), until=date(2025, 11, 3))
    assert [row.day for row in some.collect()] == [3]
    assert "make_date" in plan_of(some).split("PartitionFilters")[1].split("PushedFilters")[0]


@pytest.mark.parametrize("most", [0, 100_000])
def test_merge_equals_cleaning_everything_at_once(spark, tmp_path, monkeypatch, most):
    # Both ways of finding the touched partitions: by shuffle and by broadcast.
    monkeypatch.setattr(silver_sink, "_MOST_BROADCAST_PARTITIONS", most)
    rows = random_daily(600)
    first, second = rows[:250], rows[250:]
    whole = rows_of(clean_daily(daily(spark, rows)))
    for name, order in {"ab": (first, second, first), "ba": (second, first)}.items():
        path = str(tmp_path / name)
        for part in order:
            merge_silver(clean_daily(daily(spark, part)), path)
        assert rows_of(read_silver(spark, path)) == whole


def test_merge_leaves_other_partitions_and_the_shared_folder_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    write_silver(clean_daily(daily(spark)), path)
    write_silver(stations(spark), path)
    before = {name for name in files_below(path) if "day=3/" not in name or "openaq" in name}
    assert merge_silver(clean_daily(daily(spark, [("2025-11-03", "co", 9.0)])), path) == 2
    assert before <= set(files_below(path))
    assert merge_silver(clean_daily(daily(spark, [])), path) == 0
    assert staged_rows(spark, tmp_path) == 0


def staged_rows(spark, tmp_path):
    """Rows that lie in the folder beside the dataset."""
    folders = [str(tmp_path / "s__merge" / name) for name in ("fresh", "merged", "mark")]
    return sum(spark.read.text(folder).count() for folder in folders if os.path.exists(folder))


def fail_once(monkeypatch, name, at=0, before=lambda: None):
    """The call number ``at`` of a function of the sink fails, after ``before`` did some damage."""
    real, calls = getattr(silver_sink, name), []

    def fail(*args):
        calls.append(args)
        if len(calls) - 1 == at:
            before()
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(silver_sink, name, fail)


def test_merge_that_fails_midway_is_mended_by_the_next(spark, tmp_path, monkeypatch):
    rows, path = random_daily(300), str(tmp_path / "s")
    merge_silver(clean_daily(daily(spark, rows[:150])), path)
    with monkeypatch.context() as patched:
        # as if a folder was gone and its new one not yet there
        fail_once(patched, "_replace", before=lambda: shutil.rmtree(next((tmp_path / "s").glob("year=*"))))
        with pytest.raises(OSError, match="lost"):
            merge_silver(clean_daily(daily(spark, rows[100:])), path)
    merge_silver(clean_daily(daily(spark, rows[100:])), path)
    assert rows_of(read_silver(spark, path)) == rows_of(clean_daily(daily(spark, rows)))
    assert staged_rows(spark, tmp_path) == 0


@pytest.mark.parametrize("at", [0, 1, 2])
@pytest.mark.parametrize("cleared", ["nothing", "everything"])
def test_no_row_is_lost_wherever_clearing_stops(spark, tmp_path, monkeypatch, at, cleared):
    """The mark, the merged and the fresh rows are cleared in turn; the next merge of another day finds whole rows."""
    rows, path = random_daily(200), str(tmp_path / "s")
    folder = tmp_path / "s__merge" / ("mark", "merged", "fresh")[at]
    merge_silver(clean_daily(daily(spark, rows[:120])), path)

    def damage():
        for file in sorted(folder.glob("part-*"))[: None if cleared == "everything" else 0]:
            file.unlink()

    with monkeypatch.context() as patched:
        fail_once(patched, "clear_folder", at, damage)
        with pytest.raises(OSError, match="lost"):
            merge_silver(clean_daily(daily(spark, rows[80:])), path)
    other = [("2031-01-01", "co", 1.0)]
    merge_silver(clean_daily(daily(spark, other)), path)
    assert rows_of(read_silver(spark, path)) == rows_of(clean_daily(daily(spark, rows + other)))


def test_a_write_after_a_failed_merge_is_not_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    write_silver(clean_daily(daily(spark, [("2026-05-01", "co", 1.0)])), path)
    with monkeypatch.context() as patched:
        fail_once(patched, "_replace")
        with pytest.raises(OSError, match="lost"):
            merge_silver(clean_daily(daily(spark, [("2026-05-01", "co", 2.0), ("2026-05-03", "co", 3.0)])), path)
    write_silver(clean_daily(daily(spark, [("2026-05-01", "co", 9.0), ("2026-05-01", "o3", 8.0)])), path)
    merge_silver(clean_daily(daily(spark, [("2026-05-02", "co", 5.0)])), path)
    found = sorted((r.day, r.pollutant, r.reading_value) for r in read_silver(spark, path).collect())
    assert found == [(1, "CO", 9.0), (1, "O3", 8.0), (2, "CO", 5.0), (3, "CO", 3.0)]


def test_a_merge_whose_staged_rows_are_gone_replaces_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    write_silver(clean_daily(daily(spark, [("2026-05-01", "co", 1.0)])), path)
    with monkeypatch.context() as patched:
        fail_once(patched, "_replace")
        with pytest.raises(OSError, match="lost"):
            merge_silver(clean_daily(daily(spark, [("2026-05-01", "no", 2.0)])), path)
    for file in (tmp_path / "s__merge" / "merged").glob("part-*"):
        file.unlink()
    for write in (merge_silver, write_silver, lambda df, path: compact_silver(spark, path)):
        with pytest.raises(RuntimeError, match="should hold 2 rows but holds 0"):
            write(clean_daily(daily(spark)), path)
    assert read_silver(spark, path).count() == 1


def test_many_merges_and_appends_are_packed_into_few_files(spark, tmp_path):
    path, rows = str(tmp_path / "s"), random_daily(400)
    for i in range(0, 400, 50):
        merge_silver(clean_daily(daily(spark, rows[i : i + 50])), path)
    names = [f"extra {i}" for i in range(42)]
    for name in names:
        write_silver(clean_daily(daily(spark, [("2026-05-27", name, 1.0), ("2026-05-28", name, 2.0)])), path, mode="append")
    whole, files = rows_of(read_silver(spark, path)), files_below(tmp_path / "s")
    assert len(files) > 80
    assert compact_silver(spark, path) > 80
    assert rows_of(read_silver(spark, path)) == whole
    packed = files_below(tmp_path / "s")
    assert len(packed) == 2 and staged_rows(spark, tmp_path) == 0
    assert compact_silver(spark, path) == 0
    assert files_below(tmp_path / "s") == packed


def test_a_compaction_fills_bins_and_leaves_good_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    write_silver(clean_daily(daily(spark, [("2026-06-01", "co", 1.0)])), path)
    for i in range(6):
        rows = [("2026-05-27", f"gas {i} {j}", float(j)) for j in range(30)]
        write_silver(clean_daily(daily(spark, rows)), path, mode="append")
    whole, good = rows_of(read_silver(spark, path)), [f for f in files_below(tmp_path / "s") if "month=6" in f]
    size = max(os.path.getsize(tmp_path / "s" / f) for f in files_below(tmp_path / "s") if "month=5" in f)
    assert compact_silver(spark, path, file_bytes=2 * size) == 180
    found = files_below(tmp_path / "s")
    assert [f for f in found if "month=6" in f] == good
    assert 1 <= len([f for f in found if "month=5" in f]) <= 3
    assert rows_of(read_silver(spark, path)) == whole


def test_merge_lists_only_the_days_it_touches(spark, tmp_path, plan_of):
    path = str(tmp_path / "s")
    days = ["2014-01-05", "2016-03-01", "2018-07-09", "2024-01-05"]
    write_silver(clean_daily(daily(spark, [(day, "co", 1.0) for day in days])), path)
    touched = clean_daily(daily(spark, [(days[0], "no2", 1.0), (days[3], "no2", 2.0)]))
    old = silver_sink._touched_only(read_silver(spark, path), touched.select(*PARTITION_COLUMNS).distinct(), 2)
    filters = plan_of(old).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "* 10000)" in filters and "IN (" in filters
    assert sorted(r.year for r in old.collect()) == [2014, 2024]
    assert merge_silver(touched, path) == 4


def test_generic_partitioned_write(spark, tmp_path):
    frame = spark.createDataFrame([("Johor", 1.0), ("Kedah", 2.0)], "state string, value double")
    write_partitioned(frame, tmp_path / "p", ["state"])
    assert (tmp_path / "p" / "state=Johor").is_dir()
    write_partitioned(frame, tmp_path / "j", format="json")
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    write_partitioned(frame.limit(1), tmp_path / "j", format="json", mode="append")
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    with pytest.raises(Exception, match="exist"):
        write_partitioned(frame, tmp_path / "j", mode="error")


def test_paths_keep_their_scheme():
    assert child("s3://bucket/base/", "a", "b") == "s3://bucket/base/a/b"


def test_shared_folder_is_the_one_the_session_names(spark, monkeypatch):
    class Conf:
        def get(self, name, default):
            return {"spark.checkpoint.dir": "hdfs://cluster/shared/"}.get(name, default)

    class Session:
        conf = Conf()

    assert shared_folder(Session(), "x").startswith("hdfs://cluster/shared/hazelake/x-")

    class Bare:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare(), "x")
