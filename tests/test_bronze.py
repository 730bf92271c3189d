import json
import os
from datetime import datetime

import pytest

from hazelake.operators.rows import rejected_daily_rows
from hazelake.schemas import DAILY_BRONZE, STATION_BRONZE
from hazelake.sources.bronze import (
    DOCUMENT,
    INDENTED,
    LINES,
    land_snapshot,
    latest_snapshot,
    read_bronze,
    read_json,
    snapshot_at,
)
from samples import rows_of, sensor, station

RECORDS = [
    {"date": f"2026-05-{1 + i % 28:02d}", "pollutant": "pm 2.5 \n  }\n µ", "concentration": i / 4}
    for i in range(200)
]


def dump(path, value, **style):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value, ensure_ascii=False, **style), encoding="utf-8")
    return str(path)


def test_layouts_are_told_apart_and_read_alike(spark, tmp_path):
    indented = dump(tmp_path / "a.json", RECORDS, indent=2)
    styles = {
        INDENTED: indented,
        DOCUMENT: dump(tmp_path / "b.json", RECORDS),
        LINES: str(tmp_path / "c.json"),
    }
    (tmp_path / "c.json").write_text("\n".join(json.dumps(record) for record in RECORDS))
    expected = rows_of(read_json(spark, indented, DAILY_BRONZE))
    assert len(expected) == 200
    for layout, path in styles.items():
        assert snapshot_at(spark, path).layout == layout
        assert rows_of(read_bronze(spark, path, "opendosm")) == expected
    wide = dump(tmp_path / "d.json", RECORDS, indent=4)
    assert snapshot_at(spark, wide).layout == DOCUMENT
    assert rows_of(read_bronze(spark, wide, "opendosm")) == expected


def test_indented_dump_is_read_in_splits(spark, tmp_path):
    path = dump(tmp_path / "a.json", RECORDS * 20, indent=2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = read_json(spark, path, DAILY_BRONZE, INDENTED)
        assert frame.rdd.getNumPartitions() > 5
        assert rows_of(frame) == rows_of(read_json(spark, path, DAILY_BRONZE))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_indented_station_documents_nest(spark, tmp_path):
    docs = [
        {"location_id": 12, "meta": {}, "results": [station(5, "KLCC", [sensor("co"), sensor("no")])]},
        {},
        {"location_id": 13, "results": []},
        {"location_id": 14, "results": [station(6, "A", []), station(7, "B", [sensor("o3")])]},
    ]
    path = dump(tmp_path / "a.json", docs, indent=2)
    assert snapshot_at(spark, path).layout == INDENTED
    read = rows_of(read_json(spark, path, STATION_BRONZE, INDENTED))
    assert read == rows_of(read_json(spark, path, STATION_BRONZE)) and len(read) == 4


def test_odd_dumps(spark, tmp_path):
    empty = dump(tmp_path / "empty.json", [], indent=2)
    assert read_bronze(spark, empty, "opendosm").count() == 0
    windows = tmp_path / "windows.json"
    windows.write_bytes(json.dumps(RECORDS[:3], indent=2).replace("\n", "\r\n").encode())
    assert snapshot_at(spark, str(windows)).layout == DOCUMENT
    assert read_bronze(spark, str(windows), "opendosm").count() == 3
    single = dump(tmp_path / "single.json", RECORDS[0], indent=2)
    assert read_bronze(spark, single, "opendosm").count() == 1
    mistyped = dump(tmp_path / "mistyped.json", [{"date": 1, "concentration": "x"}, RECORDS[1]])
    assert [r.concentration for r in read_bronze(spark, mistyped, "opendosm").collect()] == ["x", "0.25"]
    with pytest.raises(FileNotFoundError):
        snapshot_at(spark, str(tmp_path / "missing.json"))
    with pytest.raises(ValueError):
        read_json(spark, empty, layout=INDENTED)


def test_schema_may_be_inferred(spark, tmp_path):
    frame = read_json(spark, dump(tmp_path / "a.json", RECORDS, indent=2))
    assert dict(frame.dtypes)["concentration"] == "double" and frame.count() == 200


def test_newest_dump_by_time_then_name(spark, tmp_path):
    folder = tmp_path / "opendosm"
    for name, seconds in {"b": 100, "a": 300, "c": 300, "d": 200}.items():
        path = dump(folder / f"{name}.json", RECORDS[:1], indent=2)
        os.utime(path, (seconds, seconds))
    (folder / "e.txt").write_text("newest, but no dump")
    found = latest_snapshot(spark, str(tmp_path), "opendosm")
    assert found.path.endswith("/opendosm/c.json")
    assert found.size == os.path.getsize(folder / "c.json")
    assert found.layout == INDENTED


def test_station_dumps_are_told_by_name(spark, tmp_path):
    old = dump(tmp_path / "openaq" / "openaq_measurements_1.json", [], indent=2)
    os.utime(old, (100, 100))
    dump(tmp_path / "openaq" / "openaq_locations_2.json", [], indent=2)
    assert latest_snapshot(spark, str(tmp_path), "openaq").path == old


def test_missing_dumps(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported air-quality source: other"):
        latest_snapshot(spark, str(tmp_path), "other")
    with pytest.raises(FileNotFoundError, match="No bronze files found for source 'openaq'"):
        latest_snapshot(spark, str(tmp_path), "openaq")
    (tmp_path / "opendosm").mkdir()
    with pytest.raises(FileNotFoundError):
        latest_snapshot(spark, str(tmp_path), "opendosm")


def test_landed_dump_is_the_newest_and_reads_back(spark, tmp_path):
    old = dump(tmp_path / "opendosm" / "old.json", RECORDS[:2], indent=2)
    os.utime(old, (100, 100))
    frame = read_bronze(spark, old, "opendosm").repartition(2)
    path = land_snapshot(frame, str(tmp_path), "opendosm", datetime(2026, 5, 27, 1, 2, 3))
    assert path.endswith("/opendosm/opendosm_air_pollution_20260527_010203.json")
    assert latest_snapshot(spark, str(tmp_path), "opendosm")[:2] == (path, LINES)
    assert snapshot_at(spark, path).layout == LINES
    assert rows_of(read_bronze(spark, path, "opendosm")) == rows_of(frame)
    with pytest.raises(Exception, match="exist"):
        land_snapshot(frame, str(tmp_path), "opendosm", datetime(2026, 5, 27, 1, 2, 3))


LINE = '{"date": "2026-01-0%d", "pollutant": "no2", "concentration": "%d"}'
TEN = [LINE % (i % 9 + 1, i) for i in range(10)]


def test_no_record_is_lost_unseen(spark, tmp_path):
    """Files whose first lines do not show what follows give all records, or an error."""

    def file(name, text):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
        return str(path)

    def count(path, **layout):
        return read_bronze(spark, path, "opendosm", **layout).filter("date is not null").count()

    for begins in ("{\"date\": \"2026-\n" + "\n".join(TEN), "{\"date\": \"2026-01-02\",\n" + TEN[0]):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            count(file("truncated_line.json", begins))
    assert count(file("long_object.json", "{\"date\": \"2026-01-02\",\n\"pollutant\": \"co\"}")) == 1
    assert count(file("blank_line.json", "\n  \n" + "\n".join(TEN))) == 10
    indented = json.dumps([json.loads(line) for line in TEN[:3]], indent=2)[:-2]
    mixed = file("mixed.json", indented + "".join(f",\n  {line}" for line in TEN[3:]) + "\n]")
    assert count(mixed, layout=DOCUMENT) == 10
    with pytest.raises(Exception, match="indented by two"):
        count(mixed)
    for broken in ("[" + ",".join(TEN)[:-5], "\n".join(TEN)):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            count(file("broken.json", broken), layout=DOCUMENT)
    assert count(file("one.json", "{\n" + TEN[0][1:])) == 1
    assert count(file("nothing.json", " \n")) == 0


def test_a_folder_holds_lines_however_it_is_reached(spark, tmp_path):
    folder = tmp_path / "opendosm" / "dump.json"
    folder.mkdir(parents=True)
    for name in ("first.txt", "second.txt"):
        (folder / name).write_text("\n".join(TEN))
    newest = latest_snapshot(spark, str(tmp_path), "opendosm")
    assert newest == snapshot_at(spark, str(folder)) and newest.layout == LINES
    assert read_bronze(spark, str(folder), "opendosm").count() == 20


def test_text_of_a_corrupt_line_is_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text(TEN[0] + "\n{broken\n" + TEN[1])
    rows = read_bronze(spark, str(tmp_path / "a.json"), "opendosm", keep_corrupt=True)
    rejected = rejected_daily_rows(rows).collect()
    assert [(row.reason, row.raw) for row in rejected] == [("malformed record", "{broken")]
