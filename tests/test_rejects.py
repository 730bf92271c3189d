"""Rejects beside rows, and responses landed as dumps."""

import json
import os

import pytest

from hazelake import ingest, ingest_latest, run
from hazelake.operators.rejects import judged, judged_stations, part
from hazelake.plans.silver import clean, clean_accepted
from hazelake.sources.bronze import read_bronze
from hazelake.sources.landing import document_bodies, judged_documents, judged_pages, read_station_documents
from hazelake.sources.paths import child
from hazelake.sources.silver import read_silver

from hazelake.streaming.landing import dump_name, land, rejected_responses
from hazelake.streaming.progress import BatchLog
from hazelake.streaming.snapshots import ingest_stream
from samples import documents, random_daily, rows_of, sensor, station


def lines(path, rows):
    path.mkdir(parents=True)
    (path / "part-0.json").write_text("\n".join(row if isinstance(row, str) else json.dumps(row) for row in rows))
    return str(path)


def daily_dump(path):
    rows = [dict(zip(("date", "pollutant", "concentration"), row, strict=True)) for row in random_daily(200)]
    return lines(path, [*rows, '{"date": "2026', "no json at all"])


def test_rows_in_are_rows_out_and_rejects(spark, tmp_path):
    dump = daily_dump(tmp_path / "dump.json")
    report = ingest(spark, dump, str(tmp_path / "silver"), "opendosm", rejects=str(tmp_path / "rejects"))
    assert report.accepted + sum(report.rejected.values()) == 202
    assert report.rejected["malformed record"] == 2
    rejects = spark.read.parquet(str(tmp_path / "rejects" / "opendosm" / "dump.json"))
    assert rejects.where("taken = 'true'").count() == 0
    assert {r.reason: r["count"] for r in rejects.groupBy("reason").count().collect()} == report.rejected
    assert sorted(r.raw for r in rejects.where("raw is not null").collect()) == ["no json at all", '{"date": "2026']
    assert rows_of(report.readings(spark)) == rows_of(clean(read_bronze(spark, dump, "opendosm"), "opendosm"))
    count = rejects.count()
    again = ingest(spark, dump, str(tmp_path / "silver"), "opendosm", rejects=str(tmp_path / "rejects"))
    assert again == report
    assert spark.read.parquet(str(tmp_path / "rejects" / "opendosm" / "dump.json" / "taken=false")).count() == count


def test_each_reason_of_a_station_row(spark, tmp_path):
    docs = [
        {"location_id": "1", "results": [station(1, "KLCC", [sensor("co"), sensor(None), None])]},
        {"location_id": "2", "results": [station(2, "x", []), station(3, "y", None), station(4, "z", [sensor("co")], None, None)]},
        {"location_id": "3", "results": []},
        {"location_id": "4", "results": None},
        {"location_id": "5", "results": [None, station(6, "w", [sensor("no")], "soon", None)]},
    ]
    parted = part(judged_stations(documents(spark, docs)), str(tmp_path / "p"))
    assert parted.taken == 1 and sum(parted.rejected_by_reason.values()) == 9
    assert parted.rejected_by_reason == {
        "no results": 3, "no sensors": 2, "missing pollutant": 2, "missing date": 1, "unreadable date": 1
    }
    rows = clean_accepted(parted.accepted, "openaq")
    assert rows_of(rows) == rows_of(clean(documents(spark, docs), "openaq"))


def test_one_pass_parts_the_input(spark, tmp_path, plan_of):
    dump = daily_dump(tmp_path / "dump.json")
    raw = judged(read_bronze(spark, dump, "opendosm", keep_corrupt=True), "opendosm")
    assert plan_of(raw).count("FileScan") == 1
    parted = part(raw, str(tmp_path / "p"))
    assert "FileScan json" not in plan_of(parted.accepted) + plan_of(parted.rejected)
    empty = part(raw.limit(0), str(tmp_path / "e"))
    assert (empty.taken, empty.rejected_by_reason, empty.accepted.count(), empty.rejected.count()) == (0, {}, 0, 0)


def record(n):
    return {"date": f"2026-01-{n % 28 + 1:02d}", "pollutant": "co", "concentration": n}


def page(base, run_name, offset, body):
    folder = base / f"run={run_name}" / f"offset={offset}"
    folder.mkdir(parents=True)
    (folder / "page.json").write_text(body if isinstance(body, str) else json.dumps(body, indent=2))


def test_a_page_is_parsed_once(spark, plan_of):
    pages = spark.createDataFrame([("a", 0, "{}")], "run string, offset long, body string")
    assert plan_of(judged_pages(pages)).count("from_json") == 1


def test_pages_land_once_whatever_is_repeated(spark, tmp_path):
    source, base, progress = tmp_path / "pages", str(tmp_path / "bronze"), tmp_path / "progress"
    page(source, "a", 0, {"data": [record(1), record(2)]})
    page(source, "a", 2, [record(3)])
    page(source, "a", 4, [record(4), record(5)])
    page(source, "b", 0, '{"data": [{"date": "20')
    page(source, "b", 2, json.dumps([record(6)]) + " x")
    page(source, "c", 0, [record(7), record(8)])

    def landed():
        land(spark, str(source), base, "opendosm", str(progress), limit=2).awaitTermination()
        values = [int(r.concentration) for r in spark.read.json(child(base, "opendosm", "*.json")).collect()]
        return sorted(values)

    assert landed() == [1, 2, 3, 7, 8]
    page(source, "a", 6, [record(9)])
    page(source, "c", 2, [record(10)])
    assert landed() == [1, 2, 3, 7, 8, 10] == landed()
    # The last batch was written but not acknowledged.
    os.remove(progress / "commits" / "1")
    (progress / "commits" / ".1.crc").unlink(missing_ok=True)
    assert landed() == [1, 2, 3, 7, 8, 10]
    assert sorted(os.listdir(tmp_path / "bronze" / "opendosm")) == [dump_name("opendosm", i) for i in (0, 1)]
    rejects = rejected_responses(spark, base, "opendosm")
    assert sorted((r.run, r.offset, r.reason, r.raw is not None) for r in rejects.collect()) == [
        ("a", 4, "after the end of the run", False),
        ("a", 6, "after the end of the run", False),
        ("b", 0, "unreadable response", True),
        ("b", 2, "unreadable response", True),
    ]


def test_documents_land_with_their_keys(spark, tmp_path):
    source, base = tmp_path / "docs", str(tmp_path / "bronze")
    source.mkdir()
    doc = {"results": [station(5, "KLCC", [sensor("co")])], "location_id": 999}
    (source / "location_77.json").write_text(json.dumps(doc, indent=2))
    (source / "location_78.json").write_text(json.dumps(doc) + json.dumps(doc))
    (source / "location_79.json").write_text(json.dumps(doc)[:-30])
    (source / "many.json").write_text(json.dumps([doc, doc | {"location_id": 1000}, {}]))
    (source / "location_80.json").write_text("{}")
    land(spark, str(source), base, "openaq", str(tmp_path / "progress")).awaitTermination()
    report = ingest_latest(spark, "openaq", base, str(tmp_path / "silver"))
    assert sorted(r.source_location_id for r in report.readings(spark).collect()) == ["1000", "77", "999"]
    rejects = rejected_responses(spark, base, "openaq").collect()
    assert sorted((r.location_id, r.reason, r.raw[:11]) for r in rejects) == [
        ("78", "unreadable response", '{"results":'), ("79", "unreadable response", '{"results":')
    ]
    with pytest.raises(ValueError, match="Unsupported"):
        land(spark, str(source), base, "other", str(tmp_path / "p"))


def test_bundled_responses_land_like_files(spark, tmp_path):
    doc = {"results": [station(5, "KLCC", [sensor("co")])], "location_id": 999}
    pages = [("a", 0, json.dumps([record(1), record(2)])), ("a", 2, '{"data": [{"date'), ("a", 4, json.dumps(record(3))), ("a", 6, json.dumps(record(4)))]
    docs = [("x/location_77.json", json.dumps(doc)), ("x/location_78.json", json.dumps(doc)[:-30]), ("part-1.txt", json.dumps([doc]))]
    for name, rows, layout in (("opendosm", pages, "run string, offset long, body string"), ("openaq", docs, "path string, body string")):
        source = str(tmp_path / name)
        spark.createDataFrame(rows, layout).coalesce(1).write.parquet(source)
        land(spark, source, str(tmp_path / "b"), name, str(tmp_path / "p" / name), limit=2, bundled=True).awaitTermination()
    base = str(tmp_path / "b")
    assert sorted(int(r.concentration) for r in spark.read.json(child(base, "opendosm", "*.json")).collect()) == [1, 2, 3]
    found = spark.read.json(child(base, "openaq", "*.json")).collect()
    assert sorted(r.location_id for r in found) == ["77", "999"]
    assert sorted((r.offset, r.reason) for r in rejected_responses(spark, base, "opendosm").collect()) == [
        (2, "unreadable response"), (6, "after the end of the run")
    ]
    assert [(r.location_id, r.path) for r in rejected_responses(spark, base, "openaq").collect()] == [("78", "x/location_78.json")]


def test_no_station_document_is_lost(spark, tmp_path):
    doc = json.dumps({"results": [station(5, "KLCC", [sensor("co")])]})
    for text in (doc[:-20], doc + "\n" + doc, doc + " end"):
        (tmp_path / "location_7.json").write_text(text)
        with pytest.raises(Exception, match="Unreadable document"):
            read_station_documents(spark, str(tmp_path)).collect()
        found = judged_documents(document_bodies(spark.read, str(tmp_path))).collect()
        assert [(r.reason, r.raw) for r in found] == [("unreadable response", text)]


def test_full_run_lands_first(spark, tmp_path):
    source, base, silver = tmp_path / "landing" / "opendosm", str(tmp_path / "bronze"), str(tmp_path / "silver")
    page(source, "a", 0, [record(n) for n in range(5)])
    args = {"source": "opendosm", "landing": str(tmp_path / "landing"), "rejects": str(tmp_path / "rejects")}
    assert run(spark, base, silver, skip_ingest=True, **args) == []
    (report,) = run(spark, base, silver, skip_extract=True, **args)
    assert (report.rows, report.rejected, report.accepted) == (5, {}, 5)
    page(source, "b", 0, [record(9), {"date": "never", "pollutant": "co"}])
    (report,) = run(spark, base, silver, **args)
    assert (report.rows, report.rejected) == (1, {"unreadable date": 1})


def test_a_dump_of_another_layout_stops_the_stream(spark, tmp_path):
    folder = tmp_path / "b" / "opendosm"
    folder.mkdir(parents=True)
    (folder / "dump.json").write_text(json.dumps([record(n) for n in range(6)], indent=2))
    places = (str(folder), str(tmp_path / "s"), "opendosm")
    for _ in range(2):
        with pytest.raises(Exception, match="Not JSON of the layout"):
            ingest_stream(spark, *places, str(tmp_path / "p")).awaitTermination()
    assert not os.path.exists(tmp_path / "p" / "commits" / "0")
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        query = ingest_stream(spark, *places, str(tmp_path / "q"), rejects=str(tmp_path / "r"), log=log)
        query.awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    found = spark.read.parquet(str(tmp_path / "r" / "opendosm" / "batch=0" / "taken=false"))
    assert {r.reason for r in found.collect()} == {"malformed record"}
    assert log.batches[0][1:] == (found.count(), found.count(), 0)


def test_every_batch_tells_what_it_read_rejected_and_wrote(spark, tmp_path):
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        for batch, bad in enumerate((1, 2)):
            rows = [record(batch), record(batch), *[{"date": "never", "pollutant": "co"}] * bad]
            lines(tmp_path / "b" / f"dump{batch}.json", rows)
            places = (str(tmp_path / "b" / "*.json"), str(tmp_path / "s"), "opendosm", str(tmp_path / "p"))
            ingest_stream(spark, *places, log=log).awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    assert [tuple(log.batches[i]) for i in (0, 1)] == [(0, 3, 1, 1), (1, 4, 2, 1)]
    assert read_silver(spark, str(tmp_path / "s" / "air_quality")).count() == 2
