import json

import pytest

from hazelake.dictionaries import PAGE_LIMIT
from hazelake.sources.landing import (
    complete_pages,
    flatten_pages,
    parse_pages,
    readable_pages,
    read_pages,
    read_station_documents,
    rejected_pages,
    tag_request_key,
)
from pyspark.sql import functions as F
from samples import sensor, station


def record(n):
    return {"date": str(n), "pollutant": "co", "concentration": n}


def bodies(spark, rows):
    return spark.createDataFrame(rows, "run string, offset long, body string")


def test_each_shape_of_a_response(spark):
    rows = [
        ("a", 0, json.dumps({"data": [record(1), record(2)], "total": 9})),
        ("a", 2, json.dumps([record(3)])),
        ("a", 3, json.dumps(record(4))),
        ("a", 4, "{}"),
        ("a", 5, json.dumps({"data": []})),
        ("a", 6, json.dumps({"data": None})),
        ("a", 7, "[]"),
    ]
    flat = flatten_pages(parse_pages(bodies(spark, rows)))
    assert flat.columns == ["date", "pollutant", "concentration"]
    assert sorted(row.concentration for row in flat.collect()) == ["1", "2", "3", "4"]


def test_a_truncated_page_is_no_end_of_a_run(spark):
    whole = json.dumps([record(1), record(2)])
    rows = [("a", 0, whole), ("a", 2, whole[:-9]), ("a", 4, whole), ("b", 0, whole), ("b", 2, ""), ("c", 0, '{"data": [1'), ("d", 0, None)]
    pages = bodies(spark, rows)
    with pytest.raises(Exception, match="Unreadable page"):
        complete_pages(parse_pages(pages), limit=2).collect()
    assert sorted((r.run, r.offset) for r in rejected_pages(pages).collect()) == [("a", 2), ("c", 0)]
    kept = complete_pages(parse_pages(readable_pages(pages)), limit=2).collect()
    assert sorted((r.run, r.offset) for r in kept) == [("b", 0), ("b", 2), ("d", 0)]


def test_runs_end_at_their_first_short_page(spark):
    sizes = {
        "short": {0: 2, 2: 2, 4: 1, 6: 2},
        "empty": {0: 2, 2: 0, 4: 2},
        "nothing": {0: 0, 2: 2},
        "open": {0: 2, 2: 2},
    }
    rows = [
        (run, offset, json.dumps([record(offset)] * size))
        for run, pages in sizes.items()
        for offset, size in pages.items()
    ]
    pages = parse_pages(bodies(spark, rows))
    kept = complete_pages(pages, limit=2)
    assert kept.columns == pages.columns
    found = {}
    for row in kept.collect():
        found.setdefault(row.run, set()).add(row.offset)
    assert found == {"short": {0, 2, 4}, "empty": {0, 2}, "nothing": {0}, "open": {0, 2}}
    single = complete_pages(pages.filter("run = 'short'").drop("run"), (), limit=2)
    assert sorted(row.offset for row in single.collect()) == [0, 2, 4]
    open_run = complete_pages(pages.filter("run = 'open'"), (), limit=2)
    assert open_run.count() == 2
    assert complete_pages(pages, limit=PAGE_LIMIT).filter("offset > 0").count() == 0


def test_pages_of_a_run_without_name_stay_together(spark):
    rows = [(None, 0, "[]"), (None, 2, json.dumps([record(1)] * 2)), ("a", 0, json.dumps([record(1)] * 2))]
    kept = complete_pages(parse_pages(bodies(spark, rows)), limit=2)
    assert sorted((row.run or "", row.offset) for row in kept.collect()) == [("", 0), ("a", 0)]


def test_page_ends_need_no_cross_join(spark, plan_of):
    pages = parse_pages(bodies(spark, [("a", 0, "[]")]))
    plan = plan_of(complete_pages(pages))
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Window" not in plan


def test_landed_pages_are_read_with_run_and_offset(spark, tmp_path):
    for offset, size in ((0, 2), (2, 1)):
        folder = tmp_path / "run=20260527_010203" / f"offset={offset}"
        folder.mkdir(parents=True)
        text = json.dumps({"data": [record(offset + i) for i in range(size)]}, indent=2)
        (folder / "page.json").write_text(text)
    pages = read_pages(spark, str(tmp_path))
    assert {(row.run, row.offset) for row in pages.collect()} == {
        ("20260527_010203", 0),
        ("20260527_010203", 2),
    }
    flat = flatten_pages(complete_pages(parse_pages(pages), limit=2))
    assert sorted(row.date for row in flat.collect()) == ["0", "1", "2"]


def test_documents_are_tagged_by_their_file(spark, tmp_path):
    doc = {"results": [station(5, "KLCC", [sensor("co")])], "location_id": 999}
    (tmp_path / "location_77.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "location_78.json").write_text("{}")
    docs = read_station_documents(spark, str(tmp_path)).collect()
    assert [(row.location_id, row.results[0].name) for row in docs] == [("77", "KLCC")]


def test_tagging_keeps_other_columns(spark):
    docs = spark.createDataFrame([(5, "x"), (6, None)], "n int, body string")
    tagged = tag_request_key(docs.select("n", "body"), F.col("n") * 10)
    assert [tuple(row) for row in tagged.collect()] == [("50", 5, "x"), ("60", 6, None)]
