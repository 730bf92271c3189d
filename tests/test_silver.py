from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hazelake.operators.shapes import daily_rows, station_rows, station_rows_outer
from hazelake.plans.silver import clean, clean_all, clean_daily, clean_rows, clean_stations
from hazelake.schemas import SILVER, SILVER_COLUMNS
from samples import daily, documents, random_daily, rows_of, sensor, station


def types(schema):
    return [(field.name, field.dataType) for field in schema]


def test_daily_rows_are_cleaned_and_bad_ones_dropped(spark):
    silver = clean(daily(spark), "opendosm")
    assert types(silver.schema) == types(SILVER)
    rows = silver.orderBy("observed_at", "pollutant").collect()
    assert [(r.pollutant, r.reading_value, r.day) for r in rows] == [("NO2", 88.0, 3), ("O3", 31.25, 4), ("SO2", None, 4)]
    assert {(r.source, r.year, r.month, r.country, r.state, r.source_location_id) for r in rows} == {
        ("opendosm", 2025, 11, "Malaysia", None, None)
    }
    assert rows[0].observed_at.hour == 18 and all(r.unit for r in rows)
    assert [r.health_risk_category == "unknown" for r in rows] == [False, False, True]


def test_daily_shortcut_gives_what_the_shared_plan_gives(spark):
    frame = daily(spark, random_daily(3000))
    shared = clean_rows(daily_rows(frame), "date")
    assert types(shared.schema) == types(SILVER)
    assert rows_of(clean_daily(frame)) == rows_of(shared)


def test_text_and_typed_input_agree(spark):
    frame = daily(spark)
    text = frame.withColumn("concentration", F.col("concentration").cast("string"))
    assert rows_of(clean_daily(frame)) == rows_of(clean_daily(text))
    dated = frame.filter("date = '2025-11-04'").withColumn("date", F.to_date("date"))
    assert clean_daily(dated).first().day == 4


def test_unreadable_number_keeps_the_row(spark):
    frame = spark.createDataFrame(
        [("2026-05-27", "CO", "n/a")], "date string, pollutant string, concentration string"
    )
    assert clean_daily(frame).first().health_risk_category == "unknown"


def test_station_sensors_become_rows(spark):
    sensors = [sensor("so2", "PPB"), sensor("o3", "ppbv"), sensor("pm10", None), sensor("co", "ppm")]
    place = station(77, "Minden, Penang", sensors, locality="penang")
    docs = documents(spark, [{"location_id": "4021", "results": [place]}])
    rows = clean(docs, "openaq").orderBy("pollutant").collect()
    assert [(row.pollutant, row.unit) for row in rows] == [("CO", "ppm"), ("O3", "ppb"), ("PM10", "ug/m3"), ("SO2", "ppb")]
    for row in rows:
        assert (row.source, row.source_location_id, row.state) == ("openaq", "4021", "Pulau Pinang")
        assert (row.latitude, row.longitude) == (5.4141, 100.3288)
        assert (row.reading_value, row.health_risk_category) == (None, "unknown")
        assert row.observed_date.isoformat() == "2026-05-27"


def test_stations_without_sensor_or_time_are_dropped(spark):
    ozone = [sensor("o3", "ppb"), None, sensor(None)]
    timeless = station(31, "Undated", ozone, first=None, last=None)
    unequipped = [station(32, "Bare", []), station(33, "Barer", None), station(34, "Unnamed", ozone[1:])]
    docs = [
        {"location_id": "60", "results": [timeless, *unequipped]},
        {"location_id": "61", "results": []},
        {"location_id": "62", "results": None},
        {"location_id": "63", "results": [*unequipped, station(35, "Ipoh", ozone), timeless]},
    ]
    rows = clean_stations(documents(spark, docs)).collect()
    assert [(row.source_location_id, row.location_name) for row in rows] == [("63", "Ipoh")]


def test_station_fallbacks(spark):
    pm25 = [sensor("pm25")]
    docs = [
        {"results": [station(7, "A", pm25)]},
        {"location_id": "1", "results": [station(8, "B", pm25, last=None)]},
        {"location_id": "2", "results": [station(9, "KLCC", pm25, locality="Atlantis")]},
        {"location_id": "3", "results": [station(9, "C", pm25, coordinates=None, country=None)]},
        {"location_id": "4", "results": [station(9, "D", pm25, coordinates={"latitude": "x"})]},
    ]
    rows = {row.location_name: row for row in clean_stations(documents(spark, docs)).collect()}
    assert rows["A"].source_location_id == "7"
    assert rows["B"].observed_date.isoformat() == "2026-05-01"
    assert rows["KLCC"].state == "Atlantis"
    assert (rows["C"].latitude, rows["C"].country) == (None, None)
    assert rows["D"].latitude is None


def test_typed_station_documents(spark):
    layout = """location_id bigint, results array<struct<
        id: bigint, name: bigint, locality: string, country: struct<name: string>,
        coordinates: struct<latitude: double, longitude: double>,
        datetimeFirst: struct<utc: string>, datetimeLast: struct<utc: timestamp>,
        sensors: array<struct<parameter: struct<name: string, units: string>>>>>"""
    result = (7, 42, "penang", ("Malaysia",), (3.1, 101.7), (None,), None, [(("pm25", None),)])
    timed = (*result[:6], (datetime(2026, 5, 27, 12),), result[7])
    docs = spark.createDataFrame([(123, [timed]), (None, [timed]), (5, [result])], layout)
    silver = clean_stations(docs)
    assert types(silver.schema) == types(SILVER)
    rows = silver.orderBy("source_location_id").collect()
    assert [(r.source_location_id, r.location_name, r.latitude) for r in rows] == [
        ("123", "42", 3.1),
        ("7", "42", 3.1),
    ]
    assert rows_of(clean_rows(station_rows(docs), "timestamp")) == rows_of(silver)


def test_outer_layout_keeps_empty_documents_and_stations(spark):
    docs = documents(
        spark,
        [
            {"location_id": "1", "results": [station(5, "KLCC", [sensor("co"), sensor("no")])]},
            {"location_id": "2", "results": [station(6, "Bare", [])]},
            {"location_id": "3", "results": []},
        ],
    )
    outer = station_rows_outer(docs)
    assert outer.columns == station_rows(docs).columns
    assert sorted((r.source_location_id, r.pollutant or "") for r in outer.collect()) == [
        ("1", "co"),
        ("1", "no"),
        ("2", ""),
        ("3", ""),
    ]
    assert rows_of(station_rows(docs)) == rows_of(outer.filter("pollutant is not null"))
    assert rows_of(clean_stations(docs)) == rows_of(clean_rows(outer, "timestamp"))


def test_both_sources_side_by_side(spark):
    docs = documents(spark, [{"location_id": "1", "results": [station(1, "KLCC", [sensor("co")])]}])
    both = clean_all(daily(spark), docs)
    assert both.columns == SILVER_COLUMNS
    assert sorted(row.source for row in both.collect()) == ["openaq"] + ["opendosm"] * 3


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="Unsupported air-quality source: unknown"):
        clean(daily(spark), "unknown")


def test_daily_plan_is_one_hash_aggregate_over_a_pruned_scan(spark, plan_of, tmp_path):
    daily(spark).withColumn("noise", F.lit(1)).write.parquet(str(tmp_path / "daily"))
    plan = plan_of(clean_daily(spark.read.parquet(str(tmp_path / "daily"))))
    assert plan.count("Exchange hashpartitioning(pollutant") == plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert "PushedFilters: [IsNotNull(pollutant), IsNotNull(date)]" in plan
    assert "ReadSchema: struct<date:string,pollutant:string,concentration:double>" in plan


def test_station_plan_prunes_nested_fields_and_shuffles_once(spark, plan_of, tmp_path):
    docs = documents(spark, [{"location_id": "1", "results": [station(1, "KLCC", [sensor("co")])]}])
    docs.withColumn("noise", F.lit(1)).write.parquet(str(tmp_path / "stations"))
    plan = plan_of(clean_stations(spark.read.parquet(str(tmp_path / "stations"))))
    assert plan.count("Exchange") == 1 and "partial_max" in plan
    assert "noise" not in plan
    for unwanted in ("Python", "Cartesian", "NestedLoop", "Window"):
        assert unwanted not in plan
