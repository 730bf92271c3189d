"""Dictionaries as tables, several dumps at once, open schemas, and summaries kept up to date."""

import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hazelake.functions.naming import canonical_pollutant, state_from_place
from hazelake.dictionaries import PLACE_STATES, POLLUTANT_ALIASES
from hazelake.operators import tables
from hazelake.operators.tables import AmbiguousAlias, checked_aliases, with_names, with_place_state
from hazelake.plans import refresh, summaries
from hazelake.plans.refresh import (
    RANK_ERROR,
    partial_sums,
    quantiles_of,
    read_summaries,
    refresh_summaries,
    risk_summary_of,
    state_monthly_of,
)
from hazelake.plans.silver import clean_daily, clean_stations
from hazelake.schemas import DAILY_BRONZE
from hazelake.sources.bronze import land_snapshot
from hazelake.sources.history import as_json, further_fields, newest_of_many, read_dumps, read_open
from hazelake.sources.silver import merge_silver, read_silver, write_silver
from samples import daily, documents, random_daily, rows_of, sensor, station


def aliases_of(spark, rows):
    return spark.createDataFrame(rows, "alias string, name string")


@pytest.mark.parametrize("most", [0, 1000])
def test_names_from_a_table(spark, plan_of, most):
    texts = [None, "", "PM 2.5", "pm-25", " Ozone ", "mystery", *["co"] * 400]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "id int, raw string, name string, key int")
    named = with_names(df, "raw", aliases_of(spark, list(POLLUTANT_ALIASES.items())), "found", most)
    assert named.columns == ["id", "raw", "name", "key", "found"]
    expected = df.select("id", F.coalesce(canonical_pollutant(F.col("raw")), F.lit("")).alias("n")).collect()
    known = {r.id: r.n if r.n in POLLUTANT_ALIASES.values() else None for r in expected}
    assert {r.id: r.found for r in named.collect()} == known
    plan = plan_of(named)
    assert ("BroadcastHashJoin" in plan) == (most > 0)
    assert ("_salt" in plan) == (most == 0)


def test_a_hot_alias_is_dealt_out(spark):
    df = spark.range(8000).select(F.lit("co").alias("raw"))
    named = with_names(df, "raw", aliases_of(spark, [("co", "CO"), ("no", "NO")]), "found", most_broadcast=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in named.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 8000 and max(sizes) < 6000


def test_an_alias_has_one_name(spark):
    good = [("PM-2.5", "PM2.5"), ("pm 2.5", "PM2.5"), (None, "x"), ("y", None), ("y", "Y")]
    assert sorted(map(tuple, checked_aliases(aliases_of(spark, good)).collect())) == [("pm 2.5", "PM2.5"), ("y", "Y")]
    with pytest.raises(AmbiguousAlias, match="'pm 2.5' means 'PM10' and 'PM2.5'"):
        with_names(daily(spark), "pollutant", aliases_of(spark, [*good, ("PM_2.5", "PM10")]), "name")


def test_places_by_a_table_of_hints(spark):
    hints = [(hint, state, rank) for rank, (hint, state) in enumerate(PLACE_STATES.items())]
    table = spark.createDataFrame(hints, "hint string, state string, rank int")
    places = ["Cyberjaya near KLCC", "klcc, cyberjaya", "TTDI", "x", "", None, "Taman  Tun\tDr Ismail", "aklccb", "日本klcc"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(places * 2)], "id int, place string")
    found = with_place_state(df, "place", table)
    expected = df.select("id", state_from_place(F.col("place")).alias("state"))
    assert rows_of(found.select("id", "state")) == rows_of(expected)
    kept = with_place_state(df.withColumn("state", F.when(F.col("id") == 0, "Perak")), "place", table)
    assert kept.where("id = 0").first().state == "Perak"
    assert with_place_state(df, "place", table.limit(0)).where("state is not null").count() == 0


def test_thousands_of_hints_are_one_join(spark, plan_of):
    many = spark.range(5000).select(
        F.concat(F.lit("place "), "id").alias("hint"), F.concat(F.lit("S"), F.col("id") % 7).alias("state"), F.col("id").cast("int").alias("rank")
    )
    df = spark.createDataFrame([("near Place 4999 and place 12",), ("place 3",)], "place string")
    found = with_place_state(df, "place", many)
    assert [r.state for r in found.orderBy("place").collect()] == [f"S{4999 % 7}", "S3"]
    assert "Contains" not in plan_of(found) and "NestedLoop" not in plan_of(found)


def test_newest_of_many_dumps_in_one_scan(spark, tmp_path, plan_of):
    base = str(tmp_path / "b")
    for day, value in ((3, 1.0), (1, 2.0), (2, None)):  # names do not follow the order of arrival
        rows = [("2026-05-01", "co", value), ("2026-05-01", "PM 2.5", 9.0), (f"2026-05-{day:02d}", "no", value), ("x", "co", 1.0)]
        land_snapshot(daily(spark, [*rows, ("2026-05-01", "co", None)]).coalesce(1), base, "opendosm", datetime(2026, 9, day))
        time.sleep(0.05)
    dumps = read_dumps(spark, base, "opendosm")
    newest = newest_of_many(dumps, "opendosm")
    plan = plan_of(newest)
    assert plan.count("FileScan json") == 1 and plan.count("Join") == 1 and "BroadcastHashJoin" in plan
    found = sorted((r.pollutant, r.day, r.reading_value) for r in newest.collect())
    assert found == [("CO", 1, None), ("NO", 1, 2.0), ("NO", 2, None), ("NO", 3, 1.0), ("PM2.5", 1, 9.0)]
    one = daily(spark, random_daily(150))
    land_snapshot(one, str(tmp_path / "one"), "opendosm", datetime(2026, 9, 1))
    same = newest_of_many(read_dumps(spark, str(tmp_path / "one"), "opendosm"), "opendosm")
    assert rows_of(same) == rows_of(clean_daily(one))


def test_newest_of_many_station_dumps(spark, tmp_path):
    base = str(tmp_path / "b")
    for day, name in ((1, "Old KLCC"), (2, "Old KLCC")):
        docs = [{"location_id": "1", "results": [station(1, name, [sensor("co", "ppm" if day == 1 else "ppb")], locality="perak")]}]
        land_snapshot(documents(spark, docs).coalesce(1), base, "openaq", datetime(2026, 9, day))
        time.sleep(0.05)
    newest = newest_of_many(read_dumps(spark, base, "openaq"), "openaq")
    assert rows_of(newest) == rows_of(clean_stations(documents(spark, docs)))


def test_fields_beyond_the_contract_are_kept_and_listed(spark, tmp_path):
    rows = [
        {"date": "2026-05-01", "pollutant": "co", "concentration": 1.50},
        {"date": "2026-05-01", "concentration": "x", "site": {"id": 1, "tags": ["a"]}, "flag": True},
        {"date": None, "flag": None, "site": {"id": 2.5}, "a.b": "dot"},
        {},
    ]
    (tmp_path / "d.json").write_text("\n".join(map(json.dumps, rows)))
    found = read_open(spark, str(tmp_path), DAILY_BRONZE)
    texts = found.select("date", "pollutant", "concentration", as_json(F.col("further")).alias("further")).collect()
    assert sorted(map(repr, map(tuple, texts))) == sorted(map(repr, [
        ("2026-05-01", "co", "1.5", ""),
        ("2026-05-01", None, "x", 'flag=true,site={"id":1,"tags":["a"]}'),
        (None, None, None, 'a.b="dot",flag=null,site={"id":2.5}'),
        (None, None, None, ""),
    ]))
    listed = {r.field: (r.type, r.records) for r in further_fields(found).collect()}
    assert listed["flag"] == ("BOOLEAN", 2) and listed["a.b"] == ("STRING", 1)
    assert listed["site"][1] == 2 and "id" in listed["site"][0] and "ARRAY<STRING>" in listed["site"][0]
    assert further_fields(read_open(spark, str(tmp_path), DAILY_BRONZE).limit(0)).count() == 0


def parquet_below(path):
    return {os.path.join(folder, name) for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def monthly(df):
    rounded = df.select("state", "year", "month", "pollutant", "unit", F.round("mean_value", 6).alias("mean_value"), "min_value", "max_value", "readings")
    return rows_of(rounded)


def test_only_touched_days_are_summed_up_again(spark, tmp_path):
    silver, sums = str(tmp_path / "s"), str(tmp_path / "sums")
    rows = [(f"2026-05-{day:02d}", "co", float(day)) for day in range(1, 9)]
    write_silver(clean_daily(daily(spark, rows)), silver)
    assert refresh_summaries(spark, silver, sums) == [20260500 + day for day in range(1, 9)]
    assert refresh_summaries(spark, silver, sums) == []
    files = parquet_below(sums)
    time.sleep(0.05)
    merge_silver(clean_daily(daily(spark, [("2026-05-03", "co", 30.0), ("2026-05-03", "no", 1.0), ("2026-06-01", "co", None)])), silver)
    assert refresh_summaries(spark, silver, sums) == [20260503, 20260601]
    assert len(files) == 8 and len(parquet_below(sums) & files) == 7
    partials, whole = read_summaries(spark, sums), read_silver(spark, silver)
    assert monthly(state_monthly_of(partials)) == monthly(summaries.state_monthly(whole))
    assert rows_of(risk_summary_of(partials).orderBy("pollutant", "health_risk_category")) == rows_of(summaries.risk_summary(whole))


def test_many_days_prune_by_their_span(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(refresh, "_MOST_LISTED_DAYS", 1)
    silver, sums = str(tmp_path / "s"), str(tmp_path / "sums")
    write_silver(clean_daily(daily(spark, random_daily(100))), silver)
    assert len(refresh_summaries(spark, silver, sums)) == 2
    assert monthly(state_monthly_of(read_summaries(spark, sums))) == monthly(summaries.state_monthly(read_silver(spark, silver)))


def test_quantiles_are_within_their_error(spark):
    rows = spark.range(40_000).select(
        F.lit("co").alias("pollutant"),
        F.date_format(F.date_add(F.lit("2026-01-01"), (F.col("id") % 300).cast("int")), "yyyy-MM-dd").alias("day"),
        F.rand(3).alias("u"),
    )
    silver = rows.select(
        F.lit("Perak").alias("state"), "pollutant", F.lit("ppm").alias("unit"), F.lit("good").alias("health_risk_category"),
        F.year("day").alias("year"), F.month("day").alias("month"), F.dayofmonth("day").alias("day"), (F.col("u") * F.col("u")).alias("reading_value"),
    )
    odd = silver.limit(5).withColumn("pollutant", F.lit("none")).withColumn("reading_value", F.lit(None).cast("double"))
    nan = silver.limit(5).withColumn("reading_value", F.lit(float("nan")))
    found = quantiles_of(partial_sums(silver.union(odd).union(nan)), [0.05, 0.5, 0.95], "pollutant").collect()
    assert [(r.pollutant, r.readings) for r in found] == [("co", 40_000)] * 3
    for row in found:
        assert abs(row.value**0.5 - row.rank) < 2 * RANK_ERROR + 0.01
