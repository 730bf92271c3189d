import math
from datetime import date, datetime

from pyspark.sql import functions as F

from hazelake.dictionaries import RISK_LABELS, RISK_LIMITS
from hazelake.functions.readings import label_by_limits, number, reading_time
from hazelake.operators.standardize import with_risk, with_time_columns


def test_reading_time(spark):
    cases = {
        "2026-05-27": datetime(2026, 5, 27),
        " 2026-05-27 ": datetime(2026, 5, 27),
        "2026-5-7": datetime(2026, 5, 7),
        "2026-05": datetime(2026, 5, 1),
        "2026": datetime(2026, 1, 1),
        "2026-05-28T01:02:03Z": datetime(2026, 5, 28, 1, 2, 3),
        "2026-05-28 01:02:03": datetime(2026, 5, 28, 1, 2, 3),
        "2026-05-28T01:02:03.5+08:00": datetime(2026, 5, 27, 17, 2, 3, 500000),
        "2026-05-27T20:00:00Z": datetime(2026, 5, 27, 20),
        "12:34": None,
        "T12:34": None,
        "\t12:34:56": None,
        "2026-02-30": None,
        "27/05/2026": None,
        "bad-date": None,
        "": None,
        None: None,
    }
    rows = spark.createDataFrame([(text,) for text in cases], "x string")
    assert {r.x: r.y for r in rows.select("x", reading_time(F.col("x")).alias("y")).collect()} == cases


def test_time_columns(spark):
    rows = spark.createDataFrame([("2026-05-27T23:59:59Z",), ("nonsense",)], "raw string")
    first, second = with_time_columns(rows, "raw").drop("raw").collect()
    assert first == (datetime(2026, 5, 27, 23, 59, 59), date(2026, 5, 27), 2026, 5, 27)
    assert second == (None,) * 5
    dated = spark.createDataFrame([(date(2026, 5, 27),)], "raw date")
    assert with_time_columns(dated, "raw").first().day == 27


def test_time_follows_the_session_zone(spark):
    rows = spark.createDataFrame([("2026-05-27T20:00:00Z",)], "raw string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kuala_Lumpur")
    try:
        assert with_time_columns(rows, "raw").first().observed_date == date(2026, 5, 28)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbers_never_fail(spark):
    cases = {"1.50": 1.5, " 2 ": 2.0, "1e3": 1000.0, "-0.1": -0.1, "n/a": None, "": None, None: None}
    rows = spark.createDataFrame([(text,) for text in cases], "x string")
    assert {r.x: r.y for r in rows.select("x", number(F.col("x")).alias("y")).collect()} == cases
    assert spark.range(1).select(number(F.lit(7)).alias("y")).first().y == 7.0


def test_every_risk_limit_is_inclusive(spark):
    rows, expected = [], []
    for pollutant, limits in RISK_LIMITS.items():
        for i, limit in enumerate(limits):
            rows += [(pollutant, limit), (pollutant, math.nextafter(limit, math.inf))]
            expected += [RISK_LABELS[i], RISK_LABELS[i + 1]]
    frame = spark.createDataFrame(rows, "pollutant string, reading_value double").coalesce(1)
    assert [row.health_risk_category for row in with_risk(frame).collect()] == expected


def test_risk_of_odd_values(spark):
    cases = [
        ("RADON", 8.0, "unknown"),
        ("O3", None, "unknown"),
        ("SO2", 1e300, "hazardous"),
        ("pm2.5", 1.0, "unknown"),
        (None, 1.0, "unknown"),
        (None, None, "unknown"),
        ("CO", float("nan"), "hazardous"),
        ("CO", float("inf"), "hazardous"),
        ("CO", -1.0, "good"),
    ]
    frame = spark.createDataFrame(
        [case[:2] for case in cases], "pollutant string, reading_value double"
    ).coalesce(1)
    assert [row[2] for row in with_risk(frame).collect()] == [case[2] for case in cases]


def test_label_by_a_list_of_limits(spark):
    rows = spark.createDataFrame([(1.0,), (5.0,), (5.5,), (99.0,), (None,)], "v double").coalesce(1)
    label = label_by_limits(F.col("v"), [1, 2, 3, 4, 5])
    expected = ["good", "very_unhealthy", "hazardous", "hazardous", "hazardous"]
    assert [row.l for row in rows.select(label.alias("l")).collect()] == expected
