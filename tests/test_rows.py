import os
import subprocess
import sys
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hazelake.operators.rows import (
    one_per_reading,
    rejected_daily_rows,
    trailing_bounds,
    trailing_range,
    valid_rows,
)
from hazelake.operators.standardize import with_time_columns

LAYOUT = (
    "source string, source_location_id string, location_name string, pollutant string, "
    "observed_at timestamp, unit string, reading_value double"
)
AT = datetime(2026, 5, 27)


def random_rows(count, seed=1):
    pick = random.Random(seed)
    return [
        (
            pick.choice(["opendosm", "openaq"]),
            pick.choice([None, "1", "2"]),
            pick.choice([None, "KLCC"]),
            pick.choice(["CO", "PM10", ""]),
            pick.choice([None, AT, datetime(2026, 5, 28)]),
            pick.choice([None, "ppm", "ppb"]),
            pick.choice([None, 1.0, 2.0, float("nan"), -3.0]),
        )
        for _ in range(count)
    ]


def survivors(rows):
    """The rule in plain Python: per key the largest payload, nulls last, NaN above all numbers."""

    def rank(value):
        if value is None:
            return (0, 0)
        return (2, 0) if value != value else (1, value)

    best = {}
    for row in rows:
        key, order = row[:5], (rank(row[6]), rank(row[5]))
        if key not in best or order > best[key][0]:
            best[key] = (order, row)
    return sorted(repr(row) for _, row in best.values())


def collected(df):
    return sorted(repr(tuple(row)) for row in df.collect())


def test_survivors_match_the_rule_however_rows_are_spread(spark):
    rows = random_rows(2000)
    frame = spark.createDataFrame(rows, LAYOUT)
    expected = survivors(rows)
    assert collected(one_per_reading(frame)) == expected
    assert collected(one_per_reading(frame.repartition(7))) == expected
    assert collected(one_per_reading(frame.orderBy(F.rand(3)).coalesce(1))) == expected


def test_survivors_do_not_depend_on_how_the_rows_arrive(spark):
    rows = random_rows(500, seed=2)
    parts = [one_per_reading(spark.createDataFrame(part, LAYOUT)) for part in (rows[:200], rows[200:])]
    assert collected(one_per_reading(parts[0].unionByName(parts[1]))) == survivors(rows)


def test_one_key_holding_a_third_of_the_rows_leaves_each_task_once(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    rows = spark.range(0, 60_000, 1, 8).select(
        F.lit("s").alias("source"),
        hot.alias("source_location_id"),
        F.lit(None).cast("string").alias("location_name"),
        F.lit("CO").alias("pollutant"),
        F.lit(AT).alias("observed_at"),
        F.col("id").cast("double").alias("reading_value"),
    )
    kept = one_per_reading(rows)
    assert kept.count() == 40_001
    assert kept.filter("source_location_id = 'hot'").first().reading_value == 59_997.0
    assert "partial_max" in kept._jdf.queryExecution().executedPlan().toString()


def test_keys_alone_and_payloads_that_cannot_be_ordered(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1)], "k string, n int")
    assert one_per_reading(frame, ["k", "n"]).count() == 2
    assert one_per_reading(frame, ["k"]).count() == 2
    mapped = frame.withColumn("m", F.create_map(F.lit("x"), F.col("n")))
    assert one_per_reading(mapped, ["k"]).columns == ["k", "n", "m"]
    assert one_per_reading(mapped, ["k"]).count() == 2
    assert one_per_reading(mapped.select("k", "m"), ["k"]).count() == 2


def test_zero_is_one_key_whatever_its_sign(spark):
    frame = spark.createDataFrame([("a", 0.0, 1), ("a", -0.0, 2)], "k string, f double, n int")
    assert [row.n for row in one_per_reading(frame, ["k", "f"]).collect()] == [2]
    assert one_per_reading(frame.select("f", "n"), ["f"]).count() == 1


def test_valid_rows(spark):
    frame = spark.createDataFrame(
        [("2026-05-27", "CO"), ("2026-05-27", ""), ("2026-05-27", None), ("x", "CO"), (None, None)],
        "raw string, pollutant string",
    )
    kept = valid_rows(with_time_columns(frame, "raw"))
    assert sorted(row.pollutant for row in kept.collect()) == ["", "CO"]


def test_rejected_rows_say_why(spark):
    frame = spark.createDataFrame(
        [
            ("2026-05-27", "CO", "1"),
            ("2026-05-27", "CO", None),
            ("2026-05-27", "CO", "n/a"),
            ("2026-05-27", None, "1"),
            (None, "CO", "1"),
            ("bad", "CO", "1"),
            (None, None, None),
        ],
        "date string, pollutant string, concentration string",
    )
    reasons = sorted(row.reason for row in rejected_daily_rows(frame).collect())
    assert reasons == [
        "missing date",
        "missing pollutant",
        "missing pollutant",
        "unreadable date",
        "unreadable value",
    ]


def test_trailing_range_has_both_ends(spark):
    as_of = datetime(2026, 7, 1, 12)
    start, end = trailing_bounds(as_of)
    assert (end - start).days == 180 and end == as_of
    moments = [start, end, datetime(2026, 1, 2, 11, 59, 59), datetime(2026, 7, 1, 12, 0, 1), None]
    frame = spark.createDataFrame([(moment,) for moment in moments], "observed_at timestamp")
    assert {row.observed_at for row in trailing_range(frame, as_of).collect()} == {start, end}
    assert trailing_range(frame, as_of, months_back=0).count() == 1


def test_trailing_range_ignores_the_zone_of_the_driver():
    code = """
from datetime import datetime
from pyspark.sql import SparkSession
from hazelake.operators.rows import trailing_range
spark = SparkSession.builder.master("local[1]").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
hours = spark.sql("select timestamp'2026-03-10 00:00:00' + make_interval(0, 0, 0, 0, id) as observed_at from range(24)")
print("ROWS", trailing_range(hours, datetime(2026, 3, 10, 12)).count())
"""
    env = os.environ | {"TZ": "Asia/Kuala_Lumpur", "PYTHONPATH": os.getcwd()}
    run = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert "ROWS 13" in run.stdout, run.stderr[-2000:]
