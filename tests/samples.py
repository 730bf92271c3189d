"""Small bronze samples and random ones."""

import random

from pyspark.sql import DataFrame, SparkSession

from hazelake.schemas import STATION_BRONZE

DAILY_LAYOUT = "date string, pollutant string, concentration double"

DAILY = [
    ("2025-11-03T18:45:00Z", "Nitrogen Dioxide", 88.0),
    ("31/12/2025", "no2", 4.5),
    ("2025-11-04", "ozone", 31.25),
    ("2025-11-04", "so2", None),
    ("2025-11-04", "ozone", 31.25),
    ("2025-11-05", None, 17.0),
]


def daily(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(DAILY if rows is None else rows, DAILY_LAYOUT)


def random_daily(count: int, seed: int = 5) -> list[tuple]:
    pick = random.Random(seed)
    dates = ["2026-05-27", "2026-05-27T00:00:00Z", "2026-05-28", "2026-05-28 10:00:00", "12:34", "", None]
    names = ["pm25", "PM 2.5", "co", "Carbon-Monoxide", "ozone", "mystery", "", None]
    values = [None, 0.0, 12.0, 12.1, 500.0, -1.0, float("nan")]
    return [(pick.choice(dates), pick.choice(names), pick.choice(values)) for _ in range(count)]


def sensor(name, units=None) -> dict:
    return {"parameter": {"name": name, "units": units}}


def station(id, name, sensors, last="2026-05-27T12:00:00Z", first="2026-05-01T00:00:00Z", **other) -> dict:
    return {
        "id": str(id),
        "name": name,
        "locality": None,
        "country": {"name": "Malaysia"},
        "coordinates": {"latitude": "5.4141", "longitude": "100.3288"},
        "datetimeFirst": {"utc": first},
        "datetimeLast": {"utc": last},
        "sensors": sensors,
    } | other


def documents(spark: SparkSession, docs: list[dict]) -> DataFrame:
    return spark.createDataFrame([(d.get("location_id"), d.get("results")) for d in docs], STATION_BRONZE)


def rows_of(df: DataFrame) -> list[str]:
    return sorted(repr(tuple(row)) for row in df.collect())
