"""Rejects beside the rows: each raw row is taken or rejected with a reason, in one pass over the input."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hazelake.dictionaries import DAILY_SOURCE, STATION_SOURCE
from hazelake.functions.readings import reading_time
from hazelake.operators.shapes import station_rows_of
from hazelake.sources.bronze import CORRUPT
from hazelake.sources.landing import UNREADABLE

MALFORMED = "malformed record"
NO_POLLUTANT = "missing pollutant"
NO_DATE, BAD_DATE = "missing date", "unreadable date"
NO_RESULTS, NO_SENSORS = "no results", "no sensors"
AFTER_END = "after the end of the run"
#: All reasons, in the order in which they are looked for.
REASONS = (MALFORMED, UNREADABLE, NO_RESULTS, NO_SENSORS, NO_POLLUTANT, NO_DATE, BAD_DATE, AFTER_END)


def _raw_text(df: DataFrame) -> Column:
    return F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")


def judged_daily(df: DataFrame) -> DataFrame:
    """Daily bronze rows with ``reason``, null for those that reach silver, and ``raw``, the text of a line that is no JSON."""
    date, raw = F.col("date"), _raw_text(df)
    reason = (
        F.when(raw.isNotNull(), MALFORMED)
        .when(F.col("pollutant").isNull(), NO_POLLUTANT)
        .when(date.isNull(), NO_DATE)
        .when(reading_time(date).isNull(), BAD_DATE)
    )
    return df.select("date", "pollutant", "concentration", reason.alias("reason"), raw.alias("raw"))


def judged_stations(df: DataFrame) -> DataFrame:
    """Station documents as rows of the common raw layout, one per sensor, with ``timestamp``, ``reason`` and ``raw``.

    A document without results and a station without sensors are one rejected row each, so that every part of the
    input is in exactly one row. The reason is the first that applies, from the document down to the sensor.
    """
    raw = _raw_text(df)
    results = df.select("location_id", raw.alias("raw"), F.explode_outer("results").alias("result"))
    sensors = results.select("*", F.explode_outer("result.sensors").alias("sensor"))
    time = F.coalesce(F.col("result.datetimeLast.utc"), F.col("result.datetimeFirst.utc"))
    reason = (
        F.when(F.col("raw").isNotNull(), MALFORMED)
        .when(F.col("result").isNull(), NO_RESULTS)
        .when(F.coalesce(F.size("result.sensors"), F.lit(0)) <= 0, NO_SENSORS)
        .when(time.isNull(), NO_DATE)
        .when(reading_time(time).isNull(), BAD_DATE)
        .when(F.col("sensor.parameter.name").isNull(), NO_POLLUTANT)
    )
    return station_rows_of(sensors, reason.alias("reason"), F.col("raw"))


_JUDGES = {DAILY_SOURCE: judged_daily, STATION_SOURCE: judged_stations}


def judged(df: DataFrame, source: str) -> DataFrame:
    """Bronze rows of the named source with the reason why they do not reach silver."""
    return _JUDGES[source](df)


class Parted(NamedTuple):
    """What was taken, what was rejected, and how many rows of either kind the one pass saw.

    ``taken`` and the counts in ``rejected_by_reason`` add up to the rows of the input.
    """

    accepted: DataFrame
    rejected: DataFrame
    taken: int
    rejected_by_reason: dict[str, int]


def part(rows: DataFrame, path: str) -> Parted:
    """Write judged rows to ``path`` in one pass: ``taken=true`` holds the accepted ones, ``taken=false`` the rejects.

    The input is read and parsed once; rows are counted by reason in the stage that writes. A folder that is there
    already is replaced, so that a repeated run leaves one copy.
    """
    counted, reason = Observation(), F.col("reason")
    counts = {f"r{i}": F.count_if(reason == name) for i, name in enumerate(REASONS)}
    counts["taken"], counts["read"] = F.count_if(reason.isNull()), F.count(F.lit(1))
    seen = rows.observe(counted, *(count.alias(name) for name, count in counts.items()))
    marked = seen.withColumn("taken", reason.isNull())
    marked.write.mode("overwrite").partitionBy("taken").parquet(path)
    found = counted.get
    by_reason = {name: found[f"r{i}"] for i, name in enumerate(REASONS) if found.get(f"r{i}")}
    other = found.get("read", 0) - found.get("taken", 0) - sum(by_reason.values())
    if other:
        by_reason["other"] = other
    back = rows.sparkSession.read.schema(marked.schema).parquet(path)
    known = [name for name in rows.columns if name not in ("reason", "raw")]
    return Parted(
        back.filter("taken").select(*known), back.filter("not taken").drop("taken"), found.get("taken", 0), by_reason
    )
