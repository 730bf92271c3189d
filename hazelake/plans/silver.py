"""Bronze to silver: the shared cleaning plan and its two sources."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.dictionaries import DAILY_COUNTRY, DAILY_SOURCE, STATION_SOURCE
from hazelake.functions.naming import canonical_pollutant, canonical_unit
from hazelake.functions.readings import number, reading_time, risk_label
from hazelake.operators.rows import one_per_reading
from hazelake.operators.shapes import sensor_rows, stations
from hazelake.operators.standardize import (
    with_date_columns,
    with_pollutant_and_unit,
    with_risk,
    with_state,
)
from hazelake.schemas import IDENTITY_COLUMNS, SILVER, SILVER_COLUMNS

# Columns a reading carries through de-duplication; the dates and the risk label follow from them.
_PAYLOAD = ["state", "country", "latitude", "longitude", "unit", "reading_value"]


def _finish(df: DataFrame, lateness: str | None = None) -> DataFrame:
    """De-duplicate canonical rows, then add what depends only on the surviving row.

    On a stream ``lateness`` bounds how long readings of a time are held for copies.
    """
    rows = df.select(*IDENTITY_COLUMNS, *_PAYLOAD)
    kept = one_per_reading(rows.withWatermark("observed_at", lateness) if lateness else rows)
    return with_risk(with_date_columns(kept)).select(*SILVER_COLUMNS)


def clean_rows(df: DataFrame, raw_time_col: str) -> DataFrame:
    """Silver rows from any frame in the common raw layout.

    Invalid rows leave before the shuffle: both validity tests depend on the de-duplication key only,
    so testing first gives the same rows.
    """
    present = df.filter(F.col("pollutant").isNotNull())
    named = with_state(with_pollutant_and_unit(present))
    timed = named.withColumn("observed_at", reading_time(F.col(raw_time_col)))
    return _finish(timed.filter(F.col("observed_at").isNotNull()))


def clean_daily(df: DataFrame, lateness: str | None = None) -> DataFrame:
    """Silver rows of flat daily records.

    Daily records name no place, so a reading is known by pollutant and time alone and the preferred
    copy is the one with the largest value: one hash aggregate over narrow rows, with partial
    aggregation. Everything else is a constant or follows from the pollutant.
    """
    present = df.filter(F.col("pollutant").isNotNull() & F.col("date").isNotNull())
    readings = present.select(
        canonical_pollutant(F.col("pollutant")).alias("pollutant"),
        reading_time(F.col("date")).alias("observed_at"),
        number(F.col("concentration")).alias("reading_value"),
    )
    if lateness:
        readings = readings.withWatermark("observed_at", lateness)
    # A filter on the parsed time would be pushed below the projection and parse every text a second
    # time. The count drops the one group per pollutant that unreadable times fall into instead.
    kept = (
        readings.groupBy("pollutant", "observed_at")
        .agg(F.max("reading_value").alias("reading_value"), F.count("observed_at").alias("timed"))
        .filter(F.col("timed") > 0)
    )
    return daily_silver(kept)


def daily_silver(kept: DataFrame) -> DataFrame:
    """Distinct ``pollutant, observed_at, reading_value`` of the daily source in the silver layout."""
    known = {
        "source": F.lit(DAILY_SOURCE),
        "country": F.lit(DAILY_COUNTRY),
        "unit": canonical_unit(None, F.col("pollutant")),
        "health_risk_category": risk_label(F.col("pollutant"), F.col("reading_value")),
    }
    dated = with_date_columns(kept)
    return dated.select(
        *[
            F.col(field.name)
            if field.name in dated.columns
            else known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in SILVER
        ]
    )


def clean_stations(df: DataFrame, lateness: str | None = None) -> DataFrame:
    """Silver rows of nested station documents.

    Names, times and states are worked out once per station, before its sensors are laid out as rows,
    and stations without a readable time never get that far.
    """
    at_station = stations(df).withColumn("observed_at", reading_time(F.col("timestamp")))
    timed = at_station.filter(F.col("observed_at").isNotNull())
    rows = sensor_rows(with_state(timed)).filter(F.col("pollutant").isNotNull())
    return _finish(with_pollutant_and_unit(rows), lateness)


_CLEANERS = {DAILY_SOURCE: clean_daily, STATION_SOURCE: clean_stations}


def require_source(source: str) -> str:
    """The source name itself; an unknown one is an error."""
    if source not in _CLEANERS:
        raise ValueError(f"Unsupported air-quality source: {source}")
    return source


def clean(df: DataFrame, source: str, lateness: str | None = None) -> DataFrame:
    """Silver rows of a bronze frame of the named source.

    For a stream to append its rows, ``lateness`` (like ``"2 days"``) says how far behind the newest reading copies and
    other rows may come; what comes later is left out.
    """
    return _CLEANERS[require_source(source)](df, lateness)


def clean_accepted(df: DataFrame, source: str) -> DataFrame:
    """Silver rows of what :func:`hazelake.operators.rejects.part` accepted of the named source."""
    return clean_rows(df, "timestamp") if require_source(source) == STATION_SOURCE else clean_daily(df)


def clean_all(daily: DataFrame, stations_df: DataFrame) -> DataFrame:
    """Both sources as one bag of silver rows; the source is part of the key, so nothing collides."""
    return clean_daily(daily).unionByName(clean_stations(stations_df))
