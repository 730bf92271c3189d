"""Summaries of the silver dataset.

Each is a hash aggregate with partial aggregation over the few columns it reads. Windows only ever run
over aggregated rows, whose number per window is bounded by the calendar or the list of risk labels.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def state_monthly(silver: DataFrame) -> DataFrame:
    """Mean, lowest, highest and number of values per state, month, pollutant and unit."""
    value = F.col("reading_value")
    return silver.groupBy("state", "year", "month", "pollutant", "unit").agg(
        F.avg(value).alias("mean_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.count(value).alias("readings"),
    )


def risk_summary(silver: DataFrame) -> DataFrame:
    """Readings per pollutant and health-risk label, with the share within the pollutant."""
    counts = silver.groupBy("pollutant", "health_risk_category").agg(
        F.count(F.lit(1)).alias("readings")
    )
    total = F.sum("readings").over(Window.partitionBy("pollutant"))
    return counts.withColumn("share", F.col("readings") / total)


def _pm25(silver: DataFrame) -> DataFrame:
    return silver.filter((F.col("pollutant") == "PM2.5") & F.col("reading_value").isNotNull())


def haze_trend(silver: DataFrame, days: int = 7) -> DataFrame:
    """Daily PM2.5 mean per state, its mean over the last ``days`` calendar days and its change since
    the last day with readings."""
    daily = _pm25(silver).groupBy("state", "observed_date").agg(
        F.avg("reading_value").alias("daily_mean")
    )
    by_day = Window.partitionBy("state").orderBy(F.unix_date("observed_date"))
    mean = F.col("daily_mean")
    return daily.select(
        "state",
        "observed_date",
        "daily_mean",
        F.avg(mean).over(by_day.rangeBetween(1 - days, 0)).alias("trailing_mean"),
        (mean - F.lag(mean).over(by_day)).alias("change"),
    )


def state_mean_pm25(silver: DataFrame) -> DataFrame:
    """Mean PM2.5 value per state."""
    return _pm25(silver).groupBy("state").agg(F.avg("reading_value").alias("mean_pm25"))
