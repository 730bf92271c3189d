"""Summaries kept up to date: partial sums and sketches per day, of which only touched days are worked out again."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazelake.sources.paths import exists, file_listing
from hazelake.sources.silver import read_silver

#: What one row of a day's partial sums stands for.
GRAIN = ["state", "pollutant", "unit", "health_risk_category"]
DAY = ["year", "month", "day"]
#: Size of a quantile sketch, and the error of a rank that goes with it (a bound that holds for 99 of 100 sketches).
SKETCH_K, RANK_ERROR = 200, 0.0133
# Up to this many days are stated as values in a partition filter; beyond, the span of days prunes.
_MOST_LISTED_DAYS = 2_000

_PARTIALS = (
    "state string, pollutant string, unit string, health_risk_category string, readings long, values long, total double, "
    "lowest double, highest double, sketch binary, year int, month int, day int"
)


def partial_sums(silver: DataFrame) -> DataFrame:
    """One row per day, state, pollutant, unit and risk label, which sums of any coarser group can be put together from.

    Sketches are of the values that are numbers; a group without one has none.
    """
    value = F.col("reading_value")
    known = F.when(~F.isnan(value), value)
    sums = silver.groupBy(*DAY, *GRAIN).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count(value).alias("values"),
        F.sum(value).alias("total"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.count(known).alias("_known"),
        F.kll_sketch_agg_double(known, SKETCH_K).alias("_sketch"),
    )
    sketched = sums.withColumn("sketch", F.when(F.col("_known") > 0, F.col("_sketch")))
    return sketched.select(*GRAIN, "readings", "values", "total", "lowest", "highest", "sketch", *DAY)


def _days(spark: SparkSession, path: str) -> DataFrame:
    """``year, month, day, oldest, newest``: modification times of each day's files, from the listing alone."""
    parts = [F.regexp_extract("path", rf"/{name}=([0-9]+)/", 1).cast("int").alias(name) for name in DAY]
    files = file_listing(spark, path).select(*parts, "modificationTime")
    at = F.col("modificationTime")
    return files.groupBy(*DAY).agg(F.min(at).alias("oldest"), F.max(at).alias("newest"))


def stale_days(spark: SparkSession, silver_path: str, summary_path: str) -> list[int]:
    """Days, as numbers like 20260131, of which silver has changed since their partial sums were written."""
    days = _days(spark, silver_path)
    if exists(spark, summary_path):
        done = _days(spark, summary_path).select(*DAY, F.col("oldest").alias("done"))
        days = days.join(done, DAY, "left").where(F.col("done").isNull() | (F.col("newest") >= F.col("done")))
    number = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    return [row[0] for row in days.select(number).orderBy(number).collect()]


def refresh_summaries(spark: SparkSession, silver_path: str, summary_path: str) -> list[int]:
    """Bring the partial sums in line with silver; returns the days that were worked out again.

    Only folders of days with newer files are read and replaced. A run that fails is repeated by the next one, since
    the days it did not reach are still older than their readings. A day whose readings were all deleted keeps its sums.
    """
    days = stale_days(spark, silver_path, summary_path)
    if not days:
        return []
    rows = read_silver(spark, silver_path)
    number = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    if len(days) <= _MOST_LISTED_DAYS:
        rows = rows.where(number.isin(days))
    else:
        listed = spark.createDataFrame([(d,) for d in days], "_day int")
        rows = rows.where(number.between(days[0], days[-1])).join(F.broadcast(listed), number == F.col("_day"), "left_semi")
    sums = partial_sums(rows).hint("rebalance", *(F.col(name) for name in DAY))
    writer = sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*DAY).parquet(summary_path)
    return days


def read_summaries(spark: SparkSession, summary_path: str) -> DataFrame:
    """The partial sums of all days."""
    return spark.read.schema(_PARTIALS).parquet(summary_path)


def state_monthly_of(partials: DataFrame) -> DataFrame:
    """:func:`hazelake.plans.summaries.state_monthly` from partial sums."""
    values = F.sum("values")
    return partials.groupBy("state", "year", "month", "pollutant", "unit").agg(
        (F.sum("total") / F.nullif(values, F.lit(0))).alias("mean_value"),
        F.min("lowest").alias("min_value"),
        F.max("highest").alias("max_value"),
        values.alias("readings"),
    )


def risk_summary_of(partials: DataFrame) -> DataFrame:
    """:func:`hazelake.plans.summaries.risk_summary` from partial sums."""
    counts = partials.groupBy("pollutant", "health_risk_category").agg(F.sum("readings").alias("readings"))
    total = F.sum("readings").over(Window.partitionBy("pollutant"))
    return counts.withColumn("share", F.col("readings") / total)


def quantiles_of(partials: DataFrame, ranks: list[float], *by: str) -> DataFrame:
    """``rank, value, readings`` of the values in each group, from merged sketches.

    The share of values up to ``value`` differs from ``rank`` by ``RANK_ERROR`` at most, with 99 % confidence.
    """
    merged = partials.where("sketch is not null").groupBy(*by).agg(F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"))
    each = [
        F.struct(F.lit(rank).alias("rank"), F.kll_sketch_get_quantile_double("sketch", F.lit(rank)).alias("value")) for rank in ranks
    ]
    found = merged.select(*by, F.kll_sketch_get_n_double("sketch").alias("readings"), F.explode(F.array(*each)).alias("found"))
    return found.select(*by, "found.rank", "found.value", "readings")
