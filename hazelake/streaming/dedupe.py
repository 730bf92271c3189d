"""De-duplication inside the stream: keyed state under a watermark instead of a merge for every batch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazelake.dictionaries import DAILY_SOURCE
from hazelake.plans.silver import clean, daily_silver
from hazelake.schemas import PARTITION_COLUMNS, SILVER, SILVER_COLUMNS


def append_stream(dumps: DataFrame, path: str, source: str, checkpoint: str, lateness: str) -> StreamingQuery:
    """Append each reading of a stream of dumps to the dataset at ``path`` once, when no copy of it can come any more.

    The best copy of a reading is kept as state until the newest time seen is ``lateness`` ahead of it. Then it is
    written by Spark's file sink, whose log takes every batch once, and its state goes. State is therefore as large as
    the readings of that span of time, whatever the history; nothing stored is read or replaced. Copies that come even
    later are left out. The dataset belongs to this stream alone: the sink's log decides which files count.
    """
    return (
        clean(dumps, source, lateness)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .option("path", str(path))
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def appended_readings(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`append_stream` has written."""
    return spark.read.schema(SILVER).parquet(str(path)).select(*SILVER_COLUMNS)


def open_readings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Daily readings of which copies may still come: the best ones so far, as the stream's state holds them.

    With :func:`appended_readings` these are what cleaning all dumps at once would give.
    """
    state = spark.read.format("statestore").load(str(checkpoint))
    kept = state.select("key.*", F.col("value.max").alias("reading_value"))
    return daily_silver(kept.filter(F.col("observed_at").isNotNull()))
