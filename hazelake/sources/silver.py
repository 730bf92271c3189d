"""The partitioned silver dataset and the generic partitioned sink."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from hazelake.operators.rows import one_per_reading
from hazelake.operators.standardize import with_date_columns, with_risk
from hazelake.schemas import PARTITION_COLUMNS, SILVER, SILVER_COLUMNS
from hazelake.sources.paths import child, clear_folder, exists, file_listing


#: Name of the dataset below the silver base.
DATASET = "air_quality"

# Up to this many folder names, a few megabytes, are sent to every task of a merge. Beyond it Spark joins
# by shuffle.
_MOST_BROADCAST_PARTITIONS = 100_000
# Up to this many days are stated as values in the partition filter of a merge.
_MOST_LISTED_DAYS = 2_000
# Staged rows; the last column is that of a compaction.
_STAGED = StructType([*SILVER.fields, StructField("_bin", IntegerType())])
# A file that a compaction writes holds about so many bytes.
COMPACT_FILE_BYTES = 128 * 1024 * 1024


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    mode: str = "overwrite",
    format: str = "parquet",
) -> None:
    """Write a frame in any file format, into partition folders where columns are named."""
    df.write.save(str(path), format=format, mode=mode, partitionBy=list(partition_cols) or None)


def clustered_for_write(df: DataFrame) -> DataFrame:
    """Bring each silver partition together so that a day becomes few files rather than one per task.

    A rebalance, not a repartition: adaptive execution cuts a partition that outgrows the advisory size
    into several tasks and joins small ones, so a day holding a third of all rows is no single task.
    Rows are ordered by pollutant inside a file, so a query for one pollutant skips row groups.
    """
    rebalanced = df.hint("rebalance", *[F.col(name) for name in PARTITION_COLUMNS])
    if "pollutant" not in df.columns:
        return rebalanced
    return rebalanced.sortWithinPartitions(*PARTITION_COLUMNS, "pollutant")


def write_silver(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write rows into ``year/month/day/source`` folders and return how many were written.

    An overwrite replaces only the partitions that receive rows: the writer asks for that itself, so
    the other source's partitions survive whatever the session says. The count is taken by the write.
    A merge that failed after it was staged is finished first, so that it cannot undo this write later.
    """
    missing = [name for name in PARTITION_COLUMNS if name not in df.columns]
    if missing:
        raise ValueError(f"Missing required silver partition columns: {missing}")
    settle_merge(df.sparkSession, path)
    return _write(clustered_for_write(df), path, mode)


def _write(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write rows as they are dealt out; the count is observed in the stage that writes, once for each task."""
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTITION_COLUMNS).parquet(str(path))
    return written.get.get("rows", 0)


def read_silver(
    spark: SparkSession, path: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """The dataset in contract order and types; the optional days are a partition filter."""
    rows = spark.read.schema(SILVER).parquet(str(path)).select(*SILVER_COLUMNS)
    day = F.make_date("year", "month", "day")
    if since is not None:
        rows = rows.filter(day >= F.lit(since))
    if until is not None:
        rows = rows.filter(day <= F.lit(until))
    return rows


def _touched_only(old: DataFrame, touched: DataFrame, partitions: int) -> DataFrame:
    """Rows of ``old`` in the partitions of ``touched``.

    Up to a checked count the days are stated as values, so that the scan lists only their folders, however far
    apart they lie, and the folder names are broadcast. Beyond it the span of days prunes, and Spark joins by
    shuffle.
    """
    number = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    if partitions <= _MOST_BROADCAST_PARTITIONS:
        days = [row[0] for row in touched.select(number).distinct().collect()]
        if len(days) <= _MOST_LISTED_DAYS:
            old = old.filter(number.isin(days))
        touched = F.broadcast(touched)
    if partitions > _MOST_BROADCAST_PARTITIONS or len(days) > _MOST_LISTED_DAYS:
        span = touched.agg(F.min(number), F.max(number)).first()
        old = old.filter(number.between(*span))
    return old.join(touched, PARTITION_COLUMNS, "left_semi")


def _staging(path: str) -> str:
    """The folder beside a dataset in which merges are staged."""
    return f"{str(path).rstrip('/')}__merge"


def _marked_rows(spark: SparkSession, path: str) -> int | None:
    """Rows of a merge that is staged completely but not known to be written; None without such a merge."""
    mark = child(_staging(path), "mark")
    found = spark.read.text(mark).limit(1).collect() if exists(spark, mark) else []
    return int(found[0].value) if found else None


def _stage_and_replace(rows: DataFrame, path: str) -> int:
    """Stage whole partitions beside the dataset, mark them as complete, and put them in the place of the old ones."""
    spark, staging = rows.sparkSession, _staging(path)
    counted = Observation()
    staged = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    staged.write.mode("overwrite").parquet(child(staging, "merged"))
    mark = spark.createDataFrame([(str(counted.get.get("rows", 0)),)], "value string").coalesce(1)
    mark.write.mode("overwrite").text(child(staging, "mark"))
    return _replace(spark, path)


def _replace(spark: SparkSession, path: str) -> int:
    """Write the partitions that are staged, take the mark off, and only then clear the staged rows.

    Rows of a compaction carry the bin that becomes their file; those of a merge have none.
    """
    staging = _staging(path)
    staged = spark.read.schema(_STAGED).parquet(child(staging, "merged"))
    if staged.where("_bin is not null").limit(1).count():
        dealt = staged.repartition(*PARTITION_COLUMNS, "_bin")
        rows = _write(dealt.sortWithinPartitions(*PARTITION_COLUMNS, "_bin", "pollutant").drop("_bin"), path)
    else:
        rows = _write(clustered_for_write(staged.drop("_bin")), path)
    clear_folder(spark, child(staging, "mark"))
    clear_folder(spark, child(staging, "merged"))
    return rows


def settle_merge(spark: SparkSession, path: str) -> int | None:
    """Finish a merge of this dataset that failed while its partitions were replaced; None if there is none.

    Every write of this library does so first. The staged rows are counted against the mark before anything is
    replaced: if some are missing the dataset is left alone and the error says so.
    """
    marked = _marked_rows(spark, path)
    if marked is None:
        return None
    merged = child(_staging(path), "merged")
    found = spark.read.schema(SILVER).parquet(merged).count() if exists(spark, merged) else 0
    if found != marked:
        raise RuntimeError(
            f"The merge staged in {_staging(path)} should hold {marked} rows but holds {found}. Its partitions in {path} may "
            "be incomplete: restore the staged rows, or remove the mark and ingest these days again"
        )
    return _replace(spark, path)


def merge_silver(df: DataFrame, path: str) -> int:
    """Add rows to the partitions they touch instead of replacing these; returns the rows written.

    Meant for a partial dump. Of two copies of a reading the usual one survives, so the result is what
    cleaning both dumps together would give, in whatever order they arrive and however often.

    The new rows and the merged partitions are staged in a folder beside the dataset, named after it. Once the
    merged partitions are complete a mark says so and how many rows they hold. A failure before the mark leaves the
    dataset as it was; after one behind it the next write of any kind first repeats the marked write. The mark goes
    before the staged rows do, so that nothing is repeated from a part of them. One writer at a time may work on a dataset.
    """
    spark = df.sparkSession
    settle_merge(spark, path)
    fresh_path = child(_staging(path), "fresh")
    df.select(*SILVER_COLUMNS).write.mode("overwrite").parquet(fresh_path)
    fresh = spark.read.schema(SILVER).parquet(fresh_path)
    touched = fresh.select(*PARTITION_COLUMNS).distinct()
    partitions = touched.count()
    rows = 0
    if partitions:
        union = fresh
        if exists(spark, path):
            stale = _touched_only(read_silver(spark, path), touched, partitions)
            union = stale.select(*SILVER_COLUMNS).unionByName(fresh)
        derived = ["observed_date", "year", "month", "day", "health_risk_category"]
        merged = with_risk(with_date_columns(one_per_reading(union.drop(*derived))))
        rows = _stage_and_replace(merged.select(*SILVER_COLUMNS), path)
    clear_folder(spark, fresh_path)
    return rows


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """``year, month, day, source, file, length`` of the dataset's files, from their listing alone."""
    files = file_listing(spark, path)
    value = {name: F.regexp_extract("path", rf"/{name}=([^/]*)/", 1) for name in PARTITION_COLUMNS}
    source = F.url_decode(F.replace(value["source"], F.lit("+"), F.lit("%2B")))
    return files.select(
        *(value[name].cast("int").alias(name) for name in PARTITION_COLUMNS[:-1]),
        source.alias("source"),
        F.substring_index("path", "/", -1).alias("file"),
        "length",
    )


def compact_silver(spark: SparkSession, path: str, file_bytes: int = COMPACT_FILE_BYTES) -> int:
    """Pack the files of partitions that hold more of them than their bytes need; returns the rows rewritten.

    Files are put into bins in the order of their names until a bin is full; the rows of a bin become one file. Which
    partitions, and which bin a file belongs to, follow from the listing alone. Rows are staged and marked like those
    of a merge, so a failure loses none. Other partitions are not touched.
    """
    settle_merge(spark, path)
    files = partition_files(spark, path)
    by_name = Window.partitionBy(*PARTITION_COLUMNS).orderBy("file")
    before = F.sum("length").over(by_name) - F.col("length")
    bins = files.withColumn("_bin", F.floor(before / F.lit(file_bytes)).cast("int"))
    sizes = files.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    worn = sizes.where(F.col("files") > F.ceil(F.col("bytes") / F.lit(file_bytes))).select(*PARTITION_COLUMNS)
    partitions = worn.count()
    if not partitions:
        return 0
    stored = spark.read.schema(SILVER).parquet(str(path)).withColumn("file", F.col("_metadata.file_name"))
    rows = _touched_only(stored, worn, partitions)
    packed = rows.join(bins.select(*PARTITION_COLUMNS, "file", "_bin"), [*PARTITION_COLUMNS, "file"])
    return _stage_and_replace(packed.select(*SILVER_COLUMNS, "_bin"), path)
