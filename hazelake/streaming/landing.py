"""Landed responses as dumps: file streams whose batches become dumps named by their number.

A batch that is repeated after a failure writes the same dump again, in the place of the first, so each response is landed
once. What cannot be read lies beside the dumps, with the reason and its text.
"""

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazelake.dictionaries import DAILY_SOURCE, PAGE_LIMIT, SNAPSHOT_PREFIXES, SOURCES
from hazelake.operators.rejects import AFTER_END, Parted, part
from hazelake.sources.landing import document_bodies, flatten_pages, judged_documents, judged_pages, page_bodies
from hazelake.sources.paths import child, clear_folder, exists

#: Folders beside the dumps: rejects by source and dump, and the ends of runs by batch.
REJECTED, ENDS = "_rejected", "_ends"


def dump_name(source: str, batch_id: int) -> str:
    """Name of the dump of a batch; names of later batches sort later."""
    return f"{SNAPSHOT_PREFIXES[source]}_batch_{batch_id:010d}.json"


def _ends_before(spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
    """Run and offset of the first short page of each run, as batches up to this one know them."""
    if not exists(spark, folder):
        return None
    known = spark.read.schema("run string, end long, batch long").parquet(folder)
    return known.where(F.col("batch") <= batch_id).groupBy(F.col("run").alias("_run")).agg(F.min("end").alias("_end"))


def _land_pages(batch: DataFrame, batch_id: int, bronze_base: str, limit: int) -> Parted:
    """Pages of a batch as one dump of their records.

    Pages are parsed once, into the folder of the rejects. A short page ends its run, also for later batches: pages
    behind it are rejects. The ends of a batch are written under its number before they are read.
    """
    spark, name = batch.sparkSession, dump_name(DAILY_SOURCE, batch_id)
    folder = child(bronze_base, REJECTED, DAILY_SOURCE, name)
    pages = part(judged_pages(batch), child(folder, "pages"))
    ends = child(bronze_base, ENDS, DAILY_SOURCE)
    short = pages.accepted.where(F.col("size") < limit).groupBy("run").agg(F.min("offset").alias("end"))
    short.write.mode("overwrite").parquet(child(ends, f"batch={batch_id}"))
    ended = _ends_before(spark, ends, batch_id)
    judged = pages.accepted.join(ended, F.col("run").eqNullSafe(F.col("_run")), "left")
    late = F.when(F.col("offset") > F.col("_end"), F.lit(AFTER_END))
    runs = part(judged.select("run", "offset", "data", "size", late.alias("reason")), child(folder, "runs"))
    records = flatten_pages(runs.accepted)
    records.write.mode("overwrite").option("ignoreNullFields", False).json(child(bronze_base, DAILY_SOURCE, name))
    clear_folder(spark, child(folder, "pages", "taken=true"), pages.rejected.schema)
    clear_folder(spark, child(folder, "runs", "taken=true"), runs.rejected.schema)
    return Parted(records, pages.rejected, runs.taken, pages.rejected_by_reason | runs.rejected_by_reason)


def _land_documents(batch: DataFrame, batch_id: int, bronze_base: str, source: str) -> Parted:
    """Station documents of a batch as one dump."""
    spark, name = batch.sparkSession, dump_name(source, batch_id)
    folder = child(bronze_base, REJECTED, source, name)
    docs = part(judged_documents(batch), folder)
    kept = docs.accepted.select("location_id", "results")
    kept.write.mode("overwrite").option("ignoreNullFields", False).json(child(bronze_base, source, name))
    clear_folder(spark, child(folder, "taken=true"), docs.rejected.schema)
    return docs


def land(
    spark: SparkSession,
    landing: str,
    bronze_base: str,
    source: str,
    checkpoint: str,
    limit: int = PAGE_LIMIT,
    max_files: int | None = None,
    bundled: bool = False,
) -> StreamingQuery:
    """Land all responses that have arrived in ``landing`` since the last run as dumps of the source, then stop.

    Pages lie in ``run=…/offset=…/<file>``, station documents one per file; ``bundled`` responses are rows of Parquet
    files instead (:func:`page_bodies`, :func:`document_bodies`), as a file each costs more than what is in it once there
    are many. The dumps in ``<bronze_base>/<source>`` are JSON lines, which :func:`hazelake.ingest_latest` and
    :func:`hazelake.ingest_stream` take.
    """
    if source not in SOURCES:
        raise ValueError(f"Unsupported air-quality source: {source}")
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.readStream
    if source == DAILY_SOURCE:
        rows, write = page_bodies(reader, landing, bundled), partial(_land_pages, bronze_base=bronze_base, limit=limit)
    else:
        rows, write = document_bodies(reader, landing, bundled=bundled), partial(_land_documents, bronze_base=bronze_base, source=source)

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)

    return (
        rows.writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def rejected_responses(spark: SparkSession, bronze_base: str, source: str) -> DataFrame:
    """What landing has rejected of a source: where it came from, the reason, and the text where it could not be read."""
    where = "run string, offset long" if source == DAILY_SOURCE else "location_id string, path string"
    inner = ("*", "*", "taken=false") if source == DAILY_SOURCE else ("*", "taken=false")
    folder = child(bronze_base, REJECTED, source, *inner)
    return spark.read.schema(f"{where}, reason string, raw string").parquet(folder)
