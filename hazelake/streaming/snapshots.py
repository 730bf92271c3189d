"""Incremental ingest: every dump not seen before, instead of only the newest."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazelake.operators.rejects import judged, part
from hazelake.plans.silver import clean_accepted, require_source
from hazelake.sources.bronze import BRONZE_SCHEMAS, LINES, records
from hazelake.sources.paths import child, clear_folder
from hazelake.sources.silver import DATASET, merge_silver
from hazelake.streaming.progress import BatchLog, counted


def stream_dumps(
    spark: SparkSession,
    bronze_path: str,
    source: str,
    layout: str = LINES,
    max_files: int | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Raw records of the files below ``bronze_path``, read as they arrive.

    The default layout is that of :func:`land_snapshot`; all layouts of :func:`read_json` can be named.
    """
    schema, reader = BRONZE_SCHEMAS[require_source(source)], spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return records(reader, str(bronze_path), schema, layout, keep_corrupt)


def ingest_stream(
    spark: SparkSession,
    bronze_path: str,
    silver_base: str,
    source: str,
    checkpoint: str,
    layout: str = LINES,
    max_files: int | None = None,
    rejects: str | None = None,
    log: BatchLog | None = None,
) -> StreamingQuery:
    """Clean all files that have arrived since the last run, then stop.

    Batches are merged into the partitions they touch, so it does not matter how the files are spread
    over batches, and a batch that is repeated after a failure changes nothing. A line that does not parse, as in a
    file of another layout, fails its batch before anything is written, and the stream does not go past it; with a folder
    for ``rejects`` it lies in ``<rejects>/<source>/batch=<id>`` instead, with all else that does not reach silver.
    ``log``, a listener added to the session's streams, is told how many rows each batch read, rejected and wrote.
    """
    silver_path = child(silver_base, DATASET)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        folder = child(rejects, source, f"batch={batch_id}") if rejects is not None else None
        if folder is None:
            message = F.concat(F.lit(f"Not JSON of the layout {layout!r}: "), F.left("raw", F.lit(200)))
            broken = F.assert_true(F.col("raw").isNull(), message)
            accepted = batch.where(broken.isNull() & F.col("reason").isNull()).drop("reason", "raw")
        else:
            parted = part(batch, folder)
            accepted = parted.accepted
        written = merge_silver(clean_accepted(accepted, source), silver_path)
        if folder is not None:
            clear_folder(spark, child(folder, "taken=true"), parted.rejected.schema)
        if log is not None:
            log.wrote(batch_id, written)

    rows = counted(judged(stream_dumps(spark, bronze_path, source, layout, max_files, keep_corrupt=True), source))
    return (
        rows.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
