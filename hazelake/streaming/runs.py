"""Page runs that end while pages still arrive."""

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazelake.dictionaries import PAGE_LIMIT
from hazelake.operators.rejects import AFTER_END, part
from hazelake.sources.paths import child, clear_folder, exists

_VISITS = "run string, first_at timestamp, last_at timestamp, until timestamp, end long, pages long"
_CLOSED = "run string, first_at timestamp, last_at timestamp, end long, pages long"


def run_ends(pages: DataFrame, limit: int, silence: str) -> DataFrame:
    """``run, first_at, last_at, until, end, pages`` of each visit in ``run, offset, size, at``.

    A visit of a run goes on until no page of it has come for ``silence``. ``end`` is the offset of its first page that
    is shorter than ``limit``, null if it has none.
    """
    short = F.min(F.when(F.col("size") < limit, F.col("offset")))
    visits = pages.groupBy("run", F.session_window("at", silence).alias("visit"))
    found = visits.agg(F.max("at").alias("last_at"), short.alias("end"), F.count(F.lit(1)).alias("pages"))
    return found.select(
        "run", F.col("visit.start").alias("first_at"), "last_at", F.col("visit.end").alias("until"), "end", "pages"
    )


def joined_visits(visits: DataFrame) -> DataFrame:
    """Visits of a run of which one begins before the other is over are one visit."""
    order = Window.partitionBy("run").orderBy("first_at", "until")
    before = F.max("until").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = visits.withColumn("apart", F.when(F.col("first_at") > before, 1).otherwise(0))
    numbered = apart.withColumn("number", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("run", "number").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.max("until").alias("until"),
        F.min("end").alias("end"), F.sum("pages").alias("pages"),
    ).drop("number")


def _passed(visits: DataFrame, lateness: str) -> int | None:
    """The watermark in microseconds: ``lateness`` before the newest page, None as long as there is none.

    The visit of the newest page is always open, so the open visits tell.
    """
    newest = F.date_trunc("millisecond", F.max("last_at"))
    return visits.agg(F.unix_micros(newest - F.lit(lateness).cast("interval"))).first()[0]


def _ahead(until: Column, passed: int | None) -> Column:
    return F.lit(True) if passed is None else F.unix_micros(until) > passed


def _follow(
    batch: DataFrame, batch_id: int, stored: DataFrame, base: str, limit: int, silence: str, lateness: str
) -> None:
    """Join the pages of a batch to the open visits, and close those that the watermark has passed.

    The visits of a batch lie under its number, those that are open after it among them: they are the state. So a batch
    that is repeated finds what the one before it has left.
    """
    spark, log = batch.sparkSession, child(base, "visits")
    if batch_id:
        before = spark.read.schema(_VISITS).parquet(child(log, f"batch={batch_id - 1}"))
        passed = _passed(before, lateness)
        timely = batch.where(_ahead(F.col("at") + F.lit(silence).cast("interval"), passed))
        still = before.where(_ahead(F.col("until"), passed))
        visits = joined_visits(run_ends(timely, limit, silence).unionByName(still))
    else:
        visits = run_ends(batch, limit, silence)
    visits.write.mode("overwrite").parquet(child(log, f"batch={batch_id}"))
    visits = spark.read.schema(_VISITS).parquet(child(log, f"batch={batch_id}"))
    passed = _passed(visits, lateness)
    _close(visits.where(~_ahead(F.col("until"), passed)).drop("until"), batch_id, stored, base)
    if batch_id > 1:
        clear_folder(spark, child(log, f"batch={batch_id - 2}"), visits.schema)


def _close(closed: DataFrame, batch_id: int, stored: DataFrame, base: str) -> None:
    """Part the pages of the visits that are over: a run ends with its first visit, and there at its first short page."""
    spark, log = closed.sparkSession, child(base, "closed")
    closed.write.mode("overwrite").parquet(child(log, f"batch={batch_id}"))
    known = spark.read.schema(f"{_CLOSED}, batch long").parquet(log).where(F.col("batch") <= batch_id)
    first = known.groupBy("run").agg(F.min("first_at").alias("begun"))
    visits = known.where(F.col("batch") == batch_id).alias("v").join(
        first.alias("f"), F.col("v.run").eqNullSafe(F.col("f.run"))
    )
    visits = visits.select(
        F.col("v.run").alias("_run"), "first_at", "last_at", F.col("end").alias("_end"), (F.col("first_at") > F.col("begun")).alias("again")
    )
    of_visit = F.col("run").eqNullSafe(F.col("_run")) & F.col("at").between(F.col("first_at"), F.col("last_at"))
    behind = F.col("again") | (F.col("offset") > F.col("_end"))
    reason = F.when(F.coalesce(behind, F.lit(False)), AFTER_END)
    pages = stored.join(visits, of_visit).select(*stored.columns, reason.alias("reason"))
    part(pages, child(base, "pages", f"batch={batch_id}"))


def follow_runs(
    pages: DataFrame,
    stored: DataFrame,
    base: str,
    checkpoint: str,
    silence: str,
    lateness: str,
    limit: int = PAGE_LIMIT,
) -> StreamingQuery:
    """Take the pages of each run when it has ended, and reject those behind its end.

    ``pages`` is a stream of ``run, offset, size, at``, ``stored`` the same pages as they lie in storage, with their data.
    A run ends at its first short page, or, without one, when no page of it has come for ``silence``. Pages of a run
    that come after that are rejects, whenever they come. ``lateness`` is how far pages may come out of order; a visit is
    closed by the batch whose newest page is that far ahead of its end. Under ``base`` lie ``visits``, the open ones after
    the last two batches, ``closed``, the others by batch, and ``pages``, parted by ``taken``; a batch that is repeated
    after a failure replaces its own folders. Open visits are rows of a table, one small row each, and never held in memory.
    """
    follow = partial(_follow, stored=stored, base=base, limit=limit, silence=silence, lateness=lateness)

    def follow_batch(batch: DataFrame, batch_id: int) -> None:
        follow(batch, batch_id)

    return (
        pages.writeStream.foreachBatch(follow_batch)
        .outputMode("append")
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def followed_pages(spark: SparkSession, base: str, layout: str) -> DataFrame:
    """Pages of ended runs with ``reason``, null for those that were taken; ``layout`` names the columns of the pages."""
    folder = child(base, "pages")
    schema = f"{layout}, reason string, batch long, taken boolean"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema).drop("batch", "taken")
    return spark.read.schema(schema).parquet(folder).drop("batch", "taken")
