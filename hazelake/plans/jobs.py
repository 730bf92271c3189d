"""End-to-end jobs from a bronze dump to the silver dataset."""

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from hazelake.dictionaries import SOURCES
from hazelake.operators.rejects import judged, part
from hazelake.plans.silver import clean, clean_accepted, require_source
from hazelake.sources.bronze import Snapshot, latest_snapshot, read_bronze, snapshot_at
from hazelake.sources.paths import child, clear_folder
from hazelake.sources.silver import DATASET, merge_silver, read_silver, write_silver
from hazelake.streaming.landing import land

logger = logging.getLogger(__name__)


class IngestReport(NamedTuple):
    """What one ingest read and wrote."""

    source: str
    bronze_path: str
    silver_path: str
    rows: int
    #: Raw rows by the reason why they did not reach silver, where rejects were asked for.
    rejected: dict[str, int] = {}
    #: Raw rows that were accepted; repeated readings among them are one row of silver.
    accepted: int | None = None

    def readings(self, spark: SparkSession) -> DataFrame:
        """The dataset as it is now, both sources included."""
        return read_silver(spark, self.silver_path)


def ingest(
    spark: SparkSession,
    bronze: str | Snapshot,
    silver_base: str,
    source: str,
    mode: str = "overwrite",
    merge: bool = False,
    rejects: str | None = None,
) -> IngestReport:
    """Clean one dump and write it to ``<silver_base>/air_quality``.

    By default the dump replaces the day and source partitions it holds rows for. With ``merge`` its
    rows are added to those partitions. With a folder for ``rejects`` the dump is parted in one pass, and what does not
    reach silver lies in ``<rejects>/<source>/<name of the dump>`` with the reason and the text of unreadable lines.
    """
    require_source(source)
    snapshot = bronze if isinstance(bronze, Snapshot) else snapshot_at(spark, bronze)
    silver_path = child(silver_base, DATASET)
    if rejects is None:
        rows = clean(read_bronze(spark, snapshot.path, source, snapshot.layout), source)
        written = _store(rows, silver_path, mode, merge)
        report = IngestReport(source, snapshot.path, silver_path, written)
    else:
        raw = read_bronze(spark, snapshot.path, source, snapshot.layout, keep_corrupt=True)
        folder = child(rejects, source, snapshot.path.rstrip("/").rsplit("/", 1)[-1])
        parted = part(judged(raw, source), folder)
        written = _store(clean_accepted(parted.accepted, source), silver_path, mode, merge)
        clear_folder(spark, child(folder, "taken=true"), parted.rejected.schema)
        report = IngestReport(source, snapshot.path, silver_path, written, parted.rejected_by_reason, parted.taken)
    logger.info("Wrote %s rows of %s from %s to %s; rejected %s", written, source, snapshot.path, silver_path, report.rejected)
    return report


def _store(rows: DataFrame, path: str, mode: str, merge: bool) -> int:
    return merge_silver(rows, path) if merge else write_silver(rows, path, mode)


def ingest_latest(
    spark: SparkSession,
    source: str,
    bronze_base: str,
    silver_base: str,
    mode: str = "overwrite",
    merge: bool = False,
    rejects: str | None = None,
) -> IngestReport:
    """Clean the newest dump of a source; a source without a dump is a FileNotFoundError."""
    snapshot = latest_snapshot(spark, bronze_base, source)
    return ingest(spark, snapshot, silver_base, source, mode, merge, rejects)


def run(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    source: str = "all",
    skip_ingest: bool = False,
    dry_run: bool = False,
    merge: bool = False,
    landing: str | None = None,
    skip_extract: bool = False,
    rejects: str | None = None,
) -> list[IngestReport]:
    """Land the responses of one source or of all as dumps, then ingest the newest dump of each.

    Responses lie in ``<landing>/<source>``; without a landing folder, or with ``skip_extract``, dumps are taken as they
    are. Landing remembers in ``<bronze_base>/_progress`` what it has read. A dry run only logs. Each source has its own
    partitions, so the order does not matter and a failed run can simply be repeated.
    """
    sources = SOURCES if source == "all" else (require_source(source),)
    if dry_run:
        logger.info("Dry run: sources=%s skip_extract=%s skip_ingest=%s", ",".join(sources), skip_extract, skip_ingest)
        return []
    if landing and not skip_extract:
        for name in sources:
            query = land(spark, child(landing, name), bronze_base, name, child(bronze_base, "_progress", name))
            query.awaitTermination()
    if skip_ingest:
        logger.info("Nothing ingested: sources=%s", ",".join(sources))
        return []
    return [
        ingest_latest(spark, name, bronze_base, silver_base, merge=merge, rejects=rejects) for name in sources
    ]
