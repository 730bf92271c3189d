"""``python -m hazelake``: land responses as dumps, and ingest the newest dumps or all that are new."""

import argparse
import logging
import sys

from hazelake.dictionaries import SNAPSHOT_GLOBS, SOURCES
from hazelake.plans.jobs import run
from hazelake.plans.session import create_session, size_shuffles
from hazelake.sources.bronze import latest_snapshot
from hazelake.sources.paths import child
from hazelake.streaming.snapshots import ingest_stream


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="hazelake", description="Ingest air-quality dumps")
    parser.add_argument("--bronze", required=True, help="folder with one folder per source")
    parser.add_argument("--silver", required=True, help="folder of the silver dataset")
    parser.add_argument("--source", choices=["all", *SOURCES], default="all")
    parser.add_argument("--merge", action="store_true", help="add to partitions, do not replace them")
    parser.add_argument("--landing", help="folder with the responses of each source, landed as dumps first")
    parser.add_argument("--rejects", help="folder for what does not reach silver")
    parser.add_argument("--stream", action="store_true", help="ingest all new dumps, not only the newest")
    parser.add_argument("--skip-extract", action="store_true", help="take the dumps there are, land nothing")
    parser.add_argument("--skip-ingest", action="store_true", help="land responses only")
    parser.add_argument("--dry-run", action="store_true", help="only log what would run")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    if args.dry_run:
        run(None, args.bronze, args.silver, args.source, args.skip_ingest, True, skip_extract=args.skip_extract)
        return 0
    spark = create_session()
    try:
        _run(spark, args)
    except Exception:
        logging.exception("Ingest failed")
        return 1
    finally:
        spark.stop()
    return 0


def _run(spark, args) -> None:
    sources = SOURCES if args.source == "all" else (args.source,)
    only_land = args.stream or args.skip_ingest
    if args.landing and not args.skip_extract or only_land:
        run(spark, args.bronze, args.silver, args.source, skip_ingest=True, landing=args.landing, skip_extract=args.skip_extract)
    if args.skip_ingest:
        return
    if args.stream:
        for source in sources:
            dumps = child(args.bronze, source, SNAPSHOT_GLOBS[source])
            progress = child(args.bronze, "_progress", f"{source}_ingest")
            ingest_stream(spark, dumps, args.silver, source, progress, rejects=args.rejects).awaitTermination()
        return
    size_shuffles(spark, max(latest_snapshot(spark, args.bronze, source).size for source in sources))
    run(spark, args.bronze, args.silver, args.source, merge=args.merge, rejects=args.rejects)


if __name__ == "__main__":
    sys.exit(main())
