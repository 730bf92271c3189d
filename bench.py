"""Times the headline jobs and prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local cores. The bronze inputs
are landed from the tables first, untimed, since the tables hold no air-quality data. Every job then runs
once to warm up and ``BENCH_RUNS`` times more; the fastest run counts. Beside the seconds stand the megabytes that one run of
a job shuffles, from Spark's event log, and the files that the written datasets have.
"""

import glob
import json
import os
import tempfile
import time
from collections import Counter
from datetime import datetime

from pyspark.sql import SparkSession

from checks import bridge
from hazelake import (
    clean_all,
    clean_daily,
    clean_rows,
    clean_stations,
    ingest,
    land_snapshot,
    latest_snapshot,
    merge_silver,
    one_per_reading,
    read_bronze,
    read_silver,
    run,
    write_silver,
)
from hazelake.dictionaries import DAILY_SOURCE, STATION_SOURCE
from hazelake.plans import summaries
from hazelake.plans.refresh import read_summaries, refresh_summaries
from hazelake.sources.landing import complete_pages, flatten_pages, parse_pages
from hazelake.sources.paths import shared_folder

LANDED_AT = datetime(2024, 2, 1)
RAW_IDENTITY = ("source", "source_location_id", "location_name", "pollutant", "timestamp")


def jobs(spark: SparkSession, sf_dir: str, base: str) -> dict:
    """Name → function that runs the job, or returns a frame to run."""
    bronze, silver = f"{base}/bronze", f"{base}/silver"
    dumps = {
        DAILY_SOURCE: land_snapshot(bridge.daily(spark, sf_dir), bronze, DAILY_SOURCE, LANDED_AT),
        STATION_SOURCE: land_snapshot(bridge.stations(spark, sf_dir), bronze, STATION_SOURCE, LANDED_AT),
    }
    bridge.raw_rows(spark, sf_dir).write.parquet(f"{base}/raw")
    bridge.page_bodies(spark, sf_dir).write.parquet(f"{base}/pages")
    raw, pages = spark.read.parquet(f"{base}/raw"), spark.read.parquet(f"{base}/pages")
    clean_rows(raw, "timestamp").write.parquet(f"{base}/readings")
    readings = spark.read.parquet(f"{base}/readings")
    write_silver(readings, f"{base}/merged")

    def dump(source):
        return read_bronze(spark, dumps[source], source)

    def roundtrip():
        write_silver(clean_rows(raw, "timestamp"), f"{base}/roundtrip")
        return read_silver(spark, f"{base}/roundtrip")

    def refreshed():
        """One day is merged into, and its sums are brought in line."""
        merge_silver(readings.where("day = 5"), f"{base}/merged")
        refresh_summaries(spark, f"{base}/merged", f"{base}/sums")
        return f"{base}/sums"

    return {
        "daily_silver": lambda: clean_daily(dump(DAILY_SOURCE)),
        "station_silver": lambda: clean_stations(dump(STATION_SOURCE)),
        "both_sources": lambda: clean_all(dump(DAILY_SOURCE), dump(STATION_SOURCE)),
        "shared_clean": lambda: clean_rows(raw, "timestamp"),
        "dedupe_readings": lambda: one_per_reading(raw, RAW_IDENTITY),
        "silver_roundtrip": roundtrip,
        "merge_silver": lambda: merge_silver(readings, f"{base}/merged"),
        "ingest_job": lambda: ingest(spark, dumps[DAILY_SOURCE], silver, DAILY_SOURCE),
        "full_run": lambda: run(spark, bronze, silver),
        "latest_snapshot": lambda: latest_snapshot(spark, bronze, DAILY_SOURCE),
        "page_flatten": lambda: flatten_pages(complete_pages(parse_pages(pages), limit=0)),
        "rejects_job": lambda: ingest(spark, dumps[STATION_SOURCE], silver, STATION_SOURCE, rejects=f"{base}/rejects"),
        "summary_refresh": lambda: read_summaries(spark, refreshed()),
        "state_monthly": lambda: summaries.state_monthly(readings),
        "risk_summary": lambda: summaries.risk_summary(readings),
        "haze_trend": lambda: summaries.haze_trend(readings),
        "state_mean_pm25": lambda: summaries.state_mean_pm25(readings),
    }


def shuffled(log_folder: str, runs: int) -> dict[str, float]:
    """Megabytes written to shuffles by one run of each job, by the job group of its stages."""
    stages, written = {}, Counter()
    for path in glob.glob(f"{log_folder}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                event = json.loads(line)
                if event["Event"] == "SparkListenerJobStart":
                    group = event.get("Properties", {}).get("spark.jobGroup.id")
                    stages.update(dict.fromkeys(event["Stage IDs"], group))
                elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                    size = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                    written[stages.get(event["Stage ID"])] += size
    return {name: round(size / runs / 1e6, 2) for name, size in written.items() if name}


def files_below(path: str) -> int:
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)


def timed(job) -> float:
    start = time.perf_counter()
    result = job()
    if hasattr(result, "write"):
        result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES")
    log_folder = tempfile.mkdtemp(prefix="hazelake-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file://{log_folder}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = shared_folder(spark, "bench")
    known = jobs(spark, sf_dir, base)
    seconds = {}
    for name in wanted.split(",") if wanted else known:
        spark.sparkContext.setJobGroup(name, name)
        seconds[name] = round(min(timed(known[name]) for _ in range(runs + 1)), 3)
    files = {name: files_below(f"{base}/{name}") for name in ("roundtrip", "merged", "silver", "sums")}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "shuffle_mb": shuffled(log_folder, runs + 1),
                "files": files,
            }
        )
    )


if __name__ == "__main__":
    main()
