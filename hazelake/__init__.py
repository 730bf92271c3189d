"""Air-quality readings on Spark: cleaning, partitioned storage and summaries."""

from hazelake.operators.rejects import judged, part
from hazelake.operators.rows import (
    one_per_reading,
    rejected_daily_rows,
    trailing_range,
    valid_rows,
)
from hazelake.operators.standardize import (
    with_pollutant_and_unit,
    with_risk,
    with_state,
    with_time_columns,
)
from hazelake.operators.tables import with_names, with_place_state
from hazelake.plans.jobs import ingest, ingest_latest, run
from hazelake.plans.refresh import read_summaries, refresh_summaries
from hazelake.plans.session import create_session, size_shuffles
from hazelake.plans.silver import clean, clean_all, clean_daily, clean_rows, clean_stations
from hazelake.sources.bronze import land_snapshot, latest_snapshot, read_bronze, read_json
from hazelake.sources.history import newest_of_many, read_dumps, read_open
from hazelake.sources.silver import compact_silver, merge_silver, read_silver, write_partitioned, write_silver
from hazelake.streaming.dedupe import append_stream
from hazelake.streaming.landing import land
from hazelake.streaming.runs import follow_runs
from hazelake.streaming.snapshots import ingest_stream

__all__ = [
    "append_stream",
    "clean",
    "clean_all",
    "clean_daily",
    "clean_rows",
    "clean_stations",
    "compact_silver",
    "create_session",
    "follow_runs",
    "ingest",
    "ingest_latest",
    "ingest_stream",
    "judged",
    "land",
    "land_snapshot",
    "latest_snapshot",
    "merge_silver",
    "newest_of_many",
    "one_per_reading",
    "part",
    "read_bronze",
    "read_dumps",
    "read_json",
    "read_open",
    "read_silver",
    "read_summaries",
    "refresh_summaries",
    "rejected_daily_rows",
    "run",
    "size_shuffles",
    "trailing_range",
    "valid_rows",
    "with_names",
    "with_place_state",
    "with_pollutant_and_unit",
    "with_risk",
    "with_state",
    "with_time_columns",
    "write_partitioned",
    "write_silver",
]
