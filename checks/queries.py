"""The check queries on Spark: each runs a part of the library over a whole supplied table."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from checks import bridge
from hazelake.dictionaries import DAILY_SOURCE, DEFAULT_UNITS, PLACE_STATES, POLLUTANT_ALIASES, SOURCES, STATION_SOURCE
from hazelake.functions.naming import (
    canonical_pollutant,
    canonical_state,
    canonical_unit,
    state_from_place,
)
from hazelake.functions.readings import label_by_limits, number
from hazelake.functions.text import lookup
from hazelake.operators.rows import (
    one_per_reading,
    rejected_daily_rows,
    trailing_range,
    valid_rows,
)
from hazelake.operators.shapes import daily_rows, station_rows_outer
from hazelake.operators.standardize import (
    with_pollutant_and_unit,
    with_risk,
    with_state,
    with_time_columns,
)
from hazelake.operators.tables import with_names, with_place_state
from hazelake.plans import jobs, summaries
from hazelake.plans.refresh import (
    RANK_ERROR,
    partial_sums,
    quantiles_of,
    read_summaries,
    refresh_summaries,
    state_monthly_of,
)
from hazelake.plans.silver import clean, clean_all, clean_daily, clean_rows, clean_stations
from hazelake.schemas import DAILY_BRONZE
from hazelake.sources.bronze import (
    INDENTED,
    LINES,
    land_snapshot,
    latest_snapshot,
    read_bronze,
    read_json,
)
from hazelake.sources.history import as_json, further_fields, newest_of_many, read_dumps, read_open
from hazelake.sources.landing import (
    complete_pages,
    flatten_pages,
    parse_pages,
    readable_pages,
    rejected_pages,
    tag_request_key,
)
from hazelake.sources.paths import child, shared_folder
from hazelake.sources.silver import merge_silver, read_silver, write_partitioned, write_silver
from hazelake.streaming.dedupe import append_stream, appended_readings, open_readings
from hazelake.streaming.landing import land, rejected_responses
from hazelake.streaming.runs import follow_runs, followed_pages
from hazelake.streaming.snapshots import ingest_stream, stream_dumps

#: Ids of events in a row that make one array of ``indented_roundtrip``, so that files grow in number, not in size.
EVENTS_PER_FILE = 10_000

_FIRST, _SECOND = datetime(2024, 2, 1), datetime(2024, 2, 2)


def _event(spark: SparkSession, sf_dir: str, *columns: Column | str) -> DataFrame:
    return bridge.texts(spark, sf_dir).select("event_id", *columns)


def pollutant_canonical(spark, sf_dir):
    return _event(spark, sf_dir, canonical_pollutant(F.col("pollutant")).alias("pollutant"))


def unit_canonical(spark, sf_dir):
    unit = canonical_unit(F.col("unit"), F.col("pollutant"))
    return _event(spark, sf_dir, unit.alias("unit"))


def pollutant_and_unit(spark, sf_dir):
    raw = _event(spark, sf_dir, F.col("pollutant").alias("raw_name"), F.col("unit").alias("raw_unit"))
    named = with_pollutant_and_unit(raw, pollutant_col="raw_name", unit_col="raw_unit")
    return named.select("event_id", "pollutant", "unit")


def unit_defaults(spark, sf_dir):
    unit = lookup(DEFAULT_UNITS, canonical_pollutant(F.col("pollutant")))
    return _event(spark, sf_dir, unit.alias("unit"))


def state_canonical(spark, sf_dir):
    return _event(spark, sf_dir, canonical_state(F.col("state")).alias("state"))


def state_from_place_name(spark, sf_dir):
    return _event(spark, sf_dir, state_from_place(F.col("location_name")).alias("state"))


def state_column(spark, sf_dir):
    return with_state(_event(spark, sf_dir, "state", "location_name")).select("event_id", "state")


def time_columns(spark, sf_dir):
    return with_time_columns(_event(spark, sf_dir, "date"), "date").drop("date")


def risk_category(spark, sf_dir):
    return with_risk(
        _event(
            spark,
            sf_dir,
            canonical_pollutant(F.col("pollutant")).alias("pollutant"),
            number(F.col("concentration")).alias("reading_value"),
        )
    )


def threshold_label(spark, sf_dir):
    label = label_by_limits(F.col("value"), [5, 20, 50, 100, 200])
    return bridge.events(spark, sf_dir).select("event_id", label.alias("label"))


def dedupe_readings(spark, sf_dir):
    timed = with_time_columns(bridge.texts(spark, sf_dir), "date")
    return one_per_reading(
        timed.select(
            F.col("event_type").alias("source"),
            (F.col("k") % 3).cast("string").alias("source_location_id"),
            "location_name",
            "pollutant",
            "observed_at",
            "unit",
            number(F.col("concentration")).alias("reading_value"),
        )
    )


def valid(spark, sf_dir):
    timed = with_time_columns(_event(spark, sf_dir, "pollutant", "date"), "date")
    return valid_rows(timed).select("event_id", "pollutant", "observed_date")


def rejected(spark, sf_dir):
    rows = rejected_daily_rows(bridge.daily(spark, sf_dir))
    # Doubles print differently in different engines, so only an unreadable value is shown.
    unreadable = F.when(F.col("concentration") == "n/a", F.col("concentration"))
    return rows.withColumn("concentration", unreadable).drop("raw")


def daily_projection(spark, sf_dir):
    return daily_rows(bridge.daily(spark, sf_dir))


def daily_silver(spark, sf_dir):
    return clean_daily(bridge.daily(spark, sf_dir))


def _raw_table(spark, sf_dir) -> DataFrame:
    """Rows in the common raw layout."""
    return bridge.raw_rows(spark, sf_dir)


def shared_clean(spark, sf_dir):
    return clean_rows(_raw_table(spark, sf_dir), "timestamp")


def _station_dump(spark, sf_dir) -> DataFrame:
    """Station documents as they arrive: from a dump, whose lines spread over the cores."""
    base = shared_folder(spark, "bronze")
    dump = land_snapshot(bridge.stations(spark, sf_dir), base, STATION_SOURCE, _FIRST)
    return read_bronze(spark, dump, STATION_SOURCE, LINES)


def station_exploded(spark, sf_dir):
    return station_rows_outer(_station_dump(spark, sf_dir))


def station_silver(spark, sf_dir):
    return clean_stations(_station_dump(spark, sf_dir))


def both_sources(spark, sf_dir):
    return clean_all(bridge.daily(spark, sf_dir), _station_dump(spark, sf_dir))


def ordered_readings(spark, sf_dir):
    return daily_silver(spark, sf_dir).orderBy("observed_at", "pollutant")


def _stored(spark, sf_dir) -> str:
    path = shared_folder(spark, "silver")
    write_silver(shared_clean(spark, sf_dir), path)
    return path


def silver_roundtrip(spark, sf_dir):
    return read_silver(spark, _stored(spark, sf_dir))


def silver_day_range(spark, sf_dir):
    path = _stored(spark, sf_dir)
    return read_silver(spark, path, since=date(2024, 1, 8), until=date(2024, 1, 15))


def overwrite_two_sources(spark, sf_dir):
    path = shared_folder(spark, "silver")
    daily = bridge.daily(spark, sf_dir)
    write_silver(clean(daily, DAILY_SOURCE), path)
    write_silver(clean(_station_dump(spark, sf_dir), STATION_SOURCE), path)
    later = daily.withColumn("concentration", number(F.col("concentration")) + 1)
    write_silver(clean(later, DAILY_SOURCE), path)
    return read_silver(spark, path)


def merge(spark, sf_dir):
    path = shared_folder(spark, "silver")
    rows = _raw_table(spark, sf_dir)
    early = F.col("longitude") < 4
    write_silver(clean_rows(rows.filter(early), "timestamp"), path)
    merge_silver(clean_rows(rows.filter(~early), "timestamp"), path)
    merge_silver(clean_rows(rows.filter(early), "timestamp"), path)
    return read_silver(spark, path)


def partitioned_write(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = shared_folder(spark, "orders")
    write_partitioned(orders, path, ["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path).select(*orders.columns)


def json_roundtrip(spark, sf_dir):
    rows = bridge.dump_rows(spark, sf_dir).select("date", "pollutant", "concentration")
    base = shared_folder(spark, "bronze")
    return read_bronze(spark, land_snapshot(rows, base, DAILY_SOURCE, _FIRST), DAILY_SOURCE)


def newest_snapshot(spark, sf_dir):
    base = shared_folder(spark, "bronze")
    rows = bridge.texts(spark, sf_dir)
    for taken_at, step in ((_FIRST, 0), (_SECOND, 1)):
        dump = rows.select("date", "pollutant", (F.col("event_id") + step).alias("concentration"))
        land_snapshot(dump, base, DAILY_SOURCE, taken_at)
    newest = latest_snapshot(spark, base, DAILY_SOURCE)
    return read_bronze(spark, newest.path, DAILY_SOURCE, newest.layout)


def page_flatten(spark, sf_dir):
    pages = bridge.page_bodies(spark, sf_dir)
    return flatten_pages(parse_pages(pages)).select("date", "pollutant", "concentration")


def _with_broken_pages(spark, sf_dir) -> DataFrame:
    """Pages of which some were cut off while they landed."""
    cut = F.when(F.col("body").startswith("["), F.expr("left(body, length(body) - 5)")).otherwise(F.lit('{"data": ['))
    broken = F.col("offset") % 50 == 3
    return bridge.page_bodies(spark, sf_dir).withColumn("body", F.when(broken, cut).otherwise(F.col("body")))


def page_rejects(spark, sf_dir):
    return rejected_pages(_with_broken_pages(spark, sf_dir)).select("run", "offset")


def page_readable(spark, sf_dir):
    pages = _with_broken_pages(spark, sf_dir)
    kept = flatten_pages(parse_pages(readable_pages(pages.withColumn("run", F.col("offset") % 100))))
    return kept.select("date", "pollutant", "concentration")


def indented_roundtrip(spark, sf_dir):
    """All events as arrays indented by two, the form in which dumps of a single file arrive."""
    rows = bridge.dump_rows(spark, sf_dir)
    fields = F.to_json(
        F.struct(*(F.coalesce(name, F.lit("-")).alias(name) for name in ("date", "pollutant", "concentration"))),
        {"pretty": "true"},
    )
    record = F.regexp_replace(F.concat(F.lit("\n"), fields), "\n", "\n  ")
    part = F.floor(F.col("event_id") / EVENTS_PER_FILE)
    arrays = rows.groupBy(part.alias("part")).agg(F.collect_list(record).alias("records"))
    text = F.concat(F.lit("["), F.array_join("records", ","), F.lit("\n]"))
    path = shared_folder(spark, "indented")
    arrays.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_json(spark, path, DAILY_BRONZE, INDENTED)


def observed_count(spark, sf_dir):
    """The count that the write itself observes."""
    rows = write_silver(shared_clean(spark, sf_dir), shared_folder(spark, "silver"))
    return spark.range(1).select(F.lit(rows).cast("long").alias("readings"))


def optional_columns(spark, sf_dir):
    """Frames that lack the columns which may be missing."""
    named = with_pollutant_and_unit(_event(spark, sf_dir, "pollutant", "location_name"))
    return with_state(named).select("event_id", "unit", "state")


def page_complete(spark, sf_dir):
    pages = complete_pages(bridge.sized_pages(spark, sf_dir), ["run"], limit=20)
    return pages.select("run", "offset", F.size("data").alias("size"))


def key_tagging(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    docs = pages.select("url", "page_id", F.length("html").alias("chars"))
    key = F.regexp_extract("url", "/([0-9]+)", 1)
    return tag_request_key(docs, key).select("location_id", "page_id", "chars")


def trailing(spark, sf_dir):
    rows = bridge.events(spark, sf_dir).select(
        "event_id", F.col("ts").cast("timestamp").alias("observed_at")
    )
    return trailing_range(rows, datetime(2024, 1, 15, 12), months_back=1)


def reading_count(spark, sf_dir):
    return shared_clean(spark, sf_dir).agg(F.count(F.lit(1)).alias("readings"))


def _landed(spark, sf_dir) -> str:
    """Both sources landed as dumps."""
    base = shared_folder(spark, "bronze")
    land_snapshot(bridge.daily(spark, sf_dir), base, DAILY_SOURCE, _FIRST)
    land_snapshot(bridge.stations(spark, sf_dir), base, STATION_SOURCE, _FIRST)
    return base


def ingest_job(spark, sf_dir):
    base = shared_folder(spark, "bronze")
    dump = land_snapshot(bridge.daily(spark, sf_dir), base, DAILY_SOURCE, _FIRST)
    report = jobs.ingest(spark, dump, shared_folder(spark, "silver"), DAILY_SOURCE)
    return report.readings(spark)


def full_run(spark, sf_dir):
    reports = jobs.run(spark, _landed(spark, sf_dir), shared_folder(spark, "silver"))
    assert [report.source for report in reports] == list(SOURCES)
    return reports[-1].readings(spark)


def stream_ingest(spark, sf_dir):
    base, silver = shared_folder(spark, "bronze"), shared_folder(spark, "silver")
    land_snapshot(bridge.daily(spark, sf_dir), base, DAILY_SOURCE, _FIRST)
    dumps = child(base, DAILY_SOURCE, "*.json")
    query = ingest_stream(spark, dumps, silver, DAILY_SOURCE, shared_folder(spark, "progress"))
    query.awaitTermination()
    return read_silver(spark, child(silver, jobs.DATASET))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 9) for name in names})


def state_monthly(spark, sf_dir):
    return _rounded(summaries.state_monthly(shared_clean(spark, sf_dir)), "mean_value")


def risk_summary(spark, sf_dir):
    return _rounded(summaries.risk_summary(shared_clean(spark, sf_dir)), "share")


def haze_trend(spark, sf_dir):
    trend = summaries.haze_trend(shared_clean(spark, sf_dir))
    return _rounded(trend, "daily_mean", "trailing_mean", "change")


def state_mean_pm25(spark, sf_dir):
    return _rounded(summaries.state_mean_pm25(shared_clean(spark, sf_dir)), "mean_pm25")


def document_roundtrip(spark, sf_dir):
    """All events as documents of many records on a single line each, found to be documents file by file."""
    rows = bridge.dump_rows(spark, sf_dir)
    part = F.floor(F.col("event_id") / EVENTS_PER_FILE)
    record = F.struct("date", "pollutant", "concentration")
    arrays = rows.groupBy(part.alias("part")).agg(F.to_json(F.collect_list(record)).alias("value"))
    path = shared_folder(spark, "documents")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_json(spark, path, DAILY_BRONZE)


def land_daily(spark, sf_dir):
    landing, base = shared_folder(spark, "landing"), shared_folder(spark, "bronze")
    bridge.landed_pages(spark, sf_dir, landing)
    land(spark, landing, base, DAILY_SOURCE, shared_folder(spark, "progress"), bridge.PAGE_EVENTS, bundled=True).awaitTermination()
    return read_bronze(spark, latest_snapshot(spark, base, DAILY_SOURCE).path, DAILY_SOURCE)


def rejected_pages_text(spark, sf_dir):
    landing, base = shared_folder(spark, "landing"), shared_folder(spark, "bronze")
    bridge.landed_pages(spark, sf_dir, landing)
    land(spark, landing, base, DAILY_SOURCE, shared_folder(spark, "progress"), bridge.PAGE_EVENTS, bundled=True).awaitTermination()
    rejects = rejected_responses(spark, base, DAILY_SOURCE)
    return rejects.withColumn("raw", F.rtrim("raw", F.lit("\n")))


def land_stations(spark, sf_dir):
    landing, base = shared_folder(spark, "landing"), shared_folder(spark, "bronze")
    bridge.landed_documents(spark, sf_dir, landing)
    land(spark, landing, base, STATION_SOURCE, shared_folder(spark, "progress"), bundled=True).awaitTermination()
    dump = latest_snapshot(spark, base, STATION_SOURCE)
    return station_rows_outer(read_bronze(spark, dump.path, STATION_SOURCE, dump.layout))


def rejected_stations(spark, sf_dir):
    base, rejects = shared_folder(spark, "bronze"), shared_folder(spark, "rejects")
    dump = land_snapshot(bridge.stations(spark, sf_dir), base, STATION_SOURCE, _FIRST)
    jobs.ingest(spark, dump, shared_folder(spark, "silver"), STATION_SOURCE, rejects=rejects)
    kept = station_rows_outer(bridge.stations(spark, sf_dir).limit(0)).schema
    layout = StructType([*kept.fields, StructField("reason", StringType())])
    return spark.read.schema(layout).parquet(child(rejects, STATION_SOURCE, "*", "taken=false"))


def accepted_stations(spark, sf_dir):
    """Silver rows of a dump that was parted from its rejects first."""
    base, rejects = shared_folder(spark, "bronze"), shared_folder(spark, "rejects")
    dump = land_snapshot(bridge.stations(spark, sf_dir), base, STATION_SOURCE, _FIRST)
    report = jobs.ingest(spark, dump, shared_folder(spark, "silver"), STATION_SOURCE, rejects=rejects)
    return report.readings(spark)


def stream_page_runs(spark, sf_dir):
    landed, base = shared_folder(spark, "pages"), shared_folder(spark, "runs")
    bridge.timed_pages(spark, sf_dir).write.parquet(landed)
    layout = "run string, offset long, size int, at timestamp"
    stored = spark.read.schema(layout).parquet(landed)
    stream = spark.readStream.schema(layout).parquet(landed)
    follow_runs(stream, stored, base, shared_folder(spark, "progress"), "20 days 12 hours 30 minutes", "5 days", 20).awaitTermination()
    return followed_pages(spark, base, layout).drop("at")


def stream_dedupe(spark, sf_dir):
    """All events three times: as they are, every other one again, and all of them two months later."""
    base, path, progress = shared_folder(spark, "bronze"), shared_folder(spark, "silver"), shared_folder(spark, "progress")
    early, late = bridge.texts(spark, sf_dir), bridge.texts(spark, sf_dir, days=60)
    for day, rows in enumerate((early, early.where("event_id % 2 = 0"), late), 1):
        land_snapshot(rows.select("date", "pollutant", "concentration"), base, DAILY_SOURCE, datetime(2024, 2, day))
    dumps = stream_dumps(spark, child(base, DAILY_SOURCE, "*.json"), DAILY_SOURCE, max_files=1)
    append_stream(dumps, path, DAILY_SOURCE, progress, "40 days").awaitTermination()
    return appended_readings(spark, path).unionByName(open_readings(spark, progress))


def newest_rows(spark, sf_dir):
    base, rows = shared_folder(spark, "bronze"), bridge.texts(spark, sf_dir)
    older = rows.select("date", "pollutant", (number(F.col("concentration")) + 1000).alias("concentration"))
    land_snapshot(older, base, DAILY_SOURCE, _FIRST)
    newer = rows.where("k % 2 = 0").select("date", "pollutant", "concentration")
    land_snapshot(newer, base, DAILY_SOURCE, _SECOND)
    return newest_of_many(read_dumps(spark, base, DAILY_SOURCE), DAILY_SOURCE)


def _open_dump(spark, sf_dir) -> DataFrame:
    path = shared_folder(spark, "open")
    bridge.further_lines(spark, sf_dir).select("value").write.text(path)
    return read_open(spark, path, DAILY_BRONZE)


def schema_drift(spark, sf_dir):
    return further_fields(_open_dump(spark, sf_dir))


def variant_fields(spark, sf_dir):
    rows = _open_dump(spark, sf_dir)
    return rows.select("date", "pollutant", "concentration", as_json(F.col("further")).alias("further"))


def alias_table(spark, sf_dir):
    aliases = spark.createDataFrame(list(POLLUTANT_ALIASES.items()), "alias string, name string")
    named = with_names(_event(spark, sf_dir, "pollutant"), "pollutant", aliases, "known")
    name = F.coalesce("known", F.upper(F.trim("pollutant")))
    return named.select("event_id", name.alias("pollutant"))


def place_hints_table(spark, sf_dir):
    hints = [(hint, state, rank) for rank, (hint, state) in enumerate(PLACE_STATES.items())]
    table = spark.createDataFrame(hints, "hint string, state string, rank int")
    return with_place_state(_event(spark, sf_dir, "location_name"), "location_name", table).select("event_id", "state")


def _refreshed(spark, sf_dir) -> str:
    """Partial sums of a dataset that was summed up, merged into, and brought in line."""
    silver, sums = shared_folder(spark, "silver"), shared_folder(spark, "sums")
    rows = _raw_table(spark, sf_dir)
    early = F.col("longitude") < 4
    write_silver(clean_rows(rows.filter(early), "timestamp"), silver)
    refresh_summaries(spark, silver, sums)
    merge_silver(clean_rows(rows.filter(~early), "timestamp"), silver)
    refresh_summaries(spark, silver, sums)
    return sums


def summary_refresh(spark, sf_dir):
    return _rounded(state_monthly_of(read_summaries(spark, _refreshed(spark, sf_dir))), "mean_value")


def pollutant_quantiles(spark, sf_dir):
    """Quantiles from the sketches of all days, and whether the values' exact ranks are within the stated error."""
    silver = shared_clean(spark, sf_dir)
    found = quantiles_of(partial_sums(silver), [0.1, 0.5, 0.9], "pollutant")
    known = silver.where("reading_value is not null").select(F.col("pollutant").alias("of"), "reading_value")
    ranked = found.join(known, F.col("pollutant") == F.col("of")).groupBy("pollutant", "rank", "readings").agg(
        (F.count_if(F.col("reading_value") < F.col("value")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("reading_value") <= F.col("value")) / F.count(F.lit(1))).alias("through"),
    )
    error = 2 * RANK_ERROR
    near = (F.col("below") - error <= F.col("rank")) & (F.col("through") + error >= F.col("rank"))
    return ranked.select("pollutant", "rank", "readings", near.alias("within"))


QUERIES = {
    "document_roundtrip": document_roundtrip,
    "land_daily": land_daily,
    "land_stations": land_stations,
    "rejected_pages_text": rejected_pages_text,
    "rejected_stations": rejected_stations,
    "accepted_stations": accepted_stations,
    "stream_page_runs": stream_page_runs,
    "stream_dedupe": stream_dedupe,
    "newest_of_many": newest_rows,
    "schema_drift": schema_drift,
    "variant_fields": variant_fields,
    "alias_table": alias_table,
    "place_hints_table": place_hints_table,
    "summary_refresh": summary_refresh,
    "pollutant_quantiles": pollutant_quantiles,
    "pollutant_canonical": pollutant_canonical,
    "unit_canonical": unit_canonical,
    "pollutant_and_unit": pollutant_and_unit,
    "unit_defaults": unit_defaults,
    "state_canonical": state_canonical,
    "state_from_place": state_from_place_name,
    "state_column": state_column,
    "time_columns": time_columns,
    "risk_category": risk_category,
    "threshold_label": threshold_label,
    "dedupe_readings": dedupe_readings,
    "valid_rows": valid,
    "rejected_rows": rejected,
    "daily_rows": daily_projection,
    "daily_silver": daily_silver,
    "shared_clean": shared_clean,
    "station_exploded": station_exploded,
    "station_silver": station_silver,
    "both_sources": both_sources,
    "ordered_readings": ordered_readings,
    "silver_roundtrip": silver_roundtrip,
    "silver_day_range": silver_day_range,
    "overwrite_two_sources": overwrite_two_sources,
    "merge_silver": merge,
    "partitioned_write": partitioned_write,
    "json_roundtrip": json_roundtrip,
    "latest_snapshot": newest_snapshot,
    "page_flatten": page_flatten,
    "page_complete": page_complete,
    "page_rejects": page_rejects,
    "page_readable": page_readable,
    "indented_roundtrip": indented_roundtrip,
    "observed_count": observed_count,
    "optional_columns": optional_columns,
    "key_tagging": key_tagging,
    "trailing_range": trailing,
    "reading_count": reading_count,
    "ingest_job": ingest_job,
    "full_run": full_run,
    "stream_ingest": stream_ingest,
    "state_monthly": state_monthly,
    "risk_summary": risk_summary,
    "haze_trend": haze_trend,
    "state_mean_pm25": state_mean_pm25,
}
