"""Bronze-shaped frames derived row by row from ``events``. No row is left out and none is grouped."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.texts import PLACES, POLLUTANTS, STATES, UNITS


def _pick(values: list, position: Column) -> Column:
    return F.array(*map(F.lit, values))[F.pmod(position, F.lit(len(values))).cast("int")]


def events(spark: SparkSession, sf_dir: str, days: int = 0) -> DataFrame:
    """The table, with the number inside ``props`` as ``k``; times are moved on by so many days."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    later = F.col("ts") + F.make_dt_interval(F.lit(days))
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumns({"k": k, "ts": later})


def texts(spark: SparkSession, sf_dir: str, days: int = 0) -> DataFrame:
    """One raw text of every kind per event, and the value brought into the pollutant's range."""
    names = [name for name, _ in POLLUTANTS]
    divisors = [float(divisor) for _, divisor in POLLUTANTS]
    event, k, ts = F.col("event_id"), F.col("k"), F.col("ts")
    kind = F.col("event_type")
    stamp = ts.cast("string")
    day = F.substring(stamp, 1, 10)
    hour = F.concat(day, F.lit("T"), F.substring(stamp, 12, 2), F.lit(":00:00"))
    date = (
        F.when(kind == "view", day)
        .when(kind == "click", F.concat(hour, F.lit("Z")))
        .when(kind == "signup", F.concat(hour, F.lit("+08:00")))
        .when(kind == "purchase", F.substring(stamp, 1, 19))
        .when(k < 30, F.lit("bad-date"))
        .when(k < 60, F.lit(None))
        .when(k < 80, F.substring(stamp, 12, 5))
        .otherwise(day)
    )
    value = F.col("value") / _pick(divisors, event)
    return events(spark, sf_dir, days).select(
        "event_id",
        "user_id",
        "event_type",
        "k",
        day.alias("day_text"),
        hour.alias("hour_text"),
        _pick(names, event).alias("pollutant"),
        _pick(names, k).alias("pollutant_2"),
        _pick(UNITS, k).alias("unit"),
        _pick(UNITS, event).alias("unit_2"),
        _pick(STATES, event + k).alias("state"),
        _pick(PLACES, k).alias("location_name"),
        date.alias("date"),
        F.when(k == 7, F.lit("n/a")).when(k != 13, value.cast("string")).alias("concentration"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat daily records."""
    return texts(spark, sf_dir).select("date", "pollutant", "concentration")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the common raw layout with every column filled."""
    k = F.col("k")
    return texts(spark, sf_dir).select(
        F.when(k < 50, F.lit("opendosm")).otherwise(F.lit("openaq")).alias("source"),
        (k % 3).cast("string").alias("source_location_id"),
        "location_name",
        "state",
        F.when(k % 5 != 0, F.lit("Malaysia")).alias("country"),
        (F.col("user_id") / 100.0).alias("latitude"),
        (k / 10.0).alias("longitude"),
        "pollutant",
        "unit",
        F.col("concentration").try_cast("double").alias("reading_value"),
        F.col("date").alias("timestamp"),
    )


def stations(spark: SparkSession, sf_dir: str, *further: str) -> DataFrame:
    """One nested station document per event, some without results, sensors or times, and further columns."""
    k, user, kind = F.col("k"), F.col("user_id"), F.col("event_type")
    last = (
        F.when((kind == "error") & (k < 20), F.lit(None))
        .when(kind == "view", F.col("day_text"))
        .when(kind != "click", F.concat("hour_text", F.lit("Z")))
    )
    first = F.when((kind != "error") | (k >= 20), F.col("day_text"))

    def sensor(name: str, unit: str) -> Column:
        return F.struct(F.struct(F.col(name).alias("name"), F.col(unit).alias("units")).alias("parameter"))

    both = F.array(sensor("pollutant", "unit"), sensor("pollutant_2", "unit_2"))
    sensors = (
        F.when((kind == "signup") & (k < 10), F.slice(both, 1, 0))
        .when((kind == "signup") & (k < 15), F.lit(None))
        .otherwise(both)
    )
    result = F.struct(
        (user + 1000).cast("string").alias("id"),
        F.col("location_name").alias("name"),
        F.col("state").alias("locality"),
        F.struct(F.when(k % 5 != 0, F.lit("Malaysia")).alias("name")).alias("country"),
        F.struct(
            (1 + user / 100.0).cast("string").alias("latitude"),
            F.when(k == 3, F.lit("x")).otherwise((k / 10.0).cast("string")).alias("longitude"),
        ).alias("coordinates"),
        F.struct(first.alias("utc")).alias("datetimeFirst"),
        F.struct(last.alias("utc")).alias("datetimeLast"),
        sensors.alias("sensors"),
    )
    one = F.array(result)
    results = F.when(k == 50, F.slice(one, 1, 0)).when(k != 51, one)
    location = F.when(k % 10 != 0, (user % 5).cast("string"))
    return texts(spark, sf_dir).select(location.alias("location_id"), results.alias("results"), *further)


def dump_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily records whose value is a whole number as text, which prints alike everywhere."""
    k = F.col("k")
    text = F.when(k == 7, F.lit("n/a")).when(k != 13, k.cast("string"))
    return texts(spark, sf_dir).withColumn("concentration", text)


def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed response per event, in each of the shapes a response can have."""
    kind = F.col("event_type")
    record = F.struct("date", "pollutant", "concentration")
    pair = F.array(record, record)
    body = (
        F.when(kind == "view", F.to_json(F.struct(pair.alias("data"))))
        .when(kind == "click", F.to_json(pair))
        .when(kind == "signup", F.to_json(record))
        .when(kind == "purchase", F.lit('{"data": []}'))
        .otherwise(F.lit("{}"))
    )
    return dump_rows(spark, sf_dir).select(
        F.col("day_text").alias("run"), F.col("event_id").alias("offset"), body.alias("body")
    )


#: Events of a landed page, and pages of a run.
PAGE_EVENTS, RUN_PAGES = 100, 20


def _page_number() -> Column:
    return F.floor(F.col("event_id") / PAGE_EVENTS)


def landed_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """All events as bundled responses ``run, offset, body``, a page of records each, in the shapes a response has.

    Of eleven pages one was cut off, and the last of each run but the longest is one record short.
    """
    page, record = _page_number(), F.struct("date", "pollutant", "concentration")
    last = F.col("event_id") % (PAGE_EVENTS * RUN_PAGES) == PAGE_EVENTS * (RUN_PAGES // 2) + 1
    rows = dump_rows(spark, sf_dir).where(~last).withColumn("page", page)
    pages = rows.groupBy("page").agg(F.collect_list(record).alias("data"))
    body = (
        F.when(F.col("page") % 11 == 3, F.lit('{"data": [{"date": "2024-'))
        .when(F.col("page") % 2 == 0, F.to_json(F.struct("data")))
        .otherwise(F.to_json("data"))
    )
    run = F.floor(F.col("page") / RUN_PAGES).cast("string")
    offset = F.col("page") % RUN_PAGES * PAGE_EVENTS
    pages.select(run.alias("run"), offset.alias("offset"), body.alias("body")).write.parquet(path)


def landed_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """All events as bundled station documents, an array of them in each response; of thirteen responses one was cut off."""
    rows = stations(spark, sf_dir, "event_id").withColumn("page", _page_number())
    pages = rows.groupBy("page").agg(F.collect_list(F.struct("location_id", "results")).alias("docs"))
    body = F.when(F.col("page") % 13 == 5, F.lit('[{"location_id": "1", "results": [')).otherwise(F.to_json("docs"))
    name = F.concat(F.lit("part-"), F.col("page"), F.lit(".txt"))
    pages.select(name.alias("path"), body.alias("body")).write.parquet(path)


def further_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily records as JSON lines that hold fields beyond the contract."""
    kind = F.col("event_type")
    # In a struct that is written as JSON, null fields are left out.
    record = F.struct(
        "date", "pollutant", "concentration", F.col("k").alias("batch"),
        F.when(kind == "click", F.struct(F.col("user_id").alias("id"))).alias("user"),
        F.when(kind == "view", F.lit("x")).alias("note"),
    )
    return dump_rows(spark, sf_dir).select("event_id", F.to_json(record).alias("value"))


def timed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per line item: a run per order, of which pages come for months."""
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").cast("string").alias("run"),
        (F.col("l_linenumber") * 20).cast("long").alias("offset"),
        F.col("l_quantity").cast("int").alias("size"),
        at.alias("at"),
    )


def sized_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per line item with as many records as its quantity (fifty at most); a run per order."""
    record = F.struct(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_returnflag").alias("pollutant"),
        F.col("l_tax").cast("string").alias("concentration"),
    )
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("run"),
        (F.col("l_linenumber") * 20).alias("offset"),
        F.array_repeat(record, F.col("l_quantity").cast("int")).alias("data"),
    )
