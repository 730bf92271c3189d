"""Several dumps read together, and fields that dumps hold beyond the contract."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazelake.dictionaries import DAILY_SOURCE, SNAPSHOT_GLOBS
from hazelake.functions.naming import canonical_pollutant
from hazelake.functions.readings import number, reading_time
from hazelake.operators.rows import one_per_reading
from hazelake.operators.shapes import station_rows
from hazelake.operators.standardize import with_date_columns, with_pollutant_and_unit, with_risk, with_state
from hazelake.plans.silver import daily_silver, require_source
from hazelake.schemas import IDENTITY_COLUMNS, SILVER_COLUMNS
from hazelake.sources.bronze import BRONZE_SCHEMAS
from hazelake.sources.paths import child, file_listing

# Up to this many dumps their times are sent to every task.
_MOST_BROADCAST = 100_000


def dump_times(spark: SparkSession, bronze_base: str, source: str) -> DataFrame:
    """``dump, dumped_at``: name of each dump of a source and modification time of its newest file, from the listing."""
    folder = child(bronze_base, require_source(source), SNAPSHOT_GLOBS[source])
    name = F.substring_index(F.substring_index("path", f"/{source}/", -1), "/", 1)
    return file_listing(spark, folder).groupBy(name.alias("dump")).agg(F.max("modificationTime").alias("dumped_at"))


def read_dumps(spark: SparkSession, bronze_base: str, source: str) -> DataFrame:
    """Records of all dumps of a source in JSON lines, with ``dump`` and ``dumped_at``, from one scan.

    The name of a row's dump comes from the hidden metadata of its file; the few rows of :func:`dump_times` are joined to it.
    """
    times = dump_times(spark, bronze_base, source)
    folder = child(bronze_base, source, SNAPSHOT_GLOBS[source])
    rows = spark.read.schema(BRONZE_SCHEMAS[source]).json(folder)
    name = F.substring_index(F.substring_index("_metadata.file_path", f"/{source}/", -1), "/", 1)
    few = times.limit(_MOST_BROADCAST + 1).count() <= _MOST_BROADCAST
    return rows.withColumn("dump", name).join(F.broadcast(times) if few else times, "dump")


def newest_of_many(dumps: DataFrame, source: str) -> DataFrame:
    """Silver rows of :func:`read_dumps`, each reading as the newest dump that holds it says.

    Newer beats older even with a missing value; within one dump, and between dumps of one time by name, the usual copy
    survives. It is a maximum, so copies collapse before the shuffle and no dump is read twice.
    """
    age = ("dumped_at", "dump")
    if require_source(source) == DAILY_SOURCE:
        rows = dumps.select(
            canonical_pollutant(F.col("pollutant")).alias("pollutant"),
            reading_time(F.col("date")).alias("observed_at"),
            *age,
            number(F.col("concentration")).alias("reading_value"),
        ).filter("pollutant is not null and observed_at is not null")
        best = F.max(F.struct(*age, "reading_value")).alias("best")
        kept = rows.groupBy("pollutant", "observed_at").agg(best)
        return daily_silver(kept.select("pollutant", "observed_at", "best.reading_value"))
    rows = station_rows(dumps, *age).filter("pollutant is not null")
    named = with_state(with_pollutant_and_unit(rows)).withColumn("observed_at", reading_time(F.col("timestamp")))
    named = named.filter("observed_at is not null").drop("timestamp")
    kept = one_per_reading(named, IDENTITY_COLUMNS, prefer=(*age, "reading_value")).drop(*age)
    return with_risk(with_date_columns(kept)).select(*SILVER_COLUMNS)


def read_open(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with the fields of ``schema`` and ``further``: all others, by name, as variants.

    Each line is parsed once, into a variant. Fields of the schema become text as they stand there; objects and arrays
    among them are read into their declared type.
    """
    lines = spark.read.format("json").option("singleVariantColumn", "record").load(str(path))
    fields = F.col("record").try_cast("map<string,variant>")
    rows = lines.select(F.coalesce(fields, F.create_map().cast("map<string,variant>")).alias("fields"))
    return rows.select(
        *(F.try_variant_get(F.col("fields")[f.name], "$", f.dataType.simpleString()).alias(f.name) for f in schema),
        F.map_filter("fields", lambda name, _: ~name.isin(schema.fieldNames())).alias("further"),
    )


def further_fields(rows: DataFrame) -> DataFrame:
    """``field, type, records`` of what :func:`read_open` found beyond the schema: the widest type of each field."""
    each = rows.select(F.explode("further").alias("field", "value"))
    return each.groupBy("field").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("records")
    )


def as_json(further: Column) -> Column:
    """Further fields as text, in the order of their names."""
    entries = F.array_sort(F.map_keys(further))
    return F.array_join(F.transform(entries, lambda name: F.concat(name, F.lit("="), F.to_json(further[name]))), ",")
