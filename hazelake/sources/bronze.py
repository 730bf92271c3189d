"""Reading and landing raw JSON dumps."""

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from hazelake.dictionaries import (
    DAILY_SOURCE,
    SNAPSHOT_GLOBS,
    SNAPSHOT_PREFIXES,
    STATION_SOURCE,
)
from hazelake.schemas import DAILY_BRONZE, STATION_BRONZE
from hazelake.sources.paths import child, file_listing

BRONZE_SCHEMAS = {DAILY_SOURCE: DAILY_BRONZE, STATION_SOURCE: STATION_BRONZE}

# How JSON lies in a file. ``lines``: one object per line; a line that does not parse spoils only itself, and is
# a reject where rejects are asked for.
# ``document``: one object or array per file, any formatting, one task per file. ``indented``: an array of
# objects written with an indent of two, which can be split like lines. Text that the latter two cannot
# account for fails the read, so that no record is lost unseen.
DOCUMENT, INDENTED, LINES = "document", "indented", "lines"
LAYOUTS = (DOCUMENT, INDENTED, LINES)

# Column for the text of a line that does not parse, where it is asked for.
CORRUPT = "_corrupt"

# In an array indented by two only a record of the array itself opens and closes at this depth; text
# inside JSON strings cannot hold a raw line break.
_RECORD_OPENS = "\n  {\n"
_RECORD_CLOSES = "\n  }"
# What may stand between such records.
_BETWEEN = r"^[\s,\[\]]*(?:\{\}[\s,\[\]]*)*$"


class Snapshot(NamedTuple):
    """One dump: a file, or a folder of JSON lines written by :func:`land_snapshot`."""

    path: str
    layout: str
    size: int


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    layout: str = DOCUMENT,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON records at ``path``; without a schema Spark infers one in an extra pass.

    With ``keep_corrupt`` the text of unreadable lines is kept in a column of its own; the other layouts have
    none, as they fail.
    """
    if schema is None:
        if layout == INDENTED:
            raise ValueError("The indented layout needs a schema")
        return spark.read.option("multiLine", layout == DOCUMENT).option("mode", "FAILFAST").json(str(path))
    return records(spark.read, str(path), schema, layout, keep_corrupt)


def records(
    reader: DataFrameReader | DataStreamReader,
    path: str,
    schema: T.StructType,
    layout: str,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Records of the files at ``path`` through a batch or a stream reader."""
    if layout not in LAYOUTS:
        raise ValueError(f"Unknown layout: {layout}")
    if layout == LINES:
        if not keep_corrupt:
            return reader.schema(schema).json(path)
        kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        return reader.schema(kept).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    if layout == DOCUMENT:
        found = _document_records(reader.text(path, wholetext=True), schema)
    else:
        found = _indented_records(reader.text(path, lineSep=_RECORD_CLOSES), schema)
    exploded = found.select(F.explode("records").alias("record")).select("record.*")
    return exploded.withColumn(CORRUPT, F.lit(None).cast("string")) if keep_corrupt else exploded


def _strict(text: Column, kind: T.DataType) -> Column:
    """``text`` as one JSON value; anything else, also text after the value, fails the read."""
    holder = T.StructType([T.StructField("value", kind)])
    parsed = F.from_json(F.concat(F.lit('{"value":'), text, F.lit("}")), holder, {"mode": "FAILFAST"})
    return parsed["value"]


def _document_records(files: DataFrame, schema: T.StructType) -> DataFrame:
    text = F.col("value")
    start = F.left(F.ltrim(F.translate(text, "\ufeff\t\r\n", "")), F.lit(1))
    array = F.filter(_strict(text, T.ArrayType(schema)), lambda record: record.isNotNull())
    return files.select(
        F.when(start == "[", array).when(start != "", F.array(_strict(text, schema))).alias("records")
    )


def _indented_records(pieces: DataFrame, schema: T.StructType) -> DataFrame:
    text = F.col("value")
    holds = text.contains(_RECORD_OPENS)
    between = F.when(holds, F.substring_index(text, _RECORD_OPENS, 1)).otherwise(text)
    body = F.substring_index(text, _RECORD_OPENS, -1)
    whole = F.when(holds, F.length(between) + F.length(F.lit(_RECORD_OPENS)) + F.length(body) == F.length(text))
    accounted = between.rlike(_BETWEEN) & F.coalesce(whole, F.lit(True))
    record = F.from_json(F.concat(F.lit("{"), body, F.lit("}")), schema)
    blank = F.from_json(F.lit("{}"), schema)
    empty = F.array_repeat(blank, F.regexp_count(between, F.lit(r"\{\}")))
    message = F.lit("Not an array of objects indented by two; read it with layout='document'")
    return pieces.select(
        F.when(~accounted, F.raise_error(message).cast(T.ArrayType(schema)))
        .when(holds, F.concat(empty, F.array(record)))
        .otherwise(empty)
        .alias("records")
    )


def read_bronze(
    spark: SparkSession, path: str, source: str, layout: str | None = None, keep_corrupt: bool = False
) -> DataFrame:
    """A dump of the named source with its declared schema; the layout is looked up if not given."""
    layout = layout or snapshot_at(spark, path).layout
    return read_json(spark, path, BRONZE_SCHEMAS[source], layout, keep_corrupt)


def snapshot_at(spark: SparkSession, path: str) -> Snapshot:
    """Layout and size of the dump at ``path``."""
    files = file_listing(spark, path).agg(F.sum("length").alias("size"), F.max("path").alias("last"))
    found = files.first()
    if found.size is None:
        raise FileNotFoundError(f"No files found at {path}")
    is_file = found.last.rstrip("/").endswith("/" + str(path).rstrip("/").rsplit("/", 1)[-1])
    return Snapshot(str(path), _layout(spark, str(path), is_file), found.size)


def _layout(spark: SparkSession, path: str, is_file: bool) -> str:
    """Layout of a dump. A folder holds lines, whatever its files are called.

    A file holds lines if its first line with text is an object by itself; the first line of a longer object is not.
    One that begins like an array indented by two is read as such, and fails if it does not go on like that. Everything
    else is a document, which fails unless it is one JSON value.
    """
    if not is_file:
        return LINES
    line = F.translate("value", "\ufeff", "")
    lines = spark.read.option("lineSep", "\n").text(path).filter(F.trim(F.translate("value", "\ufeff\r\t", "")) != "")
    whole = F.ltrim(line).startswith("{") & F.try_parse_json(line).isNotNull()
    head = lines.select(F.left(line, F.lit(4)).alias("start"), whole.alias("whole")).head(2)
    if head and head[0].whole and head[0].start.strip() != "{}":
        return LINES
    return INDENTED if [row.start for row in head] == ["[", "  {"] else DOCUMENT


def latest_snapshot(spark: SparkSession, bronze_base: str, source: str) -> Snapshot:
    """The newest dump of a source by modification time; equal times go to the later name.

    Only the listing is read. A dump is a file, or a folder whose files count as one dump.
    """
    if source not in SNAPSHOT_GLOBS:
        raise ValueError(f"Unsupported air-quality source: {source}")
    folder = child(bronze_base, source)
    missing = f"No bronze files found for source '{source}' in {folder}"
    try:
        files = file_listing(spark, child(folder, SNAPSHOT_GLOBS[source]))
    except FileNotFoundError as error:
        raise FileNotFoundError(missing) from error
    marker = f"/{source}/"
    name = F.substring_index(F.substring_index("path", marker, -1), "/", 1)
    dumps = files.groupBy(name.alias("name")).agg(
        F.max("modificationTime").alias("at"),
        F.sum("length").alias("size"),
        F.max(F.col("path").endswith(F.concat(F.lit(marker), name))).alias("is_file"),
    )
    newest = dumps.orderBy(F.desc("at"), F.desc("name")).first()
    if newest is None:
        raise FileNotFoundError(missing)
    path = child(folder, newest["name"])
    return Snapshot(path, _layout(spark, path, newest.is_file), newest["size"])


def land_snapshot(df: DataFrame, bronze_base: str, source: str, taken_at: datetime) -> str:
    """Write records as a new dump named by its second, one object per line so that it splits.

    A second dump within the same second is an error, never an overwrite.
    """
    name = f"{SNAPSHOT_PREFIXES[source]}_{taken_at:%Y%m%d_%H%M%S}.json"
    path = child(bronze_base, source, name)
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    return path
