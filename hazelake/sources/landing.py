"""Landed responses of the two sources: pages of daily records and station documents."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from hazelake.dictionaries import PAGE_LIMIT
from hazelake.schemas import DAILY_BRONZE, STATION_BRONZE


# What is in the way of a response's records being taken.
UNREADABLE = "unreadable response"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``run, offset, body`` of pages landed as ``run=…/offset=…/<file>``, one response per file.

    A page holds at most :data:`PAGE_LIMIT` records, which bounds the text of a row.
    """
    return page_bodies(spark.read, path)


def page_bodies(reader: DataFrameReader | DataStreamReader, path: str, bundled: bool = False) -> DataFrame:
    """:func:`read_pages` through a batch or a stream reader.

    ``bundled`` pages are rows ``run, offset, body`` of Parquet files, many in each, so that files do not grow in number
    with the responses.
    """
    if bundled:
        return reader.schema("run string, offset long, body string").parquet(str(path))
    layout = "value string, run string, offset long"
    return reader.schema(layout).text(str(path), wholetext=True).select("run", "offset", F.col("value").alias("body"))


def _parsed(body: Column, record: T.StructType) -> Column:
    """A response as ``list`` (a bare array), ``one`` (any other object) and ``broken`` (what does not parse).

    The text is parsed once, as the value of a field of its own, so that text behind it is an error too.
    """
    envelope = T.StructType([T.StructField("data", T.ArrayType(record)), *record.fields])
    shape = T.StructType(
        [T.StructField("list", T.ArrayType(record)), T.StructField("one", envelope), T.StructField("broken", T.StringType())]
    )
    is_list = F.ltrim(F.translate(body, "\ufeff\t\r\n", "")).startswith("[")
    text = F.concat(F.when(is_list, F.lit('{"list":')).otherwise(F.lit('{"one":')), body, F.lit("}"))
    return F.from_json(text, shape, {"columnNameOfCorruptRecord": "broken"})


def judged_pages(pages: DataFrame, record: T.StructType = DAILY_BRONZE) -> DataFrame:
    """Pages with their ``data``, its ``size``, and ``reason`` with the ``raw`` body where a response cannot be read.

    The records of a response are the ``data`` of an envelope, a bare array, or a single record. An empty response, ``{}``
    or an envelope without data hold none. ``body`` goes.
    """
    kept = [F.col(name) for name in pages.columns if name != "body"]
    blank = F.coalesce(F.trim("body", F.lit(" \t\r\n")), F.lit("")).isin("", "null", "{}")
    page = F.when(~blank, _parsed(F.col("body"), record))
    parsed = pages.select(*kept, "body", page.alias("_page"))
    one, broken = F.col("_page.one"), F.col("_page.broken").isNotNull()
    fields = [one[name] for name in record.fieldNames()]
    present = reduce(or_, (field.isNotNull() for field in fields))
    single = F.when(present, F.array(F.struct(*(f.alias(n) for f, n in zip(fields, record.fieldNames(), strict=True)))))
    data = F.when(~broken, F.coalesce("_page.list", one["data"], single))
    return parsed.select(
        *kept, data.alias("data"), F.coalesce(F.size(data), F.lit(0)).alias("size"),
        F.when(broken, F.lit(UNREADABLE)).alias("reason"), F.when(broken, F.col("body")).alias("raw"),
    )


def parse_pages(pages: DataFrame, record: T.StructType = DAILY_BRONZE) -> DataFrame:
    """Replace the raw ``body`` of each page by its ``data`` array.

    A body that does not parse fails the read: taken for an empty page it would end its run. Pages may be parted
    by :func:`judged_pages` first.
    """
    kept = [name for name in pages.columns if name != "body"]
    message = F.concat(F.lit("Unreadable page: "), F.left("raw", F.lit(200)))
    data = F.when(F.col("reason").isNotNull(), F.raise_error(message).cast(T.ArrayType(record))).otherwise(F.col("data"))
    return judged_pages(pages, record).select(*kept, data.alias("data"))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """The pages whose ``body`` does not parse, as they are."""
    kept = [name for name in pages.columns if name != "body"]
    return judged_pages(pages).filter("reason is not null").select(*kept, F.col("raw").alias("body"))


def readable_pages(pages: DataFrame) -> DataFrame:
    """The pages of runs that hold no unreadable page; the others cannot be told complete."""
    broken = rejected_pages(pages).select(F.col("run").alias("_run")).distinct()
    return pages.join(broken, F.col("run").eqNullSafe(F.col("_run")), "left_anti")


def flatten_pages(pages: DataFrame) -> DataFrame:
    """The records of all pages as one bag of rows.

    The outer generator spares the size test Spark would add below an inner one, which would parse
    every page's text once more.
    """
    records = pages.select(F.explode_outer("data").alias("record"))
    return records.filter(F.col("record").isNotNull()).select("record.*")


def complete_pages(
    pages: DataFrame, run_cols: Sequence[str] = ("run",), limit: int = PAGE_LIMIT
) -> DataFrame:
    """Pages up to and including the first one of their run that is shorter than ``limit``.

    A short or empty page ends a run: what was landed behind it belongs to no complete run. The ends
    are found from page sizes alone (a column ``size`` where there is one, else that of ``data``), with partial
    aggregation, so a run of any length is one row. Spark
    chooses the join by the size of that result; pages of a long run are never gathered in one task.
    """
    size = F.col("size") if "size" in pages.columns else F.coalesce(F.size("data"), F.lit(0))
    short = F.min(F.when(size < limit, F.col("offset")))
    if not run_cols:
        end = pages.agg(short.alias("_end")).scalar()
        return pages.filter(end.isNull() | (F.col("offset") <= end))
    runs = [F.col(name).alias(f"_{name}") for name in run_cols]
    ends = pages.groupBy(*runs).agg(short.alias("_end")).filter(F.col("_end").isNotNull())
    same_run = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in run_cols]
    bounded = pages.join(ends, same_run, "left")
    kept = bounded.filter(F.col("_end").isNull() | (F.col("offset") <= F.col("_end")))
    return kept.select(*pages.columns)


def tag_request_key(docs: DataFrame, key: Column, name: str = "location_id") -> DataFrame:
    """Give each document the id it was requested by; empty documents are dropped."""
    content = [F.col(column).isNotNull() for column in docs.columns if column != name]
    rest = [column for column in docs.columns if column != name]
    return docs.filter(reduce(or_, content)).select(key.cast("string").alias(name), *rest)


def document_bodies(
    reader: DataFrameReader | DataStreamReader,
    path: str,
    key_pattern: str = r"(\d+)[^/]*\.json$",
    bundled: bool = False,
) -> DataFrame:
    """``location_id, body, path`` of station documents landed one response per file.

    The id is the one in the file's name, null without one. A failed request lands no file, so its id is absent.
    ``bundled`` responses are rows ``path, body`` of Parquet files, many in each; ``path`` is the name that a file of
    their own would have.
    """
    if bundled:
        rows = reader.schema("path string, body string").parquet(str(path))
        key = F.nullif(F.regexp_extract("path", key_pattern, 1), F.lit(""))
        return rows.select(key.alias("location_id"), "body", "path")
    files = reader.schema("value string").text(str(path), wholetext=True)
    key = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1), F.lit(""))
    return files.select(key.alias("location_id"), F.col("value").alias("body"), F.col("_metadata.file_path").alias("path"))


def judged_documents(bodies: DataFrame) -> DataFrame:
    """One row per document of ``bodies(location_id, body, …)``: ``location_id, results``, or ``reason`` and ``raw``.

    A response is one document or an array of them. What is no JSON, what stands behind a document, and what has
    another shape is a reject with its whole text; so is no other text, and an empty document gives no row.
    """
    kept = [name for name in bodies.columns if name not in ("body", "location_id")]
    parsed = judged_pages(bodies.withColumnRenamed("location_id", "_key"), STATION_BRONZE)
    rows = parsed.select(*kept, "_key", "reason", "raw", F.explode_outer("data").alias("doc"))
    holds = F.col("doc.location_id").isNotNull() | F.col("doc.results").isNotNull()
    return rows.filter(holds | F.col("reason").isNotNull()).select(
        *kept, F.coalesce("_key", "doc.location_id").alias("location_id"), F.col("doc.results").alias("results"), "reason", "raw"
    )


def read_station_documents(
    spark: SparkSession, path: str, key_pattern: str = r"(\d+)[^/]*\.json$"
) -> DataFrame:
    """Station documents landed one per file, tagged with the id in the file's name.

    A file that cannot be read whole fails the read; :func:`judged_documents` keeps it as a reject instead.
    """
    docs = judged_documents(document_bodies(spark.read, path, key_pattern))
    message = F.concat(F.lit("Unreadable document "), "path", F.lit(": "), F.left("raw", F.lit(200)))
    results = F.when(F.col("reason").isNotNull(), F.raise_error(message).cast(STATION_BRONZE["results"].dataType))
    return docs.select("location_id", results.otherwise(F.col("results")).alias("results"))
