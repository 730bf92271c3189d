"""Paths as text, so that any Hadoop file system works, and the cluster's shared folder."""

import tempfile
import uuid
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def child(base, *parts: str) -> str:
    """``base/part/…`` without touching a ``scheme://`` prefix."""
    return "/".join([str(base).rstrip("/"), *parts])


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """``path, modificationTime, length`` of the files at ``path``; contents are not read.

    A path that does not exist is a FileNotFoundError.
    """
    try:
        files = spark.read.format("binaryFile").load(str(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"No files found at {path}") from error
    return files.select("path", "modificationTime", "length")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="hazelake-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared folder the cluster names.

    Only a local session, where the setting is usually absent, falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return child(base, "hazelake", f"{name}-{uuid.uuid4().hex}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists; nothing but the folder itself is looked at."""
    try:
        spark.read.schema("value string").text(str(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def clear_folder(spark: SparkSession, path: str, schema: StructType | None = None) -> None:
    """Empty a folder this library staged: Spark puts an empty table in the place of what it holds.

    With a schema that table is Parquet, so that the folder above can still be read whole.
    """
    empty = spark.createDataFrame([], schema or "value string").coalesce(1).write.mode("overwrite")
    empty.parquet(str(path)) if schema else empty.text(str(path))
