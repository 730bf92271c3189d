"""What several operators share: tables, staged intermediates, packed integers."""

import re
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that extra columns cannot clash with those an operator adds."""
    return df.select(*(F.col(f"`{name}`") for name in names))


def on_plain_names(docs: DataFrame, needed: tuple[str, ...], operator) -> DataFrame:
    """``operator(docs)``, which keeps the columns of ``docs``, with all but the needed ones under names that clash with nothing.

    So a further column may have a dot in its name, the name of one an operator adds, or that of another column.
    """
    plain = [name if name in needed else f"further{i}" for i, name in enumerate(docs.columns)]
    return operator(docs.toDF(*plain)).select(*plain).toDF(*docs.columns)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id has the remainder of the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def python_fold(doc_id, folds: int = 5) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or a temporary one of a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="hazelake-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back: the lineage ends there.

    The files stay, since the frame that is returned reads them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a narrow frame by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned 32-bit arrays as one compressed value; ``unpack`` needs their lengths only as stored inside."""
    parts = [np.asarray(array, dtype="<u4") for array in arrays]
    head = np.array([len(parts), *(len(part) for part in parts)], dtype="<u4")
    return zstandard.compress(np.concatenate([head, *parts]).tobytes(), 3)


def unpack(data: bytes) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.decompress(data), dtype="<u4")
    count = int(flat[0])
    ends = np.cumsum(flat[1 : 1 + count], dtype=np.int64) + 1 + count
    starts = np.concatenate([[1 + count], ends[:-1]])
    return [flat[start:end] for start, end in zip(starts, ends, strict=True)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, …`` of every run, one run after the other."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, dtype=np.int64) - first, lengths)


def sliced(batches, rows: int):
    """The same rows in Arrow batches of at most ``rows``, so that little of a batch is unpacked at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def pieces_of(column, most: int = 1 << 20):
    """UTF-8 bytes of a text column in runs of whole rows of about ``most`` bytes: ``(first row, data, offsets)``.

    A null text is empty. A longer row is a run of its own.
    """
    binary = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = binary.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(binary):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1)
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


#: A side of a join is broadcast up to so many rows (each of a few dozen bytes), and only after they were counted.
BROADCAST_ROWS = 1_000_000


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked to be shuffled and sorted in a join, whatever its size is taken to be.

    Spark takes it from the bytes of compressed files, and the rows a Python function returns to be as many as it gets.
    """
    return df.hint("merge")


def hinted(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a count shows that it is small; else to be shuffled."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else shuffled(df)
