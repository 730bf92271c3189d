"""Row-level selection: validity, rejects, de-duplication and trailing ranges."""

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazelake.dictionaries import DAYS_PER_MONTH, HISTORY_MONTHS
from hazelake.functions.readings import number, reading_time
from hazelake.schemas import IDENTITY_COLUMNS


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows with a readable date and a pollutant; a missing value is kept."""
    return df.filter(F.col("observed_date").isNotNull() & F.col("pollutant").isNotNull())


def one_per_reading(
    df: DataFrame,
    keys: Sequence[str] = IDENTITY_COLUMNS,
    prefer: Sequence[str] = ("reading_value",),
) -> DataFrame:
    """One row per key, nulls in keys counting as equal.

    The survivor does not depend on row order or partitioning: a present value beats a missing one, a
    larger beats a smaller, then the remaining columns decide in frame order, again larger first and
    nulls last. It is the maximum of a struct, so copies collapse map-side: a key that holds a third of
    all rows reaches the shuffle as one row per map task.
    """
    keys = list(keys)
    first = [name for name in prefer if name in df.columns and name not in keys]
    rest = first + [name for name in df.columns if name not in keys and name not in first]
    if not rest:
        return df.dropDuplicates(keys)
    kept = df.groupBy(*_sorting_hash(df, keys), *keys).agg(_largest_row(df, rest).alias("_best"))
    return kept.select(*[name if name in keys else f"_best.{name}" for name in df.columns])


def _sorting_hash(df: DataFrame, keys: list[str]) -> list[Column]:
    """A hash of the keys to group by before the keys themselves; it changes no group.

    A text payload makes Spark aggregate by sorting, and the sort compares the first key by its leading
    bytes. Those of a source name are the same in every row, those of a hash are not, which halves the
    time. Floating keys stay out: grouping takes 0.0 and -0.0 as equal, the hash does not.
    """
    exact = (
        T.StringType,
        T.IntegralType,
        T.TimestampType,
        T.TimestampNTZType,
        T.DateType,
        T.BooleanType,
    )
    hashed = [name for name in keys if isinstance(df.schema[name].dataType, exact)]
    return [F.xxhash64(*hashed).alias("_hash")] if hashed else []


def _largest_row(df: DataFrame, names: list[str]) -> Column:
    ordered = [name for name in names if _orderable(df.schema[name].dataType)]
    if len(ordered) == len(names):
        return F.max(F.struct(*names))
    return F.max_by(F.struct(*names), F.struct(*ordered) if ordered else F.lit(1))


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(field.dataType) for field in data_type)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def rejected_daily_rows(df: DataFrame, corrupt_col: str = "_corrupt") -> DataFrame:
    """Daily bronze rows the cleaning drops or cannot read a number from, with the reason and the raw text.

    Rows with an unreadable number still reach silver, with a null value; the others do not. The raw text is
    that of lines that are no JSON, where the dump was read with it.
    """
    date, pollutant, value = F.col("date"), F.col("pollutant"), F.col("concentration")
    raw = F.col(corrupt_col) if corrupt_col in df.columns else F.lit(None).cast("string")
    reason = (
        F.when(raw.isNotNull(), "malformed record")
        .when(pollutant.isNull(), "missing pollutant")
        .when(date.isNull(), "missing date")
        .when(reading_time(date).isNull(), "unreadable date")
        .when(value.isNotNull() & number(value).isNull(), "unreadable value")
    )
    rows = df.select("date", "pollutant", "concentration", reason.alias("reason"), raw.alias("raw"))
    return rows.filter(F.col("reason").isNotNull())


def trailing_bounds(as_of: datetime, months_back: int = HISTORY_MONTHS) -> tuple[datetime, datetime]:
    """Start and end of the history window; a month counts exactly thirty days."""
    return as_of - timedelta(days=months_back * DAYS_PER_MONTH), as_of


def _session_time(moment: datetime) -> Column:
    """A time as text, so that one without a zone is read in the session's zone and not in the driver's."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def trailing_range(
    df: DataFrame,
    as_of: datetime,
    months_back: int = HISTORY_MONTHS,
    time_col: str = "observed_at",
) -> DataFrame:
    """Rows observed within the history window, both ends included.

    On a frame with the silver date parts the same window is also stated on them, so that a scan of
    the partitioned dataset lists only the days it needs.
    """
    start, end = (_session_time(bound) for bound in trailing_bounds(as_of, months_back))
    rows = df.filter(F.col(time_col).between(start, end))
    if {"year", "month", "day"} <= set(df.columns) and time_col == "observed_at":
        day = F.make_date("year", "month", "day")
        rows = rows.filter(day.between(F.to_date(start), F.to_date(end)))
    return rows
