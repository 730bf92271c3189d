"""Time, number and risk expressions of a reading."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazelake.dictionaries import RISK_LABELS, RISK_LIMITS, UNKNOWN_RISK
from hazelake.functions.text import lookup

# A text must open with a year: Spark would read a bare ``12:34`` as a time of the day the job runs.
_OPENS_WITH_YEAR = r"^[\x00-\x20]*[+-]?\d{4}"


def reading_time(text: Column) -> Column:
    """Timestamp of ISO-like text, null when it cannot be read; zoneless text is in the session zone."""
    text = text.cast("string")
    return F.when(text.rlike(_OPENS_WITH_YEAR), F.try_to_timestamp(text))


def number(value: Column) -> Column:
    """Double, or null where the text is no number; never fails the job."""
    return value.try_cast("double")


def label_by_limits(value: Column, limits: Column | Sequence[float]) -> Column:
    """First label whose inclusive upper limit reaches ``value``, the last label above all limits.

    ``limits`` is a list of numbers or an array column with one limit for every label but the last.
    NaN is above every limit.
    """
    bands = F.when(value <= limits[0], F.lit(RISK_LABELS[0]))
    for i, name in enumerate(RISK_LABELS[1:-1], 1):
        bands = bands.when(value <= limits[i], F.lit(name))
    return bands.otherwise(F.lit(RISK_LABELS[-1]))


def risk_label(pollutant: Column, value: Column) -> Column:
    """Health-risk label of a value; ``unknown`` without a value or for a pollutant without limits."""
    limits = lookup(RISK_LIMITS, pollutant)
    unknown = value.isNull() | limits.isNull()
    return F.when(unknown, F.lit(UNKNOWN_RISK)).otherwise(label_by_limits(value, limits))
