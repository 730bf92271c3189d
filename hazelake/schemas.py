"""Declared shapes of the data: two bronze inputs, landed pages and the silver contract.

Bronze leaves are declared as strings on purpose. A JSON number reads into a string column unchanged,
one mistyped value can then only spoil its own row, and an empty dump still has its columns. Declaring
the schema also saves the inference pass over the files and keeps unused fields out of the parser.
"""

from pyspark.sql import types as T


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _DOUBLE, _INT = T.StringType(), T.DoubleType(), T.IntegerType()

DAILY_BRONZE = _record(date=_TEXT, pollutant=_TEXT, concentration=_TEXT)

_SENSOR = _record(parameter=_record(name=_TEXT, units=_TEXT))
_STATION = _record(
    id=_TEXT,
    name=_TEXT,
    locality=_TEXT,
    country=_record(name=_TEXT),
    coordinates=_record(latitude=_TEXT, longitude=_TEXT),
    datetimeFirst=_record(utc=_TEXT),
    datetimeLast=_record(utc=_TEXT),
    sensors=T.ArrayType(_SENSOR),
)
STATION_BRONZE = _record(location_id=_TEXT, results=T.ArrayType(_STATION))

SILVER = _record(
    source=_TEXT,
    source_location_id=_TEXT,
    location_name=_TEXT,
    state=_TEXT,
    country=_TEXT,
    latitude=_DOUBLE,
    longitude=_DOUBLE,
    pollutant=_TEXT,
    unit=_TEXT,
    reading_value=_DOUBLE,
    observed_at=T.TimestampType(),
    observed_date=T.DateType(),
    year=_INT,
    month=_INT,
    day=_INT,
    health_risk_category=_TEXT,
)
SILVER_COLUMNS = SILVER.fieldNames()

# What makes two silver rows the same reading.
IDENTITY_COLUMNS = ["source", "source_location_id", "location_name", "pollutant", "observed_at"]

# Directory layout of the silver dataset, outermost first.
PARTITION_COLUMNS = ["year", "month", "day", "source"]
