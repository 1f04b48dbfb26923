"""Record layouts and target table shapes.

A target is a list of :class:`Target` columns: the Spark type to cast to,
whether NULL is allowed, an optional text format for dates and timestamps and
an optional maximum text length (CHAR/VARCHAR widths).  ``functions.casting``
turns a target into ``try_cast`` expressions plus a per-row error list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


class Sql(str):
    """SQL text as a column default, filled in by the catalog table."""


@dataclass(frozen=True)
class Target:
    name: str
    dtype: str
    nullable: bool = True
    fmt: str | None = None
    max_len: int | None = None
    default: object | None = None


# --- fixed values: position record layout -------------------------------
# Wire order of the pipe-delimited position line (12 fields, ends in "\n").
POSITION_WIRE_FIELDS = [
    "icao24", "callsign", "latitude", "longitude", "altitude", "velocity",
    "heading", "vertical_rate", "on_ground", "squawk", "pos_date", "ts",
]
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
DATE_TEXT_FORMAT = "yyyy-MM-dd"
# Day-range partitioning of the warehouse position table.
WAREHOUSE_FIRST_DAY = "2024-01-01"
WAREHOUSE_LAST_DAY = "2030-12-31"
# Value used for reference attributes a position could not be matched to.
UNKNOWN = "UNKNOWN"
# Schema-and-payload JSON envelope: (field, connect type, optional).
ENVELOPE_FIELDS = [
    ("icao24", "string", True),
    ("callsign", "string", True),
    ("pos_date", "string", False),
    ("latitude", "double", False),
    ("longitude", "double", False),
    ("altitude", "double", False),
    ("velocity", "double", False),
    ("heading", "double", False),
    ("vertical_rate", "double", False),
    ("on_ground", "int32", False),
    ("squawk", "string", True),
    ("ts", "string", False),
]
ENVELOPE_NAME = "AdsbPosition"
# Dead-letter context header names and the converter failure they report.
DLQ_HEADER_PREFIX = "__connect.errors."
DLQ_HEADERS = [
    "topic", "partition", "offset", "connector.name", "task.id", "stage",
    "exception.class.name", "exception.message",
]
DLQ_STAGE = "VALUE_CONVERTER"
DLQ_EXCEPTION_CLASS = "org.apache.kafka.connect.errors.DataException"
DLQ_EXCEPTION_MESSAGE = "Converter error: null value for a required (non-optional) field"

# Lake table (pipelines 4, 5): doubles, pos_date kept as text.
LAKE_POSITIONS = [
    Target("icao24", "string"),
    Target("callsign", "string"),
    Target("latitude", "double"),
    Target("longitude", "double"),
    Target("altitude", "int"),
    Target("velocity", "double"),
    Target("heading", "double"),
    Target("vertical_rate", "int"),
    Target("on_ground", "int"),
    Target("squawk", "string"),
    Target("pos_date", "string"),
    Target("ts", "timestamp_ntz", fmt=TS_TEXT_FORMAT),
]

# Warehouse table (pipelines 2, 6, 7, 8): decimals, NOT NULL, widths.
WAREHOUSE_POSITIONS = [
    Target("icao24", "string", nullable=False, max_len=6),
    Target("callsign", "string", max_len=8),
    Target("pos_date", "date", nullable=False, fmt=DATE_TEXT_FORMAT),
    Target("latitude", "decimal(9,6)", nullable=False),
    Target("longitude", "decimal(10,6)", nullable=False),
    Target("altitude", "int"),
    Target("velocity", "decimal(7,2)"),
    Target("heading", "decimal(6,2)"),
    Target("vertical_rate", "int"),
    Target("on_ground", "tinyint", default=0),
    Target("squawk", "string", max_len=4),
    Target("ts", "timestamp_ntz", nullable=False, fmt=TS_TEXT_FORMAT),
]

# Weather observations (pipeline 3).
WEATHER_CSV_FIELDS = [
    "station_id", "observation_ts", "temperature_c", "wind_speed_kts",
    "wind_direction", "visibility_m", "precipitation_mm", "pressure_hpa",
    "conditions",
]
WEATHER_OBS = [
    Target("station_id", "string", nullable=False, max_len=4),
    Target("observation_ts", "timestamp_ntz", nullable=False, fmt="yyyy-MM-dd HH:mm:ss"),
    Target("temperature_c", "decimal(5,1)"),
    Target("wind_speed_kts", "smallint"),
    Target("wind_direction", "smallint"),
    Target("visibility_m", "int"),
    Target("precipitation_mm", "decimal(6,2)"),
    Target("pressure_hpa", "decimal(7,1)"),
    Target("conditions", "string", max_len=10),
]

# Reference table for the lookup join (pipeline 5).
AIRCRAFT_REF = T.StructType([
    T.StructField("icao24", T.StringType(), False),
    T.StructField("registration", T.StringType()),
    T.StructField("aircraft_type", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("country", T.StringType()),
])
REF_ATTRIBUTES = ["registration", "aircraft_type", "operator", "country"]
# --- end fixed values ---------------------------------------------------

# Spark's own Kafka record layout; file-backed topics use the same columns.
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])


_SIMPLE = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "smallint": T.ShortType(), "tinyint": T.ByteType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "binary": T.BinaryType(),
}


def spark_type(target: Target) -> T.DataType:
    """Spark type of a target's type name (no session needed)."""
    name = target.dtype.strip().lower()
    if name.startswith("decimal("):
        p, s = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    return _SIMPLE[name]


def struct_of(targets: list[Target]) -> T.StructType:
    return T.StructType([T.StructField(t.name, spark_type(t), t.nullable) for t in targets])


# --- fixed values: Avro record schemas (wire compatibility) ---------------
# Position record; field-level logicalType on ts is ignored by Avro, so ts is
# a plain long of epoch milliseconds.
AVRO_POSITION = {
    "type": "record", "name": "AircraftPosition",
    "fields": [
        {"name": "icao24", "type": "string"},
        {"name": "callsign", "type": "string"},
        {"name": "latitude", "type": "double"},
        {"name": "longitude", "type": "double"},
        {"name": "altitude", "type": "int"},
        {"name": "velocity", "type": "double"},
        {"name": "heading", "type": "double"},
        {"name": "vertical_rate", "type": "int"},
        {"name": "on_ground", "type": "boolean"},
        {"name": "squawk", "type": "string"},
        {"name": "ts", "type": "long", "logicalType": "timestamp-millis"},
    ],
}
# Product v1 and v2 (v2 adds three optional fields with null defaults).
AVRO_PRODUCT_V1 = {
    "type": "record", "name": "Product",
    "fields": [
        {"name": "product_id", "type": "string"},
        {"name": "name", "type": "string"},
        {"name": "price", "type": "double"},
        {"name": "category", "type": "string"},
        {"name": "ts", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    ],
}
AVRO_PRODUCT_V2 = {
    "type": "record", "name": "Product",
    "fields": AVRO_PRODUCT_V1["fields"] + [
        {"name": "description", "type": ["null", "string"], "default": None},
        {"name": "subcategory", "type": ["null", "string"], "default": None},
        {"name": "discount_pct", "type": ["null", "double"], "default": None},
    ],
}
# --- end fixed values ---------------------------------------------------
