"""Wire formats as Column expressions.

Every encoder and decoder here is a plain Spark expression, so it runs inside
whole-stage codegen next to the scan; only Avro bodies need Python
(``sources.avro``).  Encoders take a DataFrame of typed position columns;
decoders take the binary ``value`` column of a topic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.schemas import (
    DATE_TEXT_FORMAT,
    ENVELOPE_FIELDS,
    ENVELOPE_NAME,
    TS_TEXT_FORMAT,
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag01(c: str | Column) -> Column:
    """Boolean as 0/1 with NULL counted as 0 (CASE WHEN b THEN 1 ELSE 0)."""
    return F.when(_c(c), F.lit(1)).otherwise(F.lit(0))


def text(c: str | Column) -> Column:
    return _c(c).cast("string")


def ts_text(c: str | Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss.SSS`` (always three millis digits)."""
    return F.date_format(_c(c), TS_TEXT_FORMAT)


def _from_epoch(ms: Column) -> Column:
    """Epoch milliseconds as TIMESTAMP_NTZ in UTC, whatever the session zone."""
    return F.timestamp_add("MILLISECOND", ms.cast("long"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def epoch_ms_text(ms: str | Column) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss.SSS`` in UTC, before 1970 too."""
    ms = _c(ms)
    millis = F.pmod(ms, F.lit(1000))
    return F.concat(
        F.substring(_from_epoch(ms - millis).cast("string"), 1, 19),
        F.lit("."),
        F.lpad(millis.cast("string"), 3, "0"),
    )


def epoch_ms_date_text(ms: str | Column) -> Column:
    return _from_epoch(_c(ms)).cast("date").cast("string")


def position_fields_text(ts_col: str | Column = "ts") -> list[Column]:
    """The 12 wire fields of a typed position row, in wire order, as text."""
    ts = _c(ts_col)
    return [
        text("icao24"), text("callsign"), text("latitude"), text("longitude"),
        text("altitude"), text("velocity"), text("heading"), text("vertical_rate"),
        flag01("on_ground").cast("string"), text("squawk"),
        F.date_format(ts, DATE_TEXT_FORMAT), ts_text(ts),
    ]


def join_line(fields: list[Column], sep: str = "|") -> Column:
    """``a || '|' || b ... || chr(10)``: NULL if any part is NULL (never concat_ws)."""
    parts: list[Column] = []
    for i, f in enumerate(fields):
        if i:
            parts.append(F.lit(sep))
        parts.append(f)
    parts.append(F.lit("\n"))
    return F.concat(*parts)


def encode_delimited(ts_col: str | Column = "ts") -> Column:
    return join_line(position_fields_text(ts_col))


def strip_newline(value: str | Column) -> Column:
    """Drop one trailing ``\\n`` (or ``\\r\\n``) from the message text."""
    return F.regexp_replace(_c(value).cast("string"), r"\r?\n\z", "")


def split_fields(value: str | Column, sep: str = "|") -> Column:
    """Message → array of fields; limit -1 keeps empty trailing fields."""
    return F.split(strip_newline(value), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep, -1)


def fields_struct(parts: Column, names: list[str]) -> Column:
    """array<string> → struct of named text fields (missing positions → NULL)."""
    return F.struct(*[F.get(parts, i).alias(n) for i, n in enumerate(names)])


# --- JSON ---------------------------------------------------------------

def encode_json(ts_col: str | Column = "ts") -> Column:
    """Flat JSON record: on_ground 0/1, ts and pos_date as text."""
    ts = _c(ts_col)
    return F.to_json(
        F.struct(
            "icao24", "callsign", "latitude", "longitude", "altitude", "velocity",
            "heading", "vertical_rate", flag01("on_ground").alias("on_ground"), "squawk",
            ts_text(ts).alias("ts"),
            F.date_format(ts, DATE_TEXT_FORMAT).alias("pos_date"),
        ),
        {"ignoreNullFields": "false"},
    )


def decode_json_text(value: str | Column, names: list[str]) -> Column:
    """Flat JSON record as a struct of text fields and ``_corrupt``: the text of
    a message that is no JSON object (a NULL message gives a NULL struct)."""
    ddl = ", ".join([*(f"`{n}` string" for n in names), "_corrupt string"])
    return F.from_json(_c(value).cast("string"), ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})


# --- schema-and-payload envelope ----------------------------------------

_CONNECT_CAST = {"string": "string", "double": "double", "int32": "int"}


def envelope_schema_literal(fields=ENVELOPE_FIELDS, name: str = ENVELOPE_NAME) -> Column:
    return F.struct(
        F.lit("struct").alias("type"),
        F.array(*[
            F.struct(F.lit(f).alias("field"), F.lit(t).alias("type"), F.lit(o).alias("optional"))
            for f, t, o in fields
        ]).alias("fields"),
        F.lit(False).alias("optional"),
        F.lit(name).alias("name"),
    )


def envelope_payload(fields=ENVELOPE_FIELDS, ts_col: str | Column = "ts") -> Column:
    ts = _c(ts_col)
    cols = []
    for f, t, _ in fields:
        if f == "ts":
            cols.append(ts_text(ts).alias("ts"))
        elif f == "pos_date":
            cols.append(F.date_format(ts, DATE_TEXT_FORMAT).alias("pos_date"))
        elif f == "on_ground":
            cols.append(flag01("on_ground").alias("on_ground"))
        else:
            cols.append(F.col(f).cast(_CONNECT_CAST[t]).alias(f))
    return F.struct(*cols)


def encode_envelope(fields=ENVELOPE_FIELDS, ts_col: str | Column = "ts") -> Column:
    """``{"schema": {...}, "payload": {...}}`` with NULL fields kept visible."""
    return F.to_json(
        F.struct(envelope_schema_literal(fields).alias("schema"),
                 envelope_payload(fields, ts_col).alias("payload")),
        {"ignoreNullFields": "false"},
    )


ENVELOPE_DDL = (
    "schema struct<type: string, fields: array<struct<field: string, type: string, "
    "optional: boolean>>, optional: boolean, name: string>, payload map<string, string>, "
    "_corrupt string"
)


def decode_envelope(value: str | Column) -> Column:
    """One JSON parse: the embedded schema as a struct, the payload as text map.

    Keeping the payload as ``map<string,string>`` lets the required-field check
    read field names from each message's own schema, and the typed cast happens
    against the sink's target afterwards.
    """
    return F.from_json(_c(value).cast("string"), ENVELOPE_DDL,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})


def envelope_missing_required(env: Column) -> Column:
    """Names of non-optional fields whose payload value is NULL or absent."""
    required = F.filter(env["schema"]["fields"], lambda f: ~F.coalesce(f["optional"], F.lit(False)))
    missing = F.filter(required, lambda f: F.try_element_at(env["payload"], f["field"]).isNull())
    return F.transform(missing, lambda f: f["field"])


# --- registry framing ---------------------------------------------------

def frame(body: str | Column, schema_id: str | Column) -> Column:
    """``0x00`` + big-endian int32 schema id + body."""
    sid = _c(schema_id).cast("long")
    return F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(sid), 8, "0")), _c(body))


def frame_magic_ok(value: str | Column) -> Column:
    v = _c(value)
    return (F.length(v) >= 5) & (F.substring(v, 1, 1) == F.unhex(F.lit("00")))


def frame_schema_id(value: str | Column) -> Column:
    return F.conv(F.hex(F.substring(_c(value), 2, 4)), 16, 10).cast("int")


def frame_body(value: str | Column) -> Column:
    return F.substring(_c(value), 6, 2147483647)
