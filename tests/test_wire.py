"""Wire formats and the traps around them."""

from pyspark.sql import functions as F

from conftest import text_messages
from tidewater.functions import wire
from tidewater.operators import ingest

GOOD = "4ca87a|EIN101|51.470000|-0.460000|37000|490.5|285.1|0|0|2341|2026-06-22|2026-06-22 12:00:00.005"


def _split(spark, lines):
    parsed = ingest.parse_delimited(text_messages(spark, lines))
    return ingest.warehouse_split(parsed)


def test_trailing_newline_optional(spark):
    good, rejects = _split(spark, [GOOD + "\n", GOOD])
    rows = good.orderBy("offset").collect()
    assert len(rows) == 2 and rejects.count() == 0
    assert str(rows[0]["ts"]) == "2026-06-22 12:00:00.005000"
    assert rows[0]["ts"] == rows[1]["ts"]


def test_field_count_is_checked(spark):
    short = GOOD.rsplit("|", 1)[0]
    long = GOOD + "|extra"
    good, rejects = _split(spark, [short + "\n", long + "\n"])
    assert good.count() == 0
    msgs = sorted(r["error_message"] for r in rejects.collect())
    assert msgs == ["expected 12 fields, got 11", "expected 12 fields, got 13"]
    assert {r["error_stage"] for r in rejects.collect()} == {"PARSE"}


def test_cast_failures_and_constraints(spark):
    cases = [
        GOOD.replace("51.470000", "abc"),                    # non-numeric latitude
        GOOD.replace("51.470000", ""),                       # empty NOT NULL field
        GOOD.replace("2026-06-22|2026", "2031-01-01|2026"),  # no partition for date
        GOOD.replace("4ca87a", "4ca87a1"),                   # CHAR(6) overflow
        GOOD.replace("|EIN101|", "||"),                      # empty nullable field: fine
    ]
    good, rejects = _split(spark, [c + "\n" for c in cases])
    bad = {r["offset"]: (r["error_column"], r["error_message"]) for r in rejects.collect()}
    assert bad[0] == ("latitude", "cannot cast to decimal(9,6)")
    assert bad[1] == ("latitude", "null in NOT NULL column")
    assert bad[2] == ("pos_date", "no partition for date")
    assert bad[3] == ("icao24", "longer than 6")
    assert [r["offset"] for r in good.collect()] == [4]


def test_decimal_rounds_half_up(spark):
    line = GOOD.replace("51.470000", "51.4700005").replace("490.5", "490.555")
    good, _ = _split(spark, [line])
    row = good.first()
    assert str(row["latitude"]) == "51.470001" and str(row["velocity"]) == "490.56"


def test_millis_variants(spark):
    lines = [GOOD.replace(".005", m) for m in (".005", ".500", ".000")]
    good, _ = _split(spark, lines)
    micros = sorted(r["ts"].microsecond for r in good.collect())
    assert micros == [0, 5000, 500000]


def test_concat_is_null_propagating(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(wire.join_line([F.col("x"), F.col("y")]).alias("l")).first()["l"] is None


def test_epoch_ms_text_integer_division(spark):
    df = spark.createDataFrame([(-1,), (5,), (1782129600500,)], "ms long")
    got = [r[0] for r in df.select(wire.epoch_ms_text("ms")).collect()]
    assert got == ["1969-12-31 23:59:59.999", "1970-01-01 00:00:00.005", "2026-06-22 12:00:00.500"]


ENV_OK = ('{"schema":{"type":"struct","fields":[{"field":"latitude","type":"double","optional":false},'
          '{"field":"icao24","type":"string","optional":true}],"optional":false,"name":"P"},'
          '"payload":{"icao24":"4ca87a","latitude":51.47,"extra":1}}')


def test_envelope_required_fields(spark):
    cases = [
        ENV_OK,
        ENV_OK.replace("51.47", "null"),
        ENV_OK.replace('"latitude":51.47,', ""),
        "not json",
        '{"payload":{"latitude":1.0}}',
    ]
    parsed = ingest.parse_envelope(text_messages(spark, cases))
    probs = {r["offset"]: r["p"] for r in parsed.select("offset", ingest.envelope_problem().alias("p")).collect()}
    assert probs[0] is None
    assert probs[1] == probs[2] == "null value for required field latitude"
    assert probs[3] == "value is not a JSON object"
    assert probs[4] == "envelope needs schema and payload"
    rows = ingest.envelope_rows(parsed, whitelist=["icao24", "latitude"]).collect()
    assert len(rows) == 1 and rows[0]["latitude"] == 51.47 and "extra" not in rows[0].asDict()


def test_envelope_encode_keeps_nulls(spark):
    from conftest import positions_df
    p = positions_df(spark, 1).withColumn("latitude", F.lit(None).cast("double"))
    text = p.select(wire.encode_envelope().alias("v")).first()["v"]
    assert '"latitude":null' in text and '"optional":false' in text


def test_frame_layout(spark):
    df = spark.createDataFrame([(bytearray(b"body"), 258)], "b binary, id int")
    v = df.select(wire.frame("b", "id").alias("v")).first()["v"]
    assert bytes(v) == b"\x00\x00\x00\x01\x02body"
    back = df.select(wire.frame("b", "id").alias("v")).select(
        wire.frame_magic_ok("v").alias("ok"), wire.frame_schema_id("v").alias("id"),
        wire.frame_body("v").alias("body")).first()
    assert back["ok"] and back["id"] == 258 and bytes(back["body"]) == b"body"


def test_error_policies(spark):
    import pytest
    lines = [GOOD, GOOD.rsplit("|", 1)[0], GOOD.replace("51.470000", "abc")]
    parsed = ingest.parse_delimited(text_messages(spark, lines))
    dropped = ingest.to_lake(parsed, keep=["offset"], policy="drop").orderBy("offset").collect()
    # drop: the malformed line is skipped, the bad field becomes NULL
    assert [r["offset"] for r in dropped] == [0, 2] and dropped[1]["latitude"] is None
    with pytest.raises(Exception, match="malformed line|bad record"):
        ingest.to_lake(parsed, policy="fail").collect()
    typed = ingest.to_lake(ingest.parse_delimited(text_messages(spark, [lines[2]])), keep=["offset"],
                           policy="reject")
    from tidewater.functions import casting
    assert casting.reject_rows(typed, ["offset"]).first()["error_column"] == "latitude"
    with pytest.raises(Exception, match="bad record: latitude"):
        casting.good_rows(typed, "fail").collect()
