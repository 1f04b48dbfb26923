"""No record is lost: what does not load is a reject or a dead letter."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import text_messages
from tidewater.functions import wire
from tidewater.operators import ingest
from tidewater.operators.warehouse import PartitionedTable
from tidewater.plans import reports
from tidewater.session import scratch_path

LINE = "4ca87a|EIN101|51.47|-0.46|37000|490.5|285.1|0|{flag}|2341|2026-06-22|2026-06-22 12:00:00.000\n"


def test_null_message_and_bad_flag_are_rejects(spark):
    lines = [LINE.format(flag=0), None, "short|line\n", LINE.format(flag="garbage"), LINE.format(flag="")]
    good, rejects = ingest.warehouse_split(ingest.parse_delimited(text_messages(spark, lines)))
    told = {r.offset: (r.error_stage, r.error_column, r.error_message) for r in rejects.collect()}
    assert sorted(r.offset for r in good.collect()) == [0, 4]
    assert set(told) == {1, 2, 3}
    assert told[1][0] == "PARSE" and told[3][1] == "on_ground"


def test_wrong_typed_envelope_is_unusable(spark, request):
    from conftest import positions_df

    p = positions_df(spark, 3)
    value = p.select(wire.encode_envelope().alias("v")).first().v
    value = value.decode() if isinstance(value, (bytes, bytearray)) else value
    broken = json.loads(value)
    broken["payload"]["latitude"] = "abc"
    parsed = ingest.parse_envelope(text_messages(spark, [value, json.dumps(broken), None, "{"]))
    good = ingest.envelope_rows(parsed)
    assert good.count() == 1
    problems = parsed.where(ingest.envelope_usable(False)).select("offset", ingest.envelope_problem().alias("p")).collect()
    assert {r.offset for r in problems} == {1, 2, 3}
    assert next(r.p for r in problems if r.offset == 1) == "wrong type for field latitude"


def test_loads_and_epoch_text_in_a_plain_session(spark):
    plain = spark.newSession()
    plain.conf.set("spark.sql.session.timeZone", "America/New_York")
    plain.conf.unset("spark.sql.sources.partitionOverwriteMode")
    path = scratch_path(spark, "plain-session", unique=True)
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("load_id", T.StringType())])
    table = PartitionedTable(plain, path, schema, ["load_id"])
    for load in ("a", "b", "b"):
        table.write(plain.range(2).select(F.col("id").alias("x"), F.lit(load).alias("load_id")))
    assert table.read().count() == 4
    ms = plain.sql("SELECT 1782129600005L AS ms UNION ALL SELECT -1L")
    told = {tuple(r) for r in ms.select(wire.epoch_ms_text("ms"), wire.epoch_ms_date_text("ms")).collect()}
    assert told == {("2026-06-22 12:00:00.005", "2026-06-22"), ("1969-12-31 23:59:59.999", "1969-12-31")}


def test_sample_does_not_follow_the_partitioning(spark):
    from conftest import positions_df

    p = positions_df(spark, 100)
    one = [r.offset for r in reports.sample_n(p.repartition(7), 10, 42, ["icao24", "ts"]).collect()]
    assert one == [r.offset for r in reports.sample_n(p.coalesce(1), 10, 42, ["icao24", "ts"]).collect()] and len(one) == 10
