"""Pipelines on any source and target, offsets per partition, counts by
listener, quarantine, processing time, malformed JSON."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import positions_df, text_messages
from tidewater.functions import wire
from tidewater.operators import ingest
from tidewater.operators.lake import LedgerTable
from tidewater.operators.lookup import KeyedCache
from tidewater.operators.warehouse import PartitionedTable
from tidewater.schemas import AVRO_POSITION, TOPIC_SCHEMA, struct_of
from tidewater.sources import avro, topics
from tidewater.sources.topics import FileTopic, as_messages
from tidewater.streaming import pipelines as P


def lines(spark, n, start=0, partition=0, bad=()):
    fields = wire.position_fields_text()
    fields[2] = F.when(F.col("offset").isin(*bad) if bad else F.lit(False), F.lit("x")).otherwise(fields[2])
    return as_messages(positions_df(spark, n, start), wire.join_line(fields), "t", offset="offset", key="icao24", partition=partition)


def plain_stream(spark, path, schema=TOPIC_SCHEMA, files=1):
    """A file stream of somebody else's: no topic of this package."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


# --- record layout and offsets ------------------------------------------------

def test_offset_maps_and_json():
    told = {"b": {1: -1, 0: 23}, "a": {"2": -2}}
    text = topics.offsets_json(told)
    assert json.loads(text) == {"a": {"2": -2}, "b": {"0": 23, "1": -1}}
    assert topics.offsets_map(text) == {"a": {2: -2}, "b": {0: 23, 1: -1}}
    assert topics.offset_option("latest") == "latest" and topics.offset_option(told) == text
    for bad in ({"a": {0: -3}}, {"a": {-1: 0}}):
        with pytest.raises(ValueError):
            topics.offsets_json(bad)


def test_kafka_source_options():
    make = topics.kafka_source_options
    assert make("h:9092", "t", stream=True) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest", "includeHeaders": "true"}
    assert make("h:9092", ["t", "u"], stream=True, starting={"u": {0: 5}}, max_per_trigger=100, group="g", more={"failOnDataLoss": "false"}) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t,u", "startingOffsets": '{"u": {"0": 5}}', "includeHeaders": "true",
        "maxOffsetsPerTrigger": "100", "kafka.group.id": "g", "failOnDataLoss": "false"}
    assert make("h:9092", "t", stream=False, starting={"t": {0: 1, 1: -2}}, ending={"t": {0: 9, 1: -1}}) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": '{"t": {"0": 1, "1": -2}}',
        "endingOffsets": '{"t": {"0": 9, "1": -1}}', "includeHeaders": "true"}
    for wrong in (dict(stream=True, ending={"t": {0: 1}}), dict(stream=False, starting="latest"), dict(stream=True, starting={"u": {0: 1}})):
        with pytest.raises(ValueError):
            make("h:9092", "t", **wrong)


def test_kafka_sink_options_and_what_is_sent(spark):
    assert topics.kafka_sink_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "topic": "t", "includeHeaders": "true"}
    assert topics.kafka_sink_options("h:9092", "t", "/cp", {"kafka.acks": "all"}) == {
        "kafka.bootstrap.servers": "h:9092", "topic": "t", "includeHeaders": "true", "checkpointLocation": "/cp", "kafka.acks": "all"}
    assert topics.outgoing(lines(spark, 1)).columns == ["key", "value", "headers"]


def test_ranges_per_partition(spark):
    both = lines(spark, 10).unionByName(lines(spark, 10, partition=1)).unionByName(lines(spark, 10, partition=2))
    got = topics.bounded(both, {"t": {0: 4, 1: -2}, "other": {2: 9}}, json.dumps({"t": {"0": 8, "1": 3}}))
    found = {r[0]: (r[1], r[2]) for r in got.groupBy("partition").agg(F.min("offset"), F.max("offset")).collect()}
    assert found == {0: (4, 7), 1: (0, 2), 2: (0, 9)}
    assert topics.bounded(both).count() == 30
    with pytest.raises(ValueError):
        topics.bounded(both, "latest")


def test_records_completes_and_checks_the_layout(spark):
    short = spark.createDataFrame([("v", "t", 0, 1)], "value string, topic string, partition long, offset int")
    out = topics.records(short)
    assert out.schema.fieldNames() == TOPIC_SCHEMA.fieldNames() and [f.dataType for f in out.schema] == [f.dataType for f in TOPIC_SCHEMA]
    assert bytes(out.first()["value"]) == b"v" and out.first()["key"] is None
    with pytest.raises(ValueError, match="offset missing"):
        topics.records(short.drop("offset"))


def test_keyed_partitions_spread_and_hold_keys_together(spark):
    got = spark.range(400).select(topics.key_partition(F.col("id").cast("string"), 4).alias("p")).groupBy("p").count().collect()
    assert sorted(r["p"] for r in got) == [0, 1, 2, 3] and min(r["count"] for r in got) > 50
    assert spark.range(1).select(topics.key_partition(F.lit(None).cast("string"), 4).alias("p")).first()["p"] == 0


# --- every run_* on a plain stream ----------------------------------------------

def test_every_pipeline_takes_a_plain_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    lines(spark, 8, bad=(3,)).coalesce(1).write.parquet(src)
    lines(spark, 8, start=8, partition=1).coalesce(1).write.mode("append").parquet(src)
    table, rejects = P.positions_table(spark, str(tmp_path / "wh")), P.rejects_table(spark, str(tmp_path / "rej"))
    P.run_warehouse(plain_stream(spark, src), table, rejects, str(tmp_path / "c1"), "w").awaitTermination()
    assert (table.read().count(), rejects.read().count()) == (15, 1)

    lake = LedgerTable(spark, str(tmp_path / "lake"), ["pos_date"])
    P.run_lake(plain_stream(spark, src), lake, str(tmp_path / "c2"), "l").awaitTermination()
    assert lake.read().count() == 16 and lake.read().where("latitude IS NULL").count() == 1

    env = str(tmp_path / "env")
    p = positions_df(spark, 6).withColumn("latitude", F.when(F.col("offset") != 2, F.col("latitude")))
    as_messages(p, wire.encode_envelope(), "e", offset="offset", key="icao24").coalesce(1).write.parquet(env)
    sent = {}
    out = P.envelope_batch(lambda rows, n: sent.setdefault("good", rows.count()), "e",
                           dlq=lambda rows, n: sent.setdefault("dead", [(r["source_offset"], r["key"] is not None) for r in rows.collect()]))
    P.run_envelope(plain_stream(spark, env), out, str(tmp_path / "c3")).awaitTermination()
    assert sent == {"good": 5, "dead": [(2, True)]}

    framed = str(tmp_path / "framed")
    rows = positions_df(spark, 4).select("offset", "icao24", "callsign", "latitude", "longitude", "altitude", "velocity", "heading",
                                         "vertical_rate", "on_ground", "squawk", F.col("ts_ms").alias("ts"))
    body = avro.encode(rows, AVRO_POSITION, keep=["offset"]).withColumn("value", avro.frame_column("value", F.lit(1)))
    as_messages(body, "value", "f", offset="offset").coalesce(1).write.parquet(framed)
    told = []
    P.run_lines(plain_stream(spark, framed), lambda m, n: told.append((m.count(), m.columns)), "lines", {1: json.dumps(AVRO_POSITION)}, AVRO_POSITION,
                str(tmp_path / "c4")).awaitTermination()
    assert told == [(4, TOPIC_SCHEMA.fieldNames())]

    P.run_hour_folders(plain_stream(spark, src), str(tmp_path / "hours"), str(tmp_path / "c5"), records_per_file=100).awaitTermination()
    assert spark.read.text(str(tmp_path / "hours")).count() == 16


def test_any_write_stream_target(spark, tmp_path):
    src = str(tmp_path / "src")
    lines(spark, 9, bad=(4,)).coalesce(1).write.parquet(src)
    P.run_lake(plain_stream(spark, src), None, str(tmp_path / "c1"), "m", policy="drop",
               target=lambda rows: rows.writeStream.format("parquet").option("path", str(tmp_path / "out"))).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 9 and P.PROC_TIME not in got.columns
    table, rejects = P.positions_table(spark, str(tmp_path / "wh")), P.rejects_table(spark, str(tmp_path / "rej"))
    w = P.warehouse_batch(table, rejects, "mem")
    monitor = w.monitor().attach(spark)
    q = w.start(plain_stream(spark, src), str(tmp_path / "c2"), target=lambda rows: rows.writeStream.format("memory").queryName("mem_rows").outputMode("append"))
    q.awaitTermination()
    assert spark.table("mem_rows").count() == 8 and monitor.wait(q) and (monitor.good, monitor.bad) == (8, 1)
    monitor.detach(spark)


# --- counts by listener -----------------------------------------------------------

def test_lake_counts_come_by_listener(spark, tmp_path):
    src = str(tmp_path / "src")
    for k, bad in enumerate(((1,), (), (21, 22))):
        lines(spark, 10, start=10 * k, bad=bad).coalesce(1).write.mode("append").parquet(src)
    quarantine = P.rejects_table(spark, str(tmp_path / "bad"))
    lake = LedgerTable(spark, str(tmp_path / "lake"), ["pos_date"])
    p5 = P.lake_batch(lake, "p5", policy="reject", quarantine=quarantine)
    monitor = p5.monitor().attach(spark)
    q = p5.start(plain_stream(spark, src), str(tmp_path / "cp"))
    q.awaitTermination()
    assert monitor.wait(q)
    assert len(monitor.batches) == 3 and (monitor.good, monitor.bad) == (27, 3)
    assert (lake.read().count(), quarantine.read().count()) == (27, 3)
    assert monitor.status() == "STATUS rows=27 latest=2026-06-22 12:00:29.010"
    monitor.detach(spark)


class Event:
    def __init__(self, batch, rows, good, bad, latest=None, name="s"):
        self.progress = type("P", (), dict(batchId=batch, runId="r", numInputRows=rows,
                                           observedMetrics={f"counts-{name}": {"good": good, "bad": bad, "latest": latest}}))


def test_monitor_counts_a_repeated_batch_once_and_stops_when_idle():
    now, beats = [0.0], []
    m = P.control.RunMonitor("s", beats.append, base=lambda first: (100 if first == 3 else 0, "2026-01-01 00:00:00"), clock=lambda: now[0])
    m.onQueryProgress(Event(3, 5, 4, 1, "2026-01-02 00:00:00.5"))
    m.onQueryProgress(Event(3, 5, 4, 1, "2026-01-02 00:00:00.5"))
    m.onQueryProgress(Event(9, 5, 7, 7, name="other"))
    m.onQueryProgress(Event(4, 0, 0, 0))
    assert (m.good, m.bad) == (4, 1)
    assert beats == ["STATUS rows=104 latest=2026-01-02 00:00:00.500"] * 2

    class Query:
        isActive, status, stopped = True, {"isTriggerActive": False}, 0.0

        def stop(self):
            self.stopped = now[0]

    def sleep(s):
        now[0] += s
        if now[0] == 3:
            m.onQueryProgress(Event(5, 1, 1, 0))
        Query.status = {"isTriggerActive": 5 <= now[0] < 9, "isDataAvailable": True}  # a long batch

    q = Query()
    assert m.stop_when_idle(q, 4, poll_seconds=1, sleep=sleep) and q.stopped == 12
    assert not m.stop_when_idle(Query(), 100, poll_seconds=1, max_seconds=5, sleep=sleep)


# --- quarantine --------------------------------------------------------------------

def test_lake_quarantine_balances_and_a_repeated_batch_adds_nothing(spark, tmp_path):
    good = wire.join_line(wire.position_fields_text())
    ok = [r[0].strip("\n") + "\n" for r in positions_df(spark, 3).select(good).collect()]
    msgs = text_messages(spark, [ok[0], None, "a|b\n", ok[1].replace("|37000|", "|high|").replace("|36999|", "|high|"), ok[2], ""])
    lake, quarantine = LedgerTable(spark, str(tmp_path / "lake")), P.rejects_table(spark, str(tmp_path / "bad"))
    fn = P.lake_batch(lake, "q", policy="reject", quarantine=quarantine)
    for _ in range(2):
        fn(msgs, 0)
        assert lake.read().count() == 2
        told = {r["offset"]: (r["error_stage"], r["error_column"]) for r in quarantine.read().collect()}
        assert told == {1: ("PARSE", None), 2: ("PARSE", None), 3: ("CAST", "altitude"), 5: ("PARSE", None)}
    with pytest.raises(ValueError):
        P.lake_batch(lake, "q", policy="reject")
    with pytest.raises(ValueError):
        P.lake_batch(lake, "q", quarantine=quarantine)
    with pytest.raises(Exception, match="bad record"):
        P.lake_batch(lake, "q", policy="fail")(msgs, 1)


# --- processing time ------------------------------------------------------------------

def test_processing_time_is_one_value_per_batch_and_is_not_written(spark, tmp_path):
    src = str(tmp_path / "src")
    for k in range(3):
        lines(spark, 20, start=20 * k).repartition(4).coalesce(1).write.mode("append").parquet(src)
    lake = LedgerTable(spark, str(tmp_path / "lake"))
    seen = []
    p = P.lake_batch(lake, "pt")
    inner = p.write

    def write(rows, name):
        seen.append([r[0] for r in rows.select(P.PROC_TIME).distinct().collect()])
        inner(rows, name)
    p.write = write
    p.start(plain_stream(spark, src), str(tmp_path / "cp")).awaitTermination()
    assert [len(x) for x in seen] == [1, 1, 1] and seen[0] < seen[1] < seen[2]
    assert lake.read().count() == 60 and P.PROC_TIME not in lake.read().columns


def test_lookups_expire_by_processing_time(spark, tmp_path):
    ref = "icao24 string, registration string, aircraft_type string, operator string, country string"
    state, asked = ["one"], []

    def load(keys):
        asked.append(keys.count())
        return spark.createDataFrame([("4ca87a", "R", "T", state[0], "IE")], ref).join(keys, "icao24", "left_semi")

    rows = spark.createDataFrame([("4ca87a", 1), ("zz", 2)], "icao24 string, n int")
    cache = KeyedCache(load, ttl_seconds=30)

    def at(second):
        batch = rows.withColumn(P.PROC_TIME, F.lit(dt.datetime(2026, 1, 1, 0, 0, second)))
        return sorted(r["operator"] for r in P.enrich(batch, cache).collect())

    assert at(0) == ["UNKNOWN", "one"]
    state[0] = "two"
    assert at(29) == ["UNKNOWN", "one"] and asked == [2]
    assert at(30) == ["UNKNOWN", "two"] and asked == [2, 2]
    empty = rows.limit(0).withColumn(P.PROC_TIME, F.current_timestamp())
    assert P.enrich(empty, cache).collect() == []


def test_lake_pipeline_with_a_keyed_cache(spark, tmp_path):
    src = str(tmp_path / "src")
    lines(spark, 10).coalesce(1).write.parquet(src)
    lines(spark, 10, start=10).coalesce(1).write.mode("append").parquet(src)
    ref = spark.createDataFrame([("3f7062", "EI-DWA", "B738", "Ryanair", "Ireland")],
                                "icao24 string, registration string, aircraft_type string, operator string, country string")
    cache = KeyedCache(lambda keys: ref.join(keys, "icao24", "left_semi"), ttl_seconds=3600)
    lake = LedgerTable(spark, str(tmp_path / "lake"), ["pos_date"])
    P.run_lake(plain_stream(spark, src), lake, str(tmp_path / "cp"), "p5", cache=cache).awaitTermination()
    got = {(r["icao24"], r["operator"]) for r in lake.read().collect()}
    assert lake.read().count() == 20 and ("3f7062", "Ryanair") in got and ("4ca87a", "UNKNOWN") in got
    assert cache.asked == 10                      # the second batch asked nothing


# --- malformed flat JSON ---------------------------------------------------------------

def test_malformed_json_under_the_three_policies(spark):
    ok = positions_df(spark, 1).select(wire.encode_json().alias("v")).first()["v"]
    texts = [ok, None, "", "{", "[1, 2]", "7", ok.replace('"altitude":37000', '"altitude":"up"'), '{"icao24": "x"}', ok[:30], '{"a": {"b": 1}}']
    typed = ingest.classify_json(text_messages(spark, texts))
    good = {r["offset"] for r in ingest.good_of(typed).collect()}
    bad = {r["offset"]: (r["error_stage"], r["error_column"]) for r in ingest.rejects_of(typed).collect()}
    assert good == {0, 7, 9} and set(bad) == {1, 2, 3, 4, 5, 6, 8}
    assert bad[6] == ("CAST", "altitude") and {bad[k][0] for k in (1, 2, 3, 4, 5, 8)} == {"PARSE"}
    assert ingest.good_of(typed, "drop").count() == 3
    with pytest.raises(Exception, match="bad record"):
        ingest.good_of(typed, "fail").collect()


def test_dead_letters_without_a_key_go_to_one_partition(spark, tmp_path):
    dlq = FileTopic(spark, str(tmp_path), "d", 4)
    rows = spark.range(6).select(F.lit(None).cast("binary").alias("key"), F.encode(F.col("id").cast("string"), "UTF-8").alias("value"),
                                 F.lit(0).alias("source_partition"), F.col("id").alias("source_offset"))
    for name in ("b0", "b0", "b1"):
        dlq.send(rows, name)
    got = dlq.read().collect()
    assert {r["partition"] for r in got} == {0} and sorted(r["offset"] for r in got) == list(range(12))
    out = PartitionedTable(spark, str(tmp_path / "x"), struct_of([]).add("a", T.LongType()).add("load_id", T.StringType()), ["load_id"])
    assert out.read().count() == 0
