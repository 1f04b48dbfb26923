"""The pipelines as streams (ST1–ST17) over file-backed topics."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from conftest import positions_df
from tidewater.functions import wire
from tidewater.operators.lake import LedgerTable
from tidewater.operators.lookup import ReferenceCache
from tidewater.operators.offsets import assign_offsets
from tidewater.plans import reports
from tidewater.schemas import AVRO_POSITION, WEATHER_CSV_FIELDS, WEATHER_OBS, struct_of
from tidewater.sources import avro
from tidewater.sources.topics import FileTopic, as_messages, key_partition, topic_depth
from tidewater.streaming import pipelines as P
from tidewater.operators.warehouse import PartitionedTable


def _publish_lines(spark, topic, n, start=0, bad_every=None):
    p = positions_df(spark, n, start)
    fields = wire.position_fields_text()
    if bad_every:
        fields[2] = F.when(F.col("offset") % bad_every == 0, F.lit("x")).otherwise(fields[2])
    topic.publish(as_messages(p, wire.join_line(fields), topic.name, offset="offset", key="icao24"))


def _span(topic, start, end):
    return {topic.name: {0: start}}, {topic.name: {0: end}}


def test_pipeline2_bounded_then_restart(spark, tmp_path):
    topic = FileTopic(spark, str(tmp_path), "adsb")
    table = P.positions_table(spark, str(tmp_path / "wh"))
    rejects = P.rejects_table(spark, str(tmp_path / "rej"))
    cp = str(tmp_path / "cp")
    beats = []
    _publish_lines(spark, topic, 100)
    p2 = P.warehouse_batch(table, rejects, "p2")
    monitor = p2.monitor(beats.append).attach(spark)
    q = p2.start(topic.read_stream(), cp)
    q.awaitTermination()
    assert monitor.wait(q) and (monitor.good, monitor.bad) == (100, 0)
    s = reports.table_summary(table.read()).first()
    assert (s["positions_received"], s["aircraft_seen"]) == (100, 10)
    assert beats and beats[-1].startswith("STATUS rows=100 latest=2026-06-22 12:01:39.")
    # restart from the checkpoint: only the new messages are read
    _publish_lines(spark, topic, 50, start=100, bad_every=10)
    spark.streams.removeListener(monitor)
    again = p2.monitor(beats.append).attach(spark)
    q = P.run_warehouse(topic.read_stream(), table, rejects, cp, "p2")
    q.awaitTermination()
    assert again.wait(q) and (again.good, again.bad) == (45, 5)
    assert beats[-1].startswith("STATUS rows=145 latest=2026-06-22 12:02:29.")
    again.detach(spark)
    assert table.read().count() == 145
    assert rejects.read().count() == 5
    assert {r["error_column"] for r in rejects.read().collect()} == {"latitude"}
    per_key = reports.per_key_summary(table.read()).collect()
    assert len(per_key) == 10


def test_latest_start_survives_a_restart(spark, tmp_path):
    topic = FileTopic(spark, str(tmp_path), "adsb")
    table = P.positions_table(spark, str(tmp_path / "wh"))
    rejects = P.rejects_table(spark, str(tmp_path / "rej"))

    def run():
        cp = str(tmp_path / "cp")
        P.run_warehouse(topic.read_stream(starting="latest", checkpoint=cp), table, rejects, cp, "late").awaitTermination()
    _publish_lines(spark, topic, 10)
    run()                                           # nothing after the start yet
    _publish_lines(spark, topic, 5, start=10)       # published while stopped
    run()
    assert sorted(r["offset"] for r in table.read().collect()) == list(range(10, 15))


def test_pipeline8_dead_letters(spark, tmp_path):
    topic = FileTopic(spark, str(tmp_path), "adsb-dlq-demo")
    dlq = FileTopic(spark, str(tmp_path), "adsb-dlq-demo.dlq", 3)
    p = positions_df(spark, 100).withColumn(
        "latitude", F.when(F.col("offset") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("latitude")))
    topic.publish(as_messages(p, wire.encode_envelope(), topic.name, offset="offset", key="icao24"))
    out = PartitionedTable(spark, str(tmp_path / "jdbc"),
                           struct_of(P.ingest.ENVELOPE_TARGET).add("partition", "integer").add("offset", "long")
                           .add("load_id", "string"), ["load_id"])
    fn = P.envelope_batch(P.table_sink(out), topic.name, dlq=dlq.send)
    monitor = fn.monitor().attach(spark)
    q = P.run_envelope(topic.read_stream(), fn, str(tmp_path / "cp"))
    q.awaitTermination()
    assert monitor.wait(q) and (monitor.good, monitor.bad) == (80, 20)
    monitor.detach(spark)
    good = out.read()
    assert good.count() == 80
    assert good.select("icao24").distinct().count() == 8      # 4ca87a and 4841d8 never survive
    dead = dlq.read()
    assert dead.count() == 20
    from tidewater.operators import deadletter
    d = deadletter.describe(dead).orderBy("orig_offset").collect()
    assert [r["orig_offset"] for r in d] == list(range(0, 100, 5))
    # a key's dead letters are in one partition, numbered there in source order
    assert dead.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").count() == 0
    parts = {}
    for r in d:
        assert r["offset"] == parts.get(r["partition"], 0)
        parts[r["partition"]] = r["offset"] + 1
    assert len(parts) > 1 and d[0]["stage"] == "VALUE_CONVERTER"
    assert topic_depth(dead).first()["depth"] == 20
    # a later batch continues the dead-letter offsets from the recorded end
    more = positions_df(spark, 10, start=100).withColumn(
        "latitude", F.when(F.col("offset") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("latitude")))
    topic.publish(as_messages(more, wire.encode_envelope(), topic.name, offset="offset", key="icao24"))
    P.run_envelope(topic.read_stream(), fn, str(tmp_path / "cp")).awaitTermination()
    assert topic_depth(dlq.read()).first()["depth"] == dlq.read().count() == 22
    # fail-fast variant: no dead-letter topic, the batch fails
    strict = P.envelope_batch(P.table_sink(out), topic.name, dlq=None)
    try:
        strict(topic.read(), 99)
        raise AssertionError("expected failure")
    except ValueError as e:
        assert "offset 0" in str(e)


def test_pipeline4_bounded_in_several_batches(spark, tmp_path):
    topic = FileTopic(spark, str(tmp_path), "adsb")
    for start in (0, 10, 20):                       # three publishes = three files
        _publish_lines(spark, topic, 10, start=start)
    lake = LedgerTable(spark, str(tmp_path / "lake"), ["pos_date"])
    import glob
    n_files = len(glob.glob(f"{topic.path}/partition=*/batch=*/*.parquet"))
    P.run_lake(topic.read_stream(max_files_per_trigger=max(1, n_files // 2)), lake, str(tmp_path / "cp"), "p4").awaitTermination()
    assert lake.read().count() == 30
    assert lake.snapshots().count() >= 2            # one commit per micro-batch


def test_pipeline4_replayed_batch_is_not_duplicated(spark, tmp_path):
    topic = FileTopic(spark, str(tmp_path), "adsb")
    _publish_lines(spark, topic, 30)
    lake = LedgerTable(spark, str(tmp_path / "lake"), ["pos_date"])
    fn = P.lake_batch(lake, "p4")
    batch = topic.read()
    fn(batch, 0)
    fn(batch, 0)          # the same batch id again after a failure
    assert lake.read().count() == 30
    assert lake.snapshots().count() == 1


def test_pipeline5_reference_change_after_ttl(spark, tmp_path):
    topic = FileTopic(spark, str(tmp_path), "adsb")
    ref_path = str(tmp_path / "ref")
    ref_schema = "icao24 string, registration string, aircraft_type string, operator string, country string"
    spark.createDataFrame([("3f7062", "EI-DWA", "B738", "Ryanair", "Ireland")], ref_schema).write.parquet(ref_path)
    now = [0.0]
    cache = ReferenceCache(lambda: spark.read.parquet(ref_path), ttl_seconds=30, clock=lambda: now[0])
    lake = LedgerTable(spark, str(tmp_path / "lake"), ["pos_date"])
    fn = P.lake_batch(lake, "p5", cache=cache)
    _publish_lines(spark, topic, 10)
    fn(topic.read(*_span(topic, 0, 10)), 0)
    spark.createDataFrame([("3f7062", "EI-DWA", "B738", "Ryanair UK", "Ireland")], ref_schema) \
        .write.mode("overwrite").parquet(ref_path)
    _publish_lines(spark, topic, 10, start=10)
    now[0] = 10.0
    fn(topic.read(*_span(topic, 10, 20)), 1)           # inside the TTL: old value
    _publish_lines(spark, topic, 10, start=20)
    now[0] = 40.0
    fn(topic.read(*_span(topic, 20, 30)), 2)           # TTL passed: new value
    rows = lake.read(with_snapshot=True).where("icao24 = '3f7062'").orderBy("ts").collect()
    assert [r["operator"] for r in rows] == ["Ryanair", "Ryanair", "Ryanair UK"]
    assert lake.read().where("icao24 = '4ca87a'").first()["operator"] == "UNKNOWN"


def test_pipeline6_avro_chain_to_warehouse(spark, tmp_path):
    src = FileTopic(spark, str(tmp_path), "adsb-avro")
    lines = FileTopic(spark, str(tmp_path), "adsb-flink")
    rows = positions_df(spark, 20).select(
        "offset", "icao24", "callsign", "latitude", "longitude", "altitude", "velocity", "heading",
        "vertical_rate", "on_ground", "squawk", F.col("ts_ms").alias("ts"))
    bodies = avro.encode(rows, AVRO_POSITION, keep=["offset"]).withColumn(
        "value", F.when(F.col("offset") == 7, F.concat(F.unhex(F.lit("05")), "value"))
        .otherwise(avro.frame_column("value", F.lit(1))))
    src.publish(as_messages(bodies, "value", src.name, offset="offset"))
    rej = P.rejects_table(spark, str(tmp_path / "rej6"))
    q1 = P.run_lines(src.read_stream(), lines.publish, lines.name, {1: json.dumps(AVRO_POSITION)}, AVRO_POSITION, str(tmp_path / "cp1"), rejects=rej)
    q1.awaitTermination()
    table = P.positions_table(spark, str(tmp_path / "wh"))
    q2 = P.run_warehouse(lines.read_stream(), table, P.rejects_table(spark, str(tmp_path / "rej")),
                         str(tmp_path / "cp2"), "p6b", bounded=True)
    q2.awaitTermination()
    assert table.read().count() == 19
    assert [r["error_message"] for r in rej.read().collect()] == ["wrong magic byte"]
    # without a reject table the bad frame fails the batch and nothing is published
    strict = FileTopic(spark, str(tmp_path), "adsb-strict")
    try:
        P.avro_to_lines_batch(strict.publish, strict.name, {1: json.dumps(AVRO_POSITION)}, AVRO_POSITION)(src.read(), 0)
        raise AssertionError("expected failure")
    except Exception as e:
        assert "bad frame at offset 7" in str(e)
    assert strict.next_offsets() is None
    first = lines.read().where("offset = 0").first()
    assert bytes(first["value"]).decode().endswith("|2026-06-22|2026-06-22 12:00:00.000\n")


def test_pipeline3_hour_folders_and_idempotent_reload(spark, tmp_path):
    from conftest import text_messages
    root = str(tmp_path / "raw")
    header = ",".join(WEATHER_CSV_FIELDS)
    doc = header + "\r\n" + "\r\n".join(
        f"EGLL, 2026-06-22 11:{m:02d}:00 ,12.5,10,270,9999,0.00,1013.2,VFR" for m in (50, 55)) + "\r\n"
    P.hour_folders_batch(root)(text_messages(spark, [doc, doc.replace("EGLL", "EHAM")]), 0)
    table = PartitionedTable(spark, str(tmp_path / "obs"),
                             struct_of(WEATHER_OBS).add("landing_date", "string").add("landing_hour", "string"),
                             ["landing_date", "landing_hour"])
    for _ in range(2):        # the hourly job run twice
        P.load_hours(spark, root, WEATHER_CSV_FIELDS, WEATHER_OBS, table, hours=[("2026-06-22", "12")])
    rows = table.read().collect()
    assert len(rows) == 4
    assert str(rows[0]["observation_ts"]).startswith("2026-06-22 11:5")
    assert reports.station_summary(table.read()).count() == 2


def test_idle_stop_and_keyed_publish(spark, tmp_path):
    topic = FileTopic(spark, str(tmp_path), "adsb")
    _publish_lines(spark, topic, 10)
    sink = P.positions_table(spark, str(tmp_path / "wh"))
    idle = P.warehouse_batch(sink, P.rejects_table(spark, str(tmp_path / "rej")), "idle")
    monitor = idle.monitor().attach(spark)
    q = idle.start(topic.read_stream(), str(tmp_path / "cp"), bounded=False, every="1 second")
    assert monitor.stop_when_idle(q, idle_seconds=4, poll_seconds=0.5, max_seconds=120)
    assert not q.isActive and sink.read().count() == 10 and monitor.good == 10
    monitor.detach(spark)
    # keyed publish: one key → one partition, offsets dense per partition
    p = positions_df(spark, 40).withColumn("partition", key_partition("icao24", 3))
    keyed = assign_offsets(p, ["offset"], "partition", offset_col="poff")
    per_key = keyed.groupBy("icao24").agg(F.countDistinct("partition").alias("n")).collect()
    assert all(r["n"] == 1 for r in per_key)


def test_repeated_batches_add_nothing(spark, tmp_path):
    """A batch that ran to its end and is repeated leaves one copy everywhere."""
    from conftest import text_messages

    # pipeline 8: the dead letters and their offsets stay the same
    topic, dlq = FileTopic(spark, str(tmp_path), "env"), FileTopic(spark, str(tmp_path), "env.dlq")
    p = positions_df(spark, 20).withColumn(
        "latitude", F.when(F.col("offset") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("latitude")))
    topic.publish(as_messages(p, wire.encode_envelope(), topic.name, offset="offset", key="icao24"))
    out = PartitionedTable(spark, str(tmp_path / "jdbc"),
                           struct_of(P.ingest.ENVELOPE_TARGET).add("partition", "integer").add("offset", "long")
                           .add("load_id", "string"), ["load_id"])
    fn = P.envelope_batch(P.table_sink(out), topic.name, dlq=dlq.send)
    fn(topic.read(*_span(topic, 0, 10)), 0)
    for _ in range(2):
        fn(topic.read(*_span(topic, 10, 20)), 1)
        assert sorted(r["offset"] for r in dlq.read().collect()) == [0, 1, 2, 3]
        assert out.read().count() == 16

    # pipeline 6: the re-encoded lines
    src, lines = FileTopic(spark, str(tmp_path), "avro"), FileTopic(spark, str(tmp_path), "lines")
    rows = positions_df(spark, 6).select(
        "offset", "icao24", "callsign", "latitude", "longitude", "altitude", "velocity", "heading",
        "vertical_rate", "on_ground", "squawk", F.col("ts_ms").alias("ts"))
    framed = avro.encode(rows, AVRO_POSITION, keep=["offset"]).withColumn("value", avro.frame_column("value", F.lit(1)))
    src.publish(as_messages(framed, "value", src.name, offset="offset"))
    again = P.avro_to_lines_batch(lines.publish, lines.name, {1: json.dumps(AVRO_POSITION)}, AVRO_POSITION)
    for _ in range(2):
        again(src.read(), 0)
    assert sorted(r["offset"] for r in lines.read().collect()) == list(range(6))

    # pipeline 3: the files of the hour folders
    doc = "h\r\nrow\r\n"
    for layout in ("hive", "dated"):
        root = str(tmp_path / layout)
        folders = P.hour_folders_batch(root, layout=layout)
        folders(text_messages(spark, [doc, doc]), 0)
        folders(text_messages(spark, [doc, doc]), 0)
        folders(text_messages(spark, [doc]), 1)
        assert sum(1 for f in Path(root).rglob("part-*") if f.stat().st_size) == 3


def test_reload_of_an_hour_without_good_rows_empties_it(spark, tmp_path):
    from conftest import text_messages
    header = ",".join(WEATHER_CSV_FIELDS)
    doc = header + "\r\nEGLL,2026-06-22 11:50:00,12.5,10,270,9999,0.00,1013.2,VFR\r\n"
    table = PartitionedTable(spark, str(tmp_path / "obs"),
                             struct_of(WEATHER_OBS).add("landing_date", "string").add("landing_hour", "string"),
                             ["landing_date", "landing_hour"])
    root, hours = str(tmp_path / "raw"), [("2026-06-22", "12"), ("2026-06-22", "13")]
    P.hour_folders_batch(root)(text_messages(spark, [doc]), 0)
    P.load_hours(spark, root, WEATHER_CSV_FIELDS, WEATHER_OBS, table, hours)
    assert table.read().count() == 1
    # the hour's file is replaced by one without a usable row
    P.hour_folders_batch(root)(text_messages(spark, [doc.replace("11:50", "never")]), 0)
    P.load_hours(spark, root, WEATHER_CSV_FIELDS, WEATHER_OBS, table, hours)
    assert table.read().count() == 0


def test_lake_commits_only_its_own_write(spark, tmp_path):
    lake = LedgerTable(spark, str(tmp_path / "lake"))
    rows = spark.createDataFrame([(1, "s1"), (2, "s1"), (3, "s2")], "x int, s string")
    # what a failed write leaves: a folder without a commit
    rows.where("s = 's2'").selectExpr("x", "'s9' AS snapshot_id").write.partitionBy("snapshot_id").parquet(lake.data_path)
    assert lake.append_snapshots(rows, "s") == {"s1": 2, "s2": 1}
    assert lake.append_snapshots(rows, "s") == {}
    assert sorted(r["x"] for r in lake.read().collect()) == [1, 2, 3]
    assert [(r["snapshot_id"], r["sequence_number"]) for r in lake.snapshots().orderBy("sequence_number").collect()] == [("s1", 1), ("s2", 2)]
    lake.overwrite(rows.where("false").select("x"), "s3")
    assert lake.read().count() == 0 and lake.read(snapshot_id="s2").count() == 3
