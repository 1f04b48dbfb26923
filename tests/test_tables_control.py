"""Table DDL/purge, catalog introspection, SQL table function, run control."""

import pytest
from pyspark.sql import functions as F

from conftest import positions_df
from tidewater.functions import avro_codec as codec
from tidewater.functions import wire
from tidewater.operators import ingest
from tidewater.operators.warehouse import POSITIONS, PartitionedTable, WarehouseTable, create_namespace, ddl, ingest_time, load_batch
from tidewater.schemas import AVRO_PRODUCT_V1, AVRO_PRODUCT_V2, WAREHOUSE_POSITIONS, Target
from tidewater.sources import avro
from tidewater.sources.topics import FileTopic, as_messages
from tidewater.streaming import control


def test_ddl_defaults_and_not_null(spark, tmp_path):
    text = ddl("adsb_positions", WAREHOUSE_POSITIONS, ["pos_date"], location=str(tmp_path / "t"))
    assert "icao24 STRING NOT NULL" in text and "on_ground TINYINT DEFAULT 0" in text
    spark.sql("DROP TABLE IF EXISTS adsb_positions")
    spark.sql(text)
    cols = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE adsb_positions").collect()}
    assert cols["latitude"] == "decimal(9,6)" and cols["ts"] == "timestamp_ntz"
    spark.sql("INSERT INTO adsb_positions (icao24, pos_date, latitude, longitude, ts) VALUES "
              "('4ca87a', DATE'2026-06-22', 51.47, -0.46, TIMESTAMP_NTZ'2026-06-22 12:00:00')")
    assert spark.table("adsb_positions").first()["on_ground"] == 0
    spark.sql("DROP TABLE adsb_positions")


def test_purge_and_ingest_time(spark, tmp_path):
    t = PartitionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "k int, d string").schema, ["d"])
    t.write(spark.createDataFrame([(1, "a")], "k int, d string"))
    assert t.read().count() == 1
    t.purge()
    assert t.read().count() == 0
    ts = spark.range(1).select(ingest_time().alias("t")).first()["t"]
    assert ts.microsecond == 0


def test_container_split_from_sql(spark):
    avro.register_container_split(spark, AVRO_PRODUCT_V2)
    blob = codec.write_container(AVRO_PRODUCT_V1, [
        {"product_id": "a", "name": "n", "price": 2.0, "category": "c", "ts": 1}])
    spark.createDataFrame([(1, bytearray(blob))], "stage_id int, container binary").createOrReplaceTempView("stage")
    rows = spark.sql("SELECT t.* FROM stage, LATERAL avro_container_split(stage_id, container) t").collect()
    assert len(rows) == 1 and rows[0]["validity"] == "OK"
    assert '"discount_pct": null' in rows[0]["avro"]


def test_drain_wait_and_latest_start(spark, tmp_path):
    topic = FileTopic(spark, str(tmp_path), "adsb")
    p = positions_df(spark, 10)
    topic.publish(as_messages(p, wire.encode_delimited(), topic.name, offset="offset"))
    seen = []
    q = control.start(topic.read_stream().writeStream.foreachBatch(lambda df, i: seen.append(df.count())), str(tmp_path / "cp"),
                      bounded=False, every="1 second")
    control.drain_and_stop(q)
    assert sum(seen) == 10 and not q.isActive
    assert control.wait_for_rows(lambda: sum(seen), 10, poll_seconds=0.1, timeout_seconds=1) == 10
    # a stream started at "latest" ignores what is already in the topic
    latest = []
    q2 = control.start(topic.read_stream(starting="latest").writeStream.foreachBatch(
        lambda df, i: latest.append(df.count())), str(tmp_path / "cp2"), bounded=True)
    q2.awaitTermination()
    assert sum(latest) == 0
    topic.publish(as_messages(positions_df(spark, 3, start=10), wire.encode_delimited(), topic.name,
                              offset="offset"))
    late = topic.read_stream(starting={"adsb": {0: 10}})
    q3 = control.start(late.writeStream.foreachBatch(lambda df, i: latest.append(df.count())),
                       str(tmp_path / "cp3"), bounded=True)
    q3.awaitTermination()
    assert sum(latest) == 3


def test_catalog_table_fills_defaults_and_checks_not_null(spark, tmp_path):
    t = WarehouseTable(spark, "wh_positions", POSITIONS, ["pos_date", "load_id"], str(tmp_path / "wh")).create()
    good, _ = ingest.warehouse_split(ingest.parse_delimited(_lines(spark, 20), keep=["partition", "offset"]), keep=["partition", "offset"])
    load_batch(t, good, "l1")
    load_batch(t, good.where("offset < 5"), "l2")
    load_batch(t, good.where("offset < 7"), "l2")             # the same load again replaces its rows
    rows = t.read()
    assert rows.count() == 27 and rows.where("ingest_ts IS NULL").count() == 0
    assert rows.first()["ingest_ts"].microsecond == 0
    # a column the insert does not name gets its constant DEFAULT as well
    load_batch(t, good.limit(1).drop("on_ground"), "l3")
    assert t.read().where("load_id = 'l3'").first()["on_ground"] == 0
    with pytest.raises(Exception, match="NULL in NOT NULL column icao24"):
        load_batch(t, good.withColumn("icao24", F.lit(None).cast("string")), "l4")
    with pytest.raises(ValueError, match="no value for ts"):
        load_batch(t, good.drop("ts"), "l4")
    assert t.read().count() == 28
    # forgotten by the catalog, found again at its location
    spark.sql("DROP TABLE wh_positions")
    assert t.create().read().count() == 28
    t.write(good.limit(0).withColumn("load_id", F.lit("x")), replace=[{"pos_date": "2026-06-22", "load_id": "l3"}])
    assert t.read().count() == 27
    t.purge()
    assert t.read().count() == 0
    spark.sql("DROP TABLE wh_positions")


def _lines(spark, n):
    p = positions_df(spark, n)
    return as_messages(p, wire.join_line(wire.position_fields_text()), "t", offset="offset", key="icao24")


def test_pipeline_writes_a_catalog_table(spark, tmp_path):
    from tidewater.streaming import pipelines as P
    topic = FileTopic(spark, str(tmp_path), "t")
    topic.publish(_lines(spark, 12))
    t = WarehouseTable(spark, "wh_stream", POSITIONS, ["pos_date", "load_id"], str(tmp_path / "wh")).create()
    P.run_warehouse(topic.read_stream(), t, P.rejects_table(spark, str(tmp_path / "rej")), str(tmp_path / "cp"), "s").awaitTermination()
    assert t.read().count() == 12 and t.read().where("ingest_ts IS NULL").count() == 0
    spark.sql("DROP TABLE wh_stream")


def test_namespaces_keep_tables_apart(spark, tmp_path):
    made = {}
    for ns in ("demo_a", "demo_b"):
        create_namespace(spark, ns, str(tmp_path / ns))
        create_namespace(spark, ns, str(tmp_path / ns))        # there already
        made[ns] = WarehouseTable(spark, f"{ns}.obs", [Target("k", "int"), Target("d", "string")], ["d"], str(tmp_path / ns / "obs")).create()
    made["demo_a"].write(spark.createDataFrame([(1, "x")], "k int, d string"))
    assert made["demo_a"].read().count() == 1 and made["demo_b"].read().count() == 0
    assert {"demo_a", "demo_b"} <= {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert [r["tableName"] for r in spark.sql("SHOW TABLES IN demo_b").collect() if not r["isTemporary"]] == ["obs"]
    for ns in made:
        spark.sql(f"DROP DATABASE {ns} CASCADE")
    assert not {"demo_a", "demo_b"} & {r[0] for r in spark.sql("SHOW DATABASES").collect()}
