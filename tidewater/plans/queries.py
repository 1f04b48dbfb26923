"""The registered queries: each pipeline stage and report on the driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB text in ``plans.oracle``.  Inputs are the analog views
of ``plans.views``; messages are produced from them with Spark expressions,
pushed through the same decoders and sinks a live pipeline uses, and the
result read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import casting, wire
from tidewater.operators import deadletter, ingest
from tidewater.operators.lake import LedgerTable
from tidewater.operators.lookup import KeyedCache, ReferenceCache, lookup_join
from tidewater.operators.offsets import assign_offsets
from tidewater.operators.warehouse import POSITIONS, PartitionedTable, WarehouseTable
from tidewater.plans import reports, views
from tidewater.schemas import (
    AVRO_POSITION,
    AVRO_PRODUCT_V1,
    AVRO_PRODUCT_V2,
    WAREHOUSE_POSITIONS,
    WEATHER_CSV_FIELDS,
    WEATHER_OBS,
    struct_of,
)
from tidewater.session import scratch_path, scratch_root
from tidewater.sources import avro, files
from tidewater.sources.topics import FileTopic, as_messages, topic_depth
from tidewater.streaming import pipelines

POSITIONS_TOPIC = "adsb-positions"
ENVELOPE_TOPIC = "adsb-positions-envelope"
DLQ_TOPIC = "adsb-positions-envelope.dlq"
CONNECTOR = "jdbc-sink-dlq"
# Example key for the by-key report and the reference update.
EXAMPLE_KEY = "000007"
SAMPLE_SEED = 42


# --- message producers over the views --------------------------------------

def delimited_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe-delimited messages with the producer's faults injected:
    blank latitude on offsets 0, 5, 10, …; a truncated line on 3, 10, 17, …"""
    return as_messages(views.positions(spark, sf_dir), views.memo("faulty_line", _faulty_line),
                       POSITIONS_TOPIC, offset="event_id", key="icao24", timestamp="ts")


def _faulty_line():
    fields = wire.position_fields_text()
    fields[2] = F.when(views.is_injected(), F.lit("")).otherwise(fields[2])
    return F.when(views.is_truncated(), wire.join_line(fields[:-1])).otherwise(wire.join_line(fields))


def envelope_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema-and-payload JSON messages, latitude NULL on injected offsets."""
    p = views.positions(spark, sf_dir).withColumn(
        "latitude", F.when(views.is_injected(), F.lit(None).cast("double")).otherwise(F.col("latitude")))
    return as_messages(p, views.memo("envelope", wire.encode_envelope), ENVELOPE_TOPIC,
                       offset="event_id", key="icao24", timestamp="ts")


def parsed_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_delimited(delimited_topic(spark, sf_dir), keep=["offset"])


def lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.to_lake(parsed_delimited(spark, sf_dir), keep=["offset"], policy="drop")


def warehouse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = ingest.warehouse_split(parsed_delimited(spark, sf_dir))
    return good


def enriched_rows(spark: SparkSession, sf_dir: str, ref: DataFrame | None = None) -> DataFrame:
    cache = ReferenceCache(lambda: ref if ref is not None else views.aircraft_ref(spark, sf_dir))
    return lookup_join(lake_rows(spark, sf_dir), cache.get())


# --- wire -------------------------------------------------------------------

def q_delimited_scan(spark, sf_dir):
    return lake_rows(spark, sf_dir)


def q_delimited_rejects(spark, sf_dir):
    return ingest.parse_rejects(parsed_delimited(spark, sf_dir))


def q_encode_line(spark, sf_dir):
    """Pipeline 6 re-encoding: epoch-ms and boolean fields → delimited line."""
    p = views.positions(spark, sf_dir).withColumn("ts_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    fields = [
        wire.text("icao24"), wire.text("callsign"), wire.text("latitude"), wire.text("longitude"),
        wire.text("altitude"), wire.text("velocity"), wire.text("heading"),
        wire.text("vertical_rate"), wire.flag01("on_ground").cast("string"), wire.text("squawk"),
        wire.epoch_ms_date_text("ts_ms"), wire.epoch_ms_text("ts_ms"),
    ]
    return p.select(F.col("event_id").alias("offset"), wire.join_line(fields).alias("line"))


def q_json_roundtrip(spark, sf_dir):
    p = views.positions(spark, sf_dir)
    msgs = as_messages(p, wire.encode_json(), "adsb-json", offset="event_id")
    return ingest.good_of(ingest.classify_json(msgs), "fail")


def q_envelope_decode(spark, sf_dir):
    parsed = ingest.parse_envelope(envelope_topic(spark, sf_dir), keep=["offset"])
    return ingest.envelope_rows(parsed, keep=["offset"])


# --- load -------------------------------------------------------------------

def positions_table(spark: SparkSession, sf_dir: str) -> WarehouseTable:
    """The catalog table of pipeline 2, created by its DDL and loaded once:
    ``ingest_ts`` is filled by its DEFAULT."""
    def table(path):
        return WarehouseTable(spark, f"positions_{path[-12:]}", POSITIONS, ["pos_date", "load_id"], path)

    def build(path):
        keys = ["partition", "offset"]
        good, _ = ingest.warehouse_split(ingest.parse_delimited(delimited_topic(spark, sf_dir), keep=keys), keep=keys)
        table(path).create().write(good.withColumn("load_id", F.lit("load-0")))
    return table(_built(spark, "warehouse-positions", sf_dir, build))


WAREHOUSE_COLUMNS = ["offset", *(t.name for t in WAREHOUSE_POSITIONS)]


def q_warehouse_load(spark, sf_dir):
    rows = positions_table(spark, sf_dir).read()
    return rows.select(*WAREHOUSE_COLUMNS, F.col("ingest_ts").isNotNull().alias("stamped"), "load_id")


def q_cast_rejects(spark, sf_dir):
    _, rejects = ingest.warehouse_split(parsed_delimited(spark, sf_dir))
    return rejects


# --- join -------------------------------------------------------------------

def q_lookup_join(spark, sf_dir):
    """Through the cache by key: the store is asked for the keys of the rows."""
    rows = lake_rows(spark, sf_dir)
    cache = KeyedCache(lambda keys: views.aircraft_ref(spark, sf_dir).join(keys, "icao24", "left_semi"))
    return lookup_join(rows, cache.lookup(rows))


def duplicated_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference with a second row for every tenth key (key not enforced)."""
    ref = views.aircraft_ref(spark, sf_dir)
    extra = (ref.where(F.col("icao24").cast("long") % 10 == 0)
             .withColumn("registration", F.concat(F.col("registration"), F.lit("-B"))))
    return ref.unionByName(extra)


def q_lookup_join_dups(spark, sf_dir):
    return enriched_rows(spark, sf_dir, duplicated_ref(spark, sf_dir))


def q_enriched_summary(spark, sf_dir):
    return reports.enriched_summary(enriched_rows(spark, sf_dir))


# --- reports over the loaded warehouse rows ---------------------------------

def q_table_summary(spark, sf_dir):
    return reports.table_summary(warehouse_rows(spark, sf_dir))


def q_per_key_summary(spark, sf_dir):
    return reports.per_key_summary(warehouse_rows(spark, sf_dir))


def q_per_key_avg_int(spark, sf_dir):
    return reports.per_key_avg_int(lake_rows(spark, sf_dir))


def q_ingest_lag(spark, sf_dir):
    # ingest_ts is the server clock in a live load; here a fixed lag per offset
    t = warehouse_rows(spark, sf_dir).withColumn(
        "ingest_ts", F.col("ts") + F.make_dt_interval(secs=(F.col("offset") % 10).cast("decimal(8,6)")))
    return reports.ingest_lag(t)


def q_status_line(spark, sf_dir):
    return reports.status_line(warehouse_rows(spark, sf_dir))


def q_status_line_keys(spark, sf_dir):
    return reports.status_line_keys(warehouse_rows(spark, sf_dir))


def q_top_n(spark, sf_dir):
    return reports.top_n(warehouse_rows(spark, sf_dir), 10, [F.desc("velocity"), F.asc("offset")])


def q_sample_n(spark, sf_dir):
    return reports.sample_n(lake_rows(spark, sf_dir), 10, SAMPLE_SEED, ["icao24", "ts"])


def q_recent_rows(spark, sf_dir):
    return reports.recent_rows(positions_table(spark, sf_dir).read()).select(*WAREHOUSE_COLUMNS)


def q_recent_by_key(spark, sf_dir):
    return reports.by_key(lake_rows(spark, sf_dir), "icao24", EXAMPLE_KEY)


# Home base for the bearing report (a fixed point, as the producer's origin).
BASE_LAT, BASE_LON = 51.47, -0.46


def q_bearing(spark, sf_dir):
    t = lake_rows(spark, sf_dir)
    b = reports.bearing_deg(F.lit(BASE_LAT), F.lit(BASE_LON), F.col("latitude"), F.col("longitude"))
    return t.select("offset", "icao24", F.round(b, 1).alias("bearing"))


# --- dead letters -----------------------------------------------------------

DLQ_PARTITIONS = 4


def dlq_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead-letter topic: unusable envelopes with context headers, each in
    its key's partition and numbered there, published once to a file-backed
    topic."""
    def build(path):
        parsed = ingest.parse_envelope(
            envelope_topic(spark, sf_dir), keep=["key", "partition", "offset"])
        FileTopic(spark, path, DLQ_TOPIC, DLQ_PARTITIONS).send(
            deadletter.dead_letters(parsed, ENVELOPE_TOPIC, CONNECTOR), "load-0")
    return FileTopic(spark, _built(spark, "dlq-topic", sf_dir, build), DLQ_TOPIC, DLQ_PARTITIONS).read()


def q_dlq_split(spark, sf_dir):
    return deadletter.describe(dlq_messages(spark, sf_dir))


def q_topic_depth(spark, sf_dir):
    return topic_depth(dlq_messages(spark, sf_dir))


def q_dlq_replay(spark, sf_dir):
    """Read the dead letters, fill latitude from longitude, re-publish after
    the source topic's end offset, and decode them again."""
    dlq = dlq_messages(spark, sf_dir)
    base = topic_depth(envelope_topic(spark, sf_dir)).select(
        F.lit(0).alias("partition"), F.col("depth").alias("next_offset"))
    fixed = dlq.select(
        F.lit(0).alias("partition"),
        deadletter.header("offset").cast("long").alias("orig_offset"),
        deadletter.repair_envelope("value", {
            "latitude": lambda pl: F.round(-deadletter.payload_value(pl, "longitude") / 2, 6)
        }).alias("value"),
    )
    fixed = assign_offsets(fixed, ["orig_offset"], "partition", base=base)
    msgs = as_messages(fixed, "value", ENVELOPE_TOPIC, offset="offset", keep=["orig_offset"])
    parsed = ingest.parse_envelope(msgs, keep=["offset", "orig_offset"])
    return ingest.envelope_rows(parsed, keep=["offset", "orig_offset"])


# --- every record is accounted for -------------------------------------------

FAULTS = ("null message", "blank latitude", "short record", "wrong type")
FAULT_EVERY = 11


def _fault(number: F.Column) -> F.Column:
    """The fault of a record: numbers 0 to 3 of every eleven have one."""
    kind = F.lit("none")
    for i, name in enumerate(FAULTS):
        kind = F.when(number == i, F.lit(name)).otherwise(kind)
    return kind


def _fault_at(offset_col: str) -> F.Column:
    return _fault(F.col(offset_col) % FAULT_EVERY)


def faulty_lines(p: DataFrame) -> DataFrame:
    fault, fields = _fault_at("event_id"), wire.position_fields_text()
    fields[2] = F.when(fault == "blank latitude", F.lit("")).otherwise(fields[2])
    fields[8] = F.when(fault == "wrong type", F.lit("garbage")).otherwise(fields[8])
    line = (F.when(fault == "short record", wire.join_line(fields[:-1]))
            .when(fault != "null message", wire.join_line(fields)))
    return as_messages(p, line, POSITIONS_TOPIC, offset="event_id", key="icao24", timestamp="ts")


def faulty_json(p: DataFrame, text: F.Column, topic: str, blank: str) -> DataFrame:
    """JSON messages: none, cut short, or with latitude as ``blank`` or text."""
    fault, latitude = _fault_at("event_id"), '"latitude":[^,}]+'
    value = (F.when(fault == "short record", F.substring(text, 1, 20))
             .when(fault == "wrong type", F.regexp_replace(text, latitude, '"latitude":"abc"'))
             .when(fault == "blank latitude", F.regexp_replace(text, latitude, f'"latitude":{blank}'))
             .when(fault != "null message", text))
    return as_messages(p, value, topic, offset="event_id", key="icao24", timestamp="ts")


def faulty_hours(spark: SparkSession, sf_dir: str) -> tuple[PartitionedTable, PartitionedTable]:
    """Weather documents with faulty lines (visibility tells which), written to
    hour folders and loaded: the table and its quarantine."""
    def build(path):
        files.write_hour_folders(weather_messages(spark, sf_dir, faults=True), f"{path}/raw", records_per_file=1000)
        table, quarantine = tables(path)
        pipelines.load_hours(spark, f"{path}/raw", WEATHER_CSV_FIELDS, WEATHER_OBS, table, quarantine=quarantine)

    def tables(path):
        return (PartitionedTable(spark, f"{path}/obs", WEATHER_TABLE_SCHEMA, pipelines.HOUR_KEYS),
                pipelines.hour_rejects(spark, f"{path}/quarantine"))
    return tables(_built(spark, "weather-faults", sf_dir, build))


def q_record_balance(spark, sf_dir):
    """Per route and fault: records in, and how many became good rows, rejects
    (lines, JSON records, weather lines) or dead letters (envelopes)."""
    p = views.positions(spark, sf_dir)
    lines = faulty_lines(p)
    parsed = ingest.parse_delimited(lines, keep=["offset"])
    loaded, rejects = ingest.warehouse_split(parsed)
    lake, quarantined = ingest.lake_split(parsed)
    flat = ingest.classify_json(faulty_json(p, wire.encode_json(), "adsb-json", '""'))
    envelopes = ingest.parse_envelope(faulty_json(p, wire.encode_envelope(), ENVELOPE_TOPIC, "null"), keep=["key", "partition", "offset"])
    dead = deadletter.dead_letters(envelopes, ENVELOPE_TOPIC, CONNECTOR).withColumnRenamed("source_offset", "offset")
    hours, hour_rejects = faulty_hours(spark, sf_dir)
    code = F.split("line", ",")[5]

    sides, told = ["records", "good", "rejected", "dead"], []

    def side(route, name, rows, fault=_fault_at("offset")):
        told.append(rows.select(F.lit(route).alias("route"), fault.alias("fault"), *[F.lit(int(s == name)).alias(s) for s in sides]))

    for route, good, bad, name in (("delimited", loaded, rejects, "rejected"), ("lake", lake, quarantined, "rejected"),
                                   ("json", ingest.good_of(flat), ingest.rejects_of(flat), "rejected"),
                                   ("envelope", ingest.envelope_rows(envelopes), dead, "dead")):
        side(route, "records", p, _fault_at("event_id"))
        side(route, "good", good)
        side(route, name, bad)
    side("weather", "records", views.weather_rows(spark, sf_dir), _fault_at("event_id"))
    side("weather", "good", hours.read(), _fault(F.col("visibility_m")))
    side("weather", "rejected", hour_rejects.read(), F.when(code == "", F.lit(FAULTS[0])).otherwise(_fault(code.cast("int"))))
    return (reduce(DataFrame.unionByName, told).groupBy("route", "fault").agg(*[F.sum(s).alias(s) for s in sides])
            .withColumn("balanced", F.col("records") == F.col("good") + F.col("rejected") + F.col("dead")))


# --- tables written once per (scratch folder, input folder) -----------------
# Queries over a written table build it on first use in the session's shared
# scratch folder; later queries on the same input reuse it.
_BUILT: dict[tuple, str] = {}


def _built(spark: SparkSession, kind: str, sf_dir: str, build: Callable[[str], None]) -> str:
    key = (kind, scratch_root(spark), sf_dir)
    if key not in _BUILT:
        path = scratch_path(spark, kind, unique=True)
        build(path)
        _BUILT[key] = path
    return _BUILT[key]


# --- lake (pipelines 4, 5) ---------------------------------------------------

def orders_lake(spark: SparkSession, sf_dir: str) -> LedgerTable:
    """Orders committed as one snapshot per order year, partitioned by month."""
    def build(path):
        LedgerTable(spark, path, ["order_month"]).append_snapshots(
            views.order_snapshots(spark, sf_dir), "snapshot")
    return LedgerTable(spark, _built(spark, "lake-orders", sf_dir, build), ["order_month"])


def q_lake_current(spark, sf_dir):
    return orders_lake(spark, sf_dir).read()


TIME_TRAVEL_SNAPSHOT = "1998"


def q_time_travel(spark, sf_dir):
    """``FOR TIMESTAMP AS OF`` the commit time of one snapshot."""
    lake = orders_lake(spark, sf_dir)
    at = (lake.commits().where(F.col("snapshot_id") == TIME_TRAVEL_SNAPSHOT)
          .select("committed_at").first())
    return lake.read(as_of=at[0] if at else None)


def q_snapshot_history(spark, sf_dir):
    return orders_lake(spark, sf_dir).snapshots().select(
        "snapshot_id", "sequence_number", "operation", "added_rows")


# --- warehouse table (pipeline 2) --------------------------------------------

PARTITION_DAY = "2024-01-15"


def q_partition_filter(spark, sf_dir):
    """Equality on the day partition column: only that folder is read."""
    t = positions_table(spark, sf_dir).read()
    return t.where(F.col("pos_date") == F.lit(PARTITION_DAY).cast("date")).select(*WAREHOUSE_COLUMNS)


# --- hour folders and the weather table (pipeline 3) ------------------------

WEATHER_HEADER = ",".join(WEATHER_CSV_FIELDS)


def weather_messages(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """One CSV document per (event hour, id chunk): header, rows in id order
    (CRLF line ends, some values padded), a stray header line at the end in
    even hours; the message lands 10 minutes after its last observation.
    ``faults``: lines without any value, without station, cut short or with
    text for a number, and the number of the fault as visibility."""
    w = views.weather_rows(spark, sf_dir)
    pad = F.col("event_id") % 11 == 0
    temp = F.col("temperature_c").cast("string")
    fields = [F.col("station_id"), F.date_format("observation_ts", "yyyy-MM-dd HH:mm:ss"),
              F.when(pad, F.concat(F.lit(" "), temp, F.lit(" "))).otherwise(temp),
              *[F.col(c).cast("string") for c in WEATHER_CSV_FIELDS[3:]]]
    line = F.concat_ws(",", *fields)
    if faults:
        fault = _fault_at("event_id")
        fields[0] = F.when(fault == "blank latitude", F.lit("")).otherwise(fields[0])
        fields[2] = F.when(fault == "wrong type", F.lit("abc")).otherwise(fields[2])
        fields[5] = (F.col("event_id") % FAULT_EVERY).cast("string")
        line = (F.when(fault == "null message", F.lit("," * (len(fields) - 1)))
                .when(fault == "short record", F.concat_ws(",", *fields[:6])).otherwise(F.concat_ws(",", *fields)))
    msgs = (w.groupBy("event_hour", "chunk")
            .agg(F.sort_array(F.collect_list(F.struct("event_id", line.alias("line")))).alias("rows"),
                 F.max("observation_ts").alias("last_obs")))
    stray = F.when(F.hour("event_hour") % 2 == 0, F.lit("\r\n" + WEATHER_HEADER)).otherwise(F.lit(""))
    body = F.concat(F.lit(WEATHER_HEADER + "\r\n"),
                    F.array_join(F.transform("rows", lambda r: r["line"]), "\r\n"), stray, F.lit("\r\n"))
    landed = F.col("last_obs") + F.expr(views.LANDING_DELAY)
    return as_messages(msgs.select(body.alias("body"), landed.alias("landed"),
                                   F.col("chunk").alias("chunk")),
                       "body", "weather-csv", offset="chunk", timestamp="landed")


def weather_files(spark: SparkSession, sf_dir: str) -> str:
    def build(path):
        files.write_hour_folders(weather_messages(spark, sf_dir), path)
    return _built(spark, "weather-csv", sf_dir, build)


def weather_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_csv_folder(spark, WEATHER_CSV_FIELDS, root=weather_files(spark, sf_dir))


def weather_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cast with trim; rows whose cast fails (stray headers) are skipped."""
    scan = weather_scan(spark, sf_dir)
    typed = casting.apply_target(scan, WEATHER_OBS, keep=["landing_date", "landing_hour"], trim=True)
    return casting.good_rows(typed, "reject")


WEATHER_TABLE_SCHEMA = struct_of(WEATHER_OBS).add("landing_date", "string").add("landing_hour", "string")


def weather_table(spark: SparkSession, sf_dir: str) -> PartitionedTable:
    def build(path):
        PartitionedTable(spark, path, WEATHER_TABLE_SCHEMA, ["landing_date", "landing_hour"]).write(
            weather_typed(spark, sf_dir), clustered=True)
    return PartitionedTable(spark, _built(spark, "weather-obs", sf_dir, build), WEATHER_TABLE_SCHEMA,
                            ["landing_date", "landing_hour"])


def q_csv_scan(spark, sf_dir):
    return (weather_scan(spark, sf_dir).groupBy("landing_date", "landing_hour")
            .agg(F.countDistinct("path").alias("files"), F.count(F.lit(1)).alias("rows")))


def q_weather_load(spark, sf_dir):
    return weather_typed(spark, sf_dir).drop("landing_date", "landing_hour")


def q_hour_reload(spark, sf_dir):
    """Load the same landing hours again: they are replaced, not doubled."""
    table = PartitionedTable(spark, scratch_path(spark, "weather-reload", unique=True), WEATHER_TABLE_SCHEMA, pipelines.HOUR_KEYS)
    for _ in range(2):
        pipelines.load_hours(spark, weather_files(spark, sf_dir), WEATHER_CSV_FIELDS, WEATHER_OBS, table)
    return table.read()


SCOPE = (dt.datetime(2024, 1, 15, 6), dt.datetime(2024, 1, 15, 18))


def q_hour_scoped_load(spark, sf_dir):
    """Load the landing hours of one half day: no other folder is listed."""
    table = PartitionedTable(spark, scratch_path(spark, "weather-scoped", unique=True), WEATHER_TABLE_SCHEMA, pipelines.HOUR_KEYS)
    pipelines.load_hours(spark, weather_files(spark, sf_dir), WEATHER_CSV_FIELDS, WEATHER_OBS, table, hours=files.hours_between(*SCOPE))
    return table.read()


def q_window_rows(spark, sf_dir):
    """Rows of a half-open time window, filtered in the scan."""
    return reports.window_rows(weather_table(spark, sf_dir).read(), *SCOPE).drop(*pipelines.HOUR_KEYS)


# --- manifest of files (pipeline 1) -------------------------------------------

def order_files(spark: SparkSession, sf_dir: str) -> str:
    """Text files of order lines in a folder per month, and ``manifest`` with a
    line ``month|path`` for every file and for three that are not there."""
    def build(path):
        o = views.order_snapshots(spark, sf_dir)
        line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd"))
        (o.select(line.alias("value"), F.date_format("o_orderdate", "yyyyMM").alias("month"))
         .hint("rebalance", "month").write.partitionBy("month").text(f"{path}/files"))
        there = files.list_objects(spark, f"{path}/files", "*.txt").select(
            F.concat_ws("|", F.regexp_extract("path", "/month=([0-9]+)/", 1), "path").alias("value"))
        gone = spark.range(3).select(F.concat(F.lit("90000"), F.col("id").cast("string"), F.lit(f"|{path}/files/gone-"), F.col("id").cast("string"), F.lit(".txt")).alias("value"))
        there.unionByName(gone).coalesce(1).write.text(f"{path}/manifest")
    return _built(spark, "order-files", sf_dir, build)


def q_manifest_files(spark, sf_dir):
    """Whole files by manifest: their bytes and lines per month, and the lines
    of the manifest that name no file."""
    root = order_files(spark, sf_dir)
    staged = files.load_manifest_files(spark, f"{root}/manifest", root=f"{root}/files", glob="*.txt")
    text = F.col("container").cast("string")
    return staged.groupBy("stage_id").agg(
        F.sum(F.length("container")).cast("long").alias("bytes"),
        F.sum(F.length(text) - F.length(F.regexp_replace(text, "\n", ""))).cast("long").alias("lines"),
        F.count(F.when(F.col("error").isNotNull(), 1)).alias("missing"))


def q_hour_window_filter(spark, sf_dir):
    return reports.hour_window_counts(weather_table(spark, sf_dir).read())


def q_station_summary(spark, sf_dir):
    return reports.station_summary(weather_table(spark, sf_dir).read())


# --- reference table (pipeline 5) --------------------------------------------

UPDATED_OPERATOR = "UPDATED OPERATOR"


def reference_store(spark: SparkSession, sf_dir: str) -> LedgerTable:
    """Versioned reference table: seeded once, then updated by overwrite."""
    def build(path):
        LedgerTable(spark, path).overwrite(views.aircraft_ref(spark, sf_dir), "v1")
    return LedgerTable(spark, _built(spark, "aircraft-ref", sf_dir, build))


def q_ref_seed(spark, sf_dir):
    return reference_store(spark, sf_dir).read(snapshot_id="v1")


def q_ref_update(spark, sf_dir):
    """``UPDATE aircraft_ref SET operator = … WHERE icao24 = …`` as a new version."""
    store = reference_store(spark, sf_dir)
    current = store.read(snapshot_id="v1")
    updated = current.withColumn(
        "operator", F.when(F.col("icao24") == EXAMPLE_KEY, F.lit(UPDATED_OPERATOR))
        .otherwise(F.col("operator")))
    store.overwrite(updated, "v2")
    return store.read()


# --- Avro (pipelines 1, 6) ---------------------------------------------------

def avro_position_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as Avro records want them: boolean flag, ts as epoch ms."""
    return views.positions(spark, sf_dir).select(
        F.col("event_id").alias("offset"), "icao24", "callsign", "latitude", "longitude",
        "altitude", "velocity", "heading", "vertical_rate", "on_ground", "squawk",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))


def q_avro_raw_roundtrip(spark, sf_dir):
    rows = avro_position_rows(spark, sf_dir)
    msgs = avro.encode(rows, AVRO_POSITION, keep=["offset"])
    out = avro.decode(msgs, "value", AVRO_POSITION, keep=["offset"])
    return out.where(F.col(avro.ERROR).isNull()).drop(avro.ERROR)


# A second writer version of the position record (one extra optional field),
# registered beside the first: one topic carries both.
AVRO_POSITION_V2 = {**AVRO_POSITION, "fields": AVRO_POSITION["fields"] + [
    {"name": "source", "type": ["null", "string"], "default": None}]}
REGISTRY_ROWS = [(1, "adsb-positions-value", AVRO_POSITION), (2, "adsb-positions-value", AVRO_POSITION_V2)]


def schema_registry(spark: SparkSession) -> DataFrame:
    import json as _json
    return spark.createDataFrame([(i, s, _json.dumps(a)) for i, s, a in REGISTRY_ROWS],
                                 "schema_id int, subject string, avsc string")


def q_avro_framed_roundtrip(spark, sf_dir):
    """Even offsets written with schema 1, odd with schema 2; decoded by the
    id in each frame and resolved to the reader schema."""
    rows = avro_position_rows(spark, sf_dir).withColumn(
        "schema_id", F.when(F.col("offset") % 2 == 1, 2).otherwise(1))
    v1 = avro.encode(rows.where(F.col("schema_id") == 1), AVRO_POSITION, keep=["offset", "schema_id"])
    v2 = avro.encode(rows.where(F.col("schema_id") == 2).withColumn("source", F.lit("mlat")),
                     AVRO_POSITION_V2, keep=["offset", "schema_id"])
    framed = v1.unionByName(v2).select("offset", wire.frame("value", "schema_id").alias("value"))
    registry = avro.registry_from(schema_registry(spark))
    out = avro.decode_framed(framed, registry, AVRO_POSITION, keep=["offset"])
    return out.where(F.col(avro.ERROR).isNull()).drop(avro.ERROR)


def product_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging table (stage_id, part, container): version-1 products in
    stage 1 written with schema v1, version-2 products in stage 2 with v2."""
    def build(path):
        p = views.products(spark, sf_dir)
        s1 = avro.to_containers(p.where(F.col("version") == 1), AVRO_PRODUCT_V1, "version")
        s2 = avro.to_containers(p.where(F.col("version") == 2), AVRO_PRODUCT_V2, "version")
        s1.unionByName(s2).write.mode("overwrite").parquet(path)
    return spark.read.parquet(_built(spark, "avro-stage", sf_dir, build))


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avro.split_containers(product_stage(spark, sf_dir), AVRO_PRODUCT_V2)


def q_container_split(spark, sf_dir):
    return (product_rows(spark, sf_dir).groupBy("container_id")
            .agg(F.count(F.lit(1)).alias("records")).orderBy("container_id"))


def q_schema_evolution(spark, sf_dir):
    return product_rows(spark, sf_dir).select(
        F.col("container_id").alias("ver"), F.col("avro.product_id").alias("product_id"),
        F.col("avro.price").alias("price"), F.col("avro.description").alias("description"),
        F.col("avro.discount_pct").alias("discount_pct"))


def q_nested_filter(spark, sf_dir):
    return product_rows(spark, sf_dir).where(F.col("avro.discount_pct") > 20.0).select(
        "avro.product_id", "avro.name", "avro.discount_pct")


def q_unnest_struct(spark, sf_dir):
    return product_rows(spark, sf_dir).select("container_id", "avro.*")


def q_validity_counts(spark, sf_dir):
    return product_rows(spark, sf_dir).groupBy("validity").agg(F.count(F.lit(1)).alias("cnt"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "delimited_scan": q_delimited_scan,
    "delimited_rejects": q_delimited_rejects,
    "encode_line": q_encode_line,
    "json_roundtrip": q_json_roundtrip,
    "envelope_decode": q_envelope_decode,
    "warehouse_load": q_warehouse_load,
    "cast_rejects": q_cast_rejects,
    "lookup_join": q_lookup_join,
    "lookup_join_dups": q_lookup_join_dups,
    "enriched_summary": q_enriched_summary,
    "table_summary": q_table_summary,
    "per_key_summary": q_per_key_summary,
    "per_key_avg_int": q_per_key_avg_int,
    "ingest_lag": q_ingest_lag,
    "status_line": q_status_line,
    "status_line_keys": q_status_line_keys,
    "top_n": q_top_n,
    "sample_n": q_sample_n,
    "recent_rows": q_recent_rows,
    "recent_by_key": q_recent_by_key,
    "bearing": q_bearing,
    "dlq_split": q_dlq_split,
    "topic_depth": q_topic_depth,
    "dlq_replay": q_dlq_replay,
    "record_balance": q_record_balance,
    "lake_current": q_lake_current,
    "time_travel": q_time_travel,
    "snapshot_history": q_snapshot_history,
    "partition_filter": q_partition_filter,
    "csv_scan": q_csv_scan,
    "weather_load": q_weather_load,
    "hour_reload": q_hour_reload,
    "hour_scoped_load": q_hour_scoped_load,
    "hour_window_filter": q_hour_window_filter,
    "window_rows": q_window_rows,
    "manifest_files": q_manifest_files,
    "station_summary": q_station_summary,
    "ref_seed": q_ref_seed,
    "ref_update": q_ref_update,
    "avro_raw_roundtrip": q_avro_raw_roundtrip,
    "avro_framed_roundtrip": q_avro_framed_roundtrip,
    "container_split": q_container_split,
    "schema_evolution": q_schema_evolution,
    "nested_filter": q_nested_filter,
    "unnest_struct": q_unnest_struct,
    "validity_counts": q_validity_counts,
}
