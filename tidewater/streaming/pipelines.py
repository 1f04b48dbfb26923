"""The eight ingestion pipelines as Structured Streaming jobs.

A :class:`Pipeline` has two halves.  ``classify`` is narrow: messages in Spark's
Kafka record layout become rows with their errors, inside the streaming plan,
where good and bad ones are counted (``control.observed``).  ``write`` gets the
classified rows of one micro-batch, persisted once, and derives every output
from them, rejects and dead letters before the good rows.

Messages may come from any streaming source (``start``) or from a bounded read
(calling the pipeline with a DataFrame and a batch id).  Where a pipeline has
one output, ``stream`` gives its good rows as a streaming DataFrame for any
``writeStream`` target.

Writes are keyed by ``<stream id>-<batch id>``:

* warehouse tables: dynamic overwrite of the (day, load_id) folders, so a
  replayed batch replaces its earlier attempt;
* lake tables: a ledger commit per batch; a committed batch is skipped;
* reject and quarantine tables, file-backed topics and hour folders: a folder
  per batch, which the batch overwrites when it is repeated;
* JDBC tables and Kafka topics: at-least-once, as the insert-only sink.

``*_batch`` build a pipeline, ``run_*`` start it on a stream.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewater.functions import casting, wire
from tidewater.operators import deadletter, ingest
from tidewater.operators.lake import LedgerTable
from tidewater.operators.lookup import KeyedCache, ReferenceCache, lookup_join
from tidewater.operators.warehouse import PartitionedTable, WarehouseTable, ingest_time, load_batch
from tidewater.schemas import LAKE_POSITIONS, WAREHOUSE_POSITIONS, Target, struct_of
from tidewater.sources import avro, files
from tidewater.sources.topics import as_messages, records
from tidewater.streaming import control

Sink = Callable[[DataFrame, str], object]
Table = PartitionedTable | WarehouseTable

SOURCE_KEYS = ["partition", "offset"]

POSITIONS_TABLE = (struct_of(WAREHOUSE_POSITIONS)
                   .add("partition", T.IntegerType()).add("offset", T.LongType())
                   .add("ingest_ts", T.TimestampNTZType()).add("load_id", T.StringType()))
REJECTS_TABLE = T.StructType([
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("error_stage", T.StringType()), T.StructField("error_column", T.StringType()),
    T.StructField("error_message", T.StringType()), T.StructField("load_id", T.StringType()),
])


def positions_table(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, POSITIONS_TABLE, ["pos_date", "load_id"])


def rejects_table(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, REJECTS_TABLE, ["load_id"])


# The micro-batch's own time, one value for all its rows (P3); what looks things
# up goes by it, no sink writes it.
PROC_TIME = "proc_time"


@dataclass
class Pipeline:
    """``classify``: messages → rows; ``ok``: which of them are good; ``good``:
    the rows a single output takes; ``write``: all outputs of a batch."""

    stream_id: str
    classify: Callable[[DataFrame], DataFrame]
    ok: Callable[[], Column]
    good: Callable[[DataFrame], DataFrame]
    write: Callable[[DataFrame, str], object]
    latest: str | None = None
    base: Callable[[int], tuple[int, str | None]] | None = None

    def rows(self, messages: DataFrame) -> DataFrame:
        return self.classify(records(messages).withColumn(PROC_TIME, F.current_timestamp()))

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        self._write(self.rows(messages), batch_id)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.write(batch, load_name(self.stream_id, batch_id))
        finally:
            batch.unpersist()

    def observed(self, messages: DataFrame) -> DataFrame:
        return control.observed(self.rows(messages), self.stream_id, self.ok(), self.latest)

    def stream(self, messages: DataFrame) -> DataFrame:
        """Good rows of a stream, for a ``writeStream`` target of any kind; the
        bad ones are counted."""
        return self.good(self.observed(messages))

    def monitor(self, heartbeat: Callable[[str], None] | None = None, **kw) -> control.RunMonitor:
        return control.RunMonitor(self.stream_id, heartbeat, self.base, **kw)

    def start(self, messages: DataFrame, checkpoint: str, bounded: bool = True, every: str = control.FLUSH_5S,
              target: Callable[[DataFrame], DataStreamWriter] | None = None) -> StreamingQuery:
        """Run on a streaming DataFrame: into all outputs of the pipeline, or
        the good rows into ``target(rows)``, a ``DataStreamWriter``."""
        if target is not None:
            writer = target(self.stream(messages))
        else:
            writer = self.observed(messages).writeStream.foreachBatch(self._write)
        return control.start(writer, checkpoint, bounded, every)


def load_name(stream_id: str, batch_id: int) -> str:
    return f"{stream_id}-{batch_id:010d}"


def _no_errors() -> Column:
    return F.size(casting.ERRORS) == 0


# --- pipelines 2 and 6b: delimited topic → warehouse + reject table ----------

def warehouse_batch(table: Table, rejects: Table, stream_id: str) -> Pipeline:
    """``ingest_ts`` is the table's DEFAULT where it has one, else the server
    time.  The monitor's heartbeat starts from the table's rows before the
    first batch and adds what each batch observed (no rescan per batch)."""
    stamped = "ingest_ts" in getattr(table, "defaults", ())

    def good(rows):
        out = ingest.good_of(rows).drop(PROC_TIME)
        return out if stamped else out.withColumn("ingest_ts", ingest_time())

    def write(rows, load_id):
        load_batch(rejects, ingest.rejects_of(rows, SOURCE_KEYS), load_id)
        load_batch(table, good(rows), load_id)

    def base(first):
        own = F.col("load_id").startswith(f"{stream_id}-") & (F.col("load_id") >= load_name(stream_id, first))
        return tuple(table.read().where(~own).agg(F.count(F.lit(1)), F.max("ts").cast("string")).first())

    return Pipeline(stream_id, lambda m: ingest.classify_warehouse(ingest.parse_delimited(m, keep=[*SOURCE_KEYS, PROC_TIME]), keep=[*SOURCE_KEYS, PROC_TIME]),
                    _no_errors, good, write, latest="ts", base=base)


def run_warehouse(messages: DataFrame, table: Table, rejects: Table, checkpoint: str, stream_id: str,
                  bounded: bool = True, every: str = control.FLUSH_5S, **kw) -> StreamingQuery:
    """``messages``: any streaming DataFrame in the record layout.  A source
    option (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``) bounds each
    micro-batch: a backlog drains in several batches instead of one."""
    return warehouse_batch(table, rejects, stream_id).start(messages, checkpoint, bounded, every, **kw)


# --- pipelines 4 and 5: delimited topic → lake (with lookup enrichment) -----

def lake_batch(lake: LedgerTable, stream_id: str, policy: str = "drop",
               cache: ReferenceCache | KeyedCache | None = None, quarantine: Table | None = None) -> Pipeline:
    """``drop``: malformed lines are skipped and a field that does not parse is
    NULL, as the reference's option has it; ``fail``: either fails the batch;
    ``reject`` (with ``quarantine``): both go to that table with the reason,
    keyed by batch like the good rows, and no record is lost."""
    if (policy == "reject") != (quarantine is not None):
        raise ValueError("policy 'reject' and a quarantine table belong together")
    keys = [*SOURCE_KEYS, PROC_TIME]

    def good(rows):
        if policy == "drop":
            # a parse error has no columns to load; a cast error has NULL there
            rows = rows.where((F.col(ingest.STAGE) != "PARSE") & (F.col(casting.FENCE) >= 0)).drop(casting.ERRORS, casting.FENCE, ingest.STAGE)
        else:
            rows = ingest.good_of(rows, policy)
        return enrich(rows, cache).drop(*keys)

    def write(rows, snapshot_id):
        if quarantine is not None:
            load_batch(quarantine, ingest.rejects_of(rows, SOURCE_KEYS), snapshot_id)
        lake.append(good(rows), snapshot_id)

    return Pipeline(stream_id, lambda m: ingest.classify_delimited(ingest.parse_delimited(m, keep=keys), LAKE_POSITIONS, keep=keys),
                    (lambda: F.col(ingest.STAGE) != "PARSE") if policy == "drop" else _no_errors, good, write, latest="ts")


def enrich(rows: DataFrame, cache: ReferenceCache | KeyedCache | None) -> DataFrame:
    """Reference attributes as of the batch's processing time."""
    if cache is None:
        return rows
    if isinstance(cache, KeyedCache):
        return lookup_join(rows, cache.lookup(rows, PROC_TIME), key=cache.key, attributes=cache.attributes)
    return lookup_join(rows, cache.get())


def run_lake(messages: DataFrame, lake: LedgerTable, checkpoint: str, stream_id: str, bounded: bool = True,
             every: str = control.CHECKPOINT_30S, target: Callable[[DataFrame], DataStreamWriter] | None = None, **kw) -> StreamingQuery:
    return lake_batch(lake, stream_id, **kw).start(messages, checkpoint, bounded, every, target)


# --- pipeline 6a: registry-framed Avro topic → delimited text topic ----------

def avro_position_line() -> F.Column:
    """Decoded Avro position (epoch-ms ts, boolean flag) → pipe line."""
    fields = [wire.text(c) for c in ("icao24", "callsign", "latitude", "longitude", "altitude",
                                     "velocity", "heading", "vertical_rate")]
    fields += [wire.flag01("on_ground").cast("string"), wire.text("squawk"),
               wire.epoch_ms_date_text("ts"), wire.epoch_ms_text("ts")]
    return wire.join_line(fields)


def avro_to_lines_batch(publish: Sink, topic: str, registry: dict[int, str], reader: dict,
                        rejects: Table | None = None, stream_id: str = "p6") -> Pipeline:
    """1:1 re-encoding keeps the source (partition, offset) of each message;
    ``publish`` takes them (``FileTopic.publish``, ``kafka_target(...)``).
    Frames that do not decode go to ``rejects``; without it the batch fails
    before anything of it is published."""
    def good(rows):
        if rejects is not None:
            rows = rows.where(F.col(avro.ERROR).isNull())
        line = F.when(F.col(avro.ERROR).isNull(), avro_position_line()).otherwise(F.raise_error(F.concat(
            F.lit("bad frame at offset "), F.col("offset").cast("string"), F.lit(" (no reject table): "), F.col(avro.ERROR))))
        return as_messages(rows, line, topic, offset="offset", key="key", partition="partition")

    def write(rows, load_id):
        if rejects is not None:
            bad = rows.where(F.col(avro.ERROR).isNotNull()).select(
                "partition", "offset", F.lit("DECODE").alias("error_stage"),
                F.lit(None).cast("string").alias("error_column"),
                F.col(avro.ERROR).alias("error_message"))
            load_batch(rejects, bad, load_id)
        publish(good(rows), load_id)

    return Pipeline(stream_id, lambda m: avro.decode_framed(m, registry, reader, keep=["key", "partition", "offset"]),
                    lambda: F.col(avro.ERROR).isNull(), good, write)


def run_lines(messages: DataFrame, publish: Sink, topic: str, registry: dict[int, str], reader: dict, checkpoint: str,
              bounded: bool = True, every: str = control.CHECKPOINT_10S, target: Callable[[DataFrame], DataStreamWriter] | None = None, **kw) -> StreamingQuery:
    return avro_to_lines_batch(publish, topic, registry, reader, **kw).start(messages, checkpoint, bounded, every, target)


# --- pipelines 7 and 8: envelope topic → table sink (+ dead letters) ---------

def envelope_batch(sink: Sink, source_topic: str, dlq: Sink | None = None, connector: str = "jdbc-sink",
                   whitelist: list[str] | None = None, stream_id: str = "p8") -> Pipeline:
    """Good envelopes → ``sink``; bad ones → ``dlq`` (errors.tolerance=all), a
    target that takes messages (``FileTopic.send``, ``kafka_target(...)``), or,
    without one, the batch fails (errors.tolerance=none)."""
    def good(rows):
        return ingest.envelope_rows(rows, keep=["partition", "offset"], whitelist=whitelist)

    def write(rows, load_id):
        dead = deadletter.dead_letters(rows, source_topic, connector)
        if dlq is None:
            first = dead.agg(F.min("source_offset")).first()[0]
            if first is not None:
                raise ValueError(f"bad record at offset {first} (no dead-letter topic)")
        else:
            dlq(dead, load_id)
        sink(good(rows), load_id)

    return Pipeline(stream_id, lambda m: ingest.parse_envelope(m, keep=["key", "partition", "offset"]),
                    lambda: ingest.envelope_problem().isNull(), good, write)


def table_sink(table: Table) -> Sink:
    """Idempotent table sink keyed by load id (stands in for the JDBC table)."""
    def write(rows: DataFrame, load_id: str) -> None:
        load_batch(table, rows, load_id)
    return write


def jdbc_sink(url: str, table: str, properties: dict | None = None) -> Sink:
    """Insert-only JDBC sink: the table must exist (auto.create=false); rows
    are appended, so a retried batch can insert twice (at-least-once)."""
    props = dict(properties or {})

    def write(rows: DataFrame, load_id: str) -> None:
        spark = rows.sparkSession
        # fails if the table is absent, instead of letting append create it
        spark.read.jdbc(url, f"(SELECT * FROM {table} WHERE 1 = 0) probe", properties=props).schema
        rows.drop("partition", "offset").write.jdbc(url, table, mode="append", properties=props)
    return write


def run_envelope(messages: DataFrame, pipeline: Pipeline, checkpoint: str, bounded: bool = True,
                 every: str = control.FLUSH_5S, **kw) -> StreamingQuery:
    return pipeline.start(messages, checkpoint, bounded, every, **kw)


# --- pipeline 3: topic → hour folders; hourly load ---------------------------

def hour_folders_batch(root: str, layout: str = files.HIVE, records_per_file: int = 1,
                       stream_id: str = "p3") -> Pipeline:
    def write(rows, load_id):
        files.write_hour_folders(rows, root, landing_ts="timestamp", layout=layout,
                                 records_per_file=records_per_file, batch_name=load_id)
    return Pipeline(stream_id, lambda m: m.drop(PROC_TIME), lambda: F.col("value").isNotNull(), lambda rows: rows, write)


def run_hour_folders(messages: DataFrame, root: str, checkpoint: str, bounded: bool = True,
                     every: str = control.FLUSH_5S, **kw) -> StreamingQuery:
    return hour_folders_batch(root, **kw).start(messages, checkpoint, bounded, every)


HOUR_KEYS = ["landing_date", "landing_hour"]
HOUR_REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in (
    "path", "line", "error_stage", "error_column", "error_message", *HOUR_KEYS)])


def hour_rejects(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, HOUR_REJECTS, HOUR_KEYS)


def classify_hours(scan: DataFrame, fields: list[str], targets: list[Target]) -> DataFrame:
    """Lines of hour folders, typed with trim: ``_errors`` and stage as for
    delimited messages (a line with another number of fields is a PARSE error),
    and the line's own text.  Header lines, wherever they stand, are no
    records and are left out."""
    header = F.lit(True)
    for f in fields:
        header = header & F.trim(f).eqNullSafe(F.lit(f))
    line = F.concat_ws(",", *(F.coalesce(F.col(f), F.lit("")) for f in fields))
    read = scan.where(~header).withColumn("line", F.coalesce(F.col(files.CORRUPT), line)).withColumn(
        "_malformed", F.col(files.CORRUPT).isNotNull())
    typed = casting.apply_target(read, targets, keep=["path", "line", "_malformed", *HOUR_KEYS], trim=True)
    told = F.struct(F.lit(None).cast("string").alias("column"), F.lit(f"expected {len(fields)} fields").alias("message"))
    return typed.select("path", "line", *HOUR_KEYS, *[t.name for t in targets],
                        F.when(F.col("_malformed"), F.array(told)).otherwise(F.col(casting.ERRORS)).alias(casting.ERRORS),
                        F.when(F.col("_malformed"), F.lit("PARSE")).otherwise(F.lit("CAST")).alias(ingest.STAGE), casting.FENCE)


def load_hours(spark: SparkSession, root: str, fields: list[str], targets: list[Target], table: PartitionedTable,
               hours: list[tuple[str, str]] | None = None, layout: str = files.HIVE,
               quarantine: PartitionedTable | None = None) -> None:
    """Idempotent hourly load: read the folders of the requested landing hours
    (no other folder is listed), cast with trim, and replace those hours in
    ``table``; without ``hours`` every hour there is.  Lines that do not load
    go to ``quarantine``, keyed by hour like the good ones; header lines do
    not.  A requested hour without good rows ends up empty."""
    paths = None if hours is None else files.existing(spark, files.hour_paths(root, hours, layout))
    scan = files.read_csv_folder(spark, fields, root=root, paths=paths, layout=layout, corrupt=True)
    rows = classify_hours(scan, fields, targets)
    replace = [dict(zip(HOUR_KEYS, h)) for h in hours or []]
    if quarantine is not None:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # rows come from folders of the tables' own layout: already clustered
        if quarantine is not None:
            quarantine.write(ingest.rejects_of(rows, ["path", "line", *HOUR_KEYS]), clustered=True, replace=replace)
        table.write(ingest.good_of(rows).drop("path", "line"), clustered=True, replace=replace)
    finally:
        rows.unpersist()


# --- pipeline 1: manifest of Avro containers → nested table ------------------

def avro_blob_load(spark: SparkSession, manifest: str, reader: dict, out_path: str) -> DataFrame:
    """Manifest ``id|path`` → container files decoded block by block (a large
    file is split over many tasks) → one row per record in ``out_path``.
    A missing or corrupt file yields a row whose ``validity`` says why."""
    listed = files.read_manifest(spark, manifest)
    rows = avro.read_container_files(listed, reader, id_col="stage_id")
    rows.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)
