"""Topics in Spark's Kafka record layout, whatever they come from.

The pipelines take any DataFrame, streaming or bounded, with the columns of
``schemas.TOPIC_SCHEMA`` (:func:`records` checks and completes them): Spark's
Kafka source, a file stream, a table, a memory stream.  Offsets to start and end
at are one thing everywhere: ``earliest``, ``latest`` or a map per topic and
partition, as a dictionary or as the JSON that Spark's Kafka source takes
(``{"positions": {"0": 23, "1": -2}}``, -2 earliest, -1 latest).

:class:`FileTopic` is a folder of Parquet files in the same layout for machines
without the Kafka source.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tidewater.schemas import TOPIC_SCHEMA
from tidewater.session import scratch_path

KAFKA_FORMAT = "kafka"
EARLIEST, LATEST = -2, -1  # in offset maps, as Spark's Kafka source has them
ENDS = "partition int, next_offset long, batch string"

Offsets = str | Mapping[str, Mapping[int | str, int]]


# --- offsets per topic and partition -----------------------------------------

def offsets_map(offsets: Offsets) -> dict[str, dict[int, int]]:
    """``{topic: {partition: offset}}`` from a dictionary or its JSON text."""
    raw = json.loads(offsets) if isinstance(offsets, str) else offsets
    out = {t: {int(p): int(o) for p, o in parts.items()} for t, parts in raw.items()}
    for t, parts in out.items():
        for p, o in parts.items():
            if p < 0 or o < EARLIEST:
                raise ValueError(f"no offset {o} of partition {p} in topic {t}")
    return out


def offsets_json(offsets: Offsets) -> str:
    """The text of the ``startingOffsets`` and ``endingOffsets`` options."""
    return json.dumps({t: {str(p): o for p, o in sorted(parts.items())} for t, parts in sorted(offsets_map(offsets).items())})


def offset_option(offsets: Offsets) -> str:
    return offsets if offsets in ("earliest", "latest") else offsets_json(offsets)


def offset_range(starting: Offsets = "earliest", ending: Offsets = "latest") -> Column | None:
    """Rows from ``starting`` (inclusive) to ``ending`` (exclusive) of each topic
    partition, for sources without these options; None when all are meant.
    Partitions a map does not name are read whole."""
    cond = None
    for told, side in ((starting, EARLIEST), (ending, LATEST)):
        if told == ("earliest" if side == EARLIEST else "latest"):
            continue
        if told in ("earliest", "latest"):
            raise ValueError(f"{told} is no {'start' if side == EARLIEST else 'end'} of a bounded read")
        own = F.lit(True)
        for topic, parts in offsets_map(told).items():
            for p, at in parts.items():
                if at != side:
                    if at < 0:
                        raise ValueError(f"offset {at} has no place in a bounded read")
                    bound = F.col("offset") >= at if side == EARLIEST else F.col("offset") < at
                    own = own & (bound | (F.col("topic") != topic) | (F.col("partition") != p))
        cond = own if cond is None else cond & own
    return cond


def bounded(messages: DataFrame, starting: Offsets = "earliest", ending: Offsets = "latest") -> DataFrame:
    cond = offset_range(starting, ending)
    return messages if cond is None else messages.where(cond)


# --- the record layout --------------------------------------------------------

def records(messages: DataFrame) -> DataFrame:
    """``messages`` with exactly the columns of the record layout.  ``value``,
    ``topic``, ``partition`` and ``offset`` must be there; the others are null
    where the source has none.  Text keys and values become UTF-8 bytes."""
    missing = [c for c in ("value", "topic", "partition", "offset") if c not in messages.columns]
    if missing:
        raise ValueError(f"no messages: {', '.join(missing)} missing among {', '.join(messages.columns)}")
    have = {f.name: f.dataType for f in messages.schema.fields}
    cols = []
    for f in TOPIC_SCHEMA.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return messages.select(*cols)


def as_messages(
    df: DataFrame,
    value: str | Column,
    topic: str,
    offset: str | Column,
    key: str | Column | None = None,
    partition: str | Column | int = 0,
    timestamp: str | Column | None = None,
    headers: Column | None = None,
    keep: list[str] = [],
) -> DataFrame:
    """Project rows into the topic record layout (text as UTF-8 bytes);
    ``keep`` carries extra columns along after the topic columns."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    def as_bytes(c):
        # a named binary column is kept; anything else is text → UTF-8
        if isinstance(c, str) and isinstance(df.schema[c].dataType, BinaryType):
            return F.col(c)
        return F.encode(col(c).cast("string"), "UTF-8")
    v = as_bytes(value)
    k = F.lit(None).cast("binary") if key is None else as_bytes(key)
    p = F.lit(partition) if isinstance(partition, int) else col(partition)
    ts = F.current_timestamp() if timestamp is None else col(timestamp).cast("timestamp")
    h = headers if headers is not None else F.lit(None).cast(TOPIC_SCHEMA["headers"].dataType)
    return df.select(
        k.alias("key"), v.alias("value"), F.lit(topic).alias("topic"),
        p.cast("int").alias("partition"), col(offset).cast("long").alias("offset"),
        ts.alias("timestamp"), F.lit(0).alias("timestampType"), h.alias("headers"),
        *keep,
    )


def key_partition(key: str | Column, partitions: int) -> Column:
    """Keyed publish: every message of one key goes to one partition (16 bits
    of the key's MD5); messages without a key to partition 0."""
    k = F.col(key) if isinstance(key, str) else key
    bits = F.conv(F.substring(F.md5(k.cast("binary")), 1, 4), 16, 10).cast("int")
    return F.coalesce(F.pmod(bits, F.lit(partitions)), F.lit(0))


# --- Kafka ---------------------------------------------------------------------

def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka data source is on the classpath."""
    try:
        jvm = spark.sparkContext._jvm
        cls = jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider", True,
            jvm.Thread.currentThread().getContextClassLoader())
        return cls is not None
    except Exception:
        return False


def kafka_source_options(servers: str, topics: str | list[str], stream: bool, starting: Offsets = "earliest",
                         ending: Offsets = "latest", max_per_trigger: int | None = None, group: str | None = None,
                         more: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of Spark's Kafka source.  An offset map names topics that are
    read; a bounded read has an end and does not start at ``latest``, a stream
    has no end.  Headers are always read (dead letters keep their context
    there)."""
    names = [topics] if isinstance(topics, str) else list(topics)
    for told in (starting, ending):
        if told not in ("earliest", "latest"):
            unknown = set(offsets_map(told)) - set(names)
            if unknown:
                raise ValueError(f"offsets of topics that are not read: {', '.join(sorted(unknown))}")
    out = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(names),
           "startingOffsets": offset_option(starting), "includeHeaders": "true"}
    if stream:
        if ending != "latest":
            raise ValueError("a stream has no ending offsets")
        if max_per_trigger is not None:
            out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    else:
        if starting == "latest":
            raise ValueError("a bounded read does not start at latest")
        out["endingOffsets"] = offset_option(ending)
    if group is not None:
        out["kafka.group.id"] = group
    return out | dict(more or {})


def kafka_read(spark: SparkSession, servers: str, topics: str | list[str], stream: bool = True, **how) -> DataFrame:
    """Messages of Spark's own Kafka source (:func:`kafka_source_options`),
    ready for every ``run_*`` of ``streaming.pipelines``."""
    options = kafka_source_options(servers, topics, stream, **how)
    reader = spark.readStream if stream else spark.read
    return records(reader.format(KAFKA_FORMAT).options(**options).load())


def kafka_sink_options(servers: str, topic: str, checkpoint: str | None = None, more: Mapping[str, str] | None = None) -> dict[str, str]:
    out = {"kafka.bootstrap.servers": servers, "topic": topic, "includeHeaders": "true"}
    if checkpoint is not None:
        out["checkpointLocation"] = checkpoint
    return out | dict(more or {})


def outgoing(messages: DataFrame) -> DataFrame:
    """What a producer sends: the broker numbers the messages, and its
    partitioner keeps the messages of a key together."""
    return messages.select(*[c for c in ("key", "value", "headers") if c in messages.columns])


def kafka_writer(messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None, **more) -> DataStreamWriter:
    """A stream into a topic; at-least-once, like every Kafka producer without
    transactions."""
    return outgoing(messages).writeStream.format(KAFKA_FORMAT).options(**kafka_sink_options(servers, topic, checkpoint, more))


def kafka_target(servers: str, topic: str, **more) -> Callable[[DataFrame, str], None]:
    """Where a batch function sends messages (``FileTopic.send`` is another)."""
    options = kafka_sink_options(servers, topic, more=more)

    def send(messages: DataFrame, batch: str) -> None:
        outgoing(messages).write.format(KAFKA_FORMAT).options(**options).save()
    return send


# --- a folder of Parquet files ---------------------------------------------------

@dataclass
class FileTopic:
    """A topic kept as Parquet under ``root`` in the Kafka record layout.

    Next to the data, ``_ends`` records the end offset of every partition a
    publish touched, captured during the write itself (``observe``), so
    appenders learn where to continue without scanning the topic.  Both are
    kept in folders by batch, which a repeated batch overwrites."""

    spark: SparkSession
    root: str
    name: str
    partitions: int = 1

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name}"

    @property
    def ends_path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name}._ends"

    def publish(self, messages: DataFrame, batch: str | None = None) -> int:
        """Append messages already carrying partition and offset numbers and
        return their number.  ``batch`` names the publish: under the same name
        it replaces its earlier attempt instead of adding to it."""
        import uuid
        from pyspark.sql import Observation
        obs = Observation(f"ends-{self.name}")
        ends = [F.max(F.when(F.col("partition") == p, F.col("offset"))).alias(f"p{p}")
                for p in range(self.partitions)]
        batch = batch or uuid.uuid4().hex
        (messages.select(*TOPIC_SCHEMA.fieldNames(), F.lit(batch).alias("batch")).observe(obs, F.count(F.lit(1)).alias("n"), *ends)
         .write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("partition", "batch").parquet(self.path))
        got = obs.get
        rows = [(p, int(got[f"p{p}"]) + 1) for p in range(self.partitions) if got.get(f"p{p}") is not None]
        if rows:
            (self.spark.createDataFrame([(*r, batch) for r in rows], ENDS).coalesce(1)
             .write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("batch").parquet(self.ends_path))
        return int(got["n"])

    def send(self, messages: DataFrame, batch: str) -> int:
        """Append messages without numbers: each goes to its key's partition
        and is numbered there, in the order of ``source_partition`` and
        ``source_offset``."""
        from tidewater.operators.lake import delete_path
        from tidewater.operators.offsets import assign_offsets
        folder = scratch_path(self.spark, "offsets", unique=True)
        rows = messages.withColumn("partition", key_partition("key", self.partitions))
        numbered = assign_offsets(rows, ["source_partition", "source_offset"], "partition", base=self.next_offsets(but=batch), folder=folder)
        headers = F.col("headers") if "headers" in messages.columns else None
        n = self.publish(as_messages(numbered, "value", self.name, offset="offset", key="key", partition="partition", headers=headers), batch)
        delete_path(self.spark, folder)
        return n

    def next_offsets(self, but: str | None = None) -> DataFrame | None:
        """(partition, next_offset) from the sidecar; None for a new topic.
        ``but``: as before this batch, so that a repeated one numbers alike."""
        from tidewater.operators.lake import path_exists
        if not path_exists(self.spark, self.ends_path):
            return None
        ends = self.spark.read.schema(ENDS).parquet(self.ends_path)
        if but is not None:
            ends = ends.where(F.col("batch") != but)
        return (ends.groupBy("partition").agg(F.max("next_offset").alias("next_offset")))

    def read(self, starting: Offsets = "earliest", ending: Offsets = "latest") -> DataFrame:
        """Bounded read; start inclusive, end exclusive, per partition."""
        df = self.spark.read.schema(TOPIC_SCHEMA).parquet(self.path).select(*TOPIC_SCHEMA.fieldNames())
        return bounded(df, starting, ending)

    def read_stream(self, max_files_per_trigger: int | None = None, starting: Offsets = "earliest",
                    checkpoint: str | None = None) -> DataFrame:
        """``checkpoint`` (the stream's own) keeps the offsets that ``latest``
        stood for at the first start, so that a restart means the same ones."""
        reader = self.spark.readStream.schema(StructType([*TOPIC_SCHEMA.fields, StructField("batch", StringType())]))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        df = reader.parquet(self.path).select(*TOPIC_SCHEMA.fieldNames())
        if starting == "latest":
            starting = {self.name: latest_offsets(self, checkpoint)}
        return bounded(df, starting)


def latest_offsets(topic: FileTopic, checkpoint: str | None) -> dict[int, int]:
    """End offset of every partition when the stream first started: kept in
    its checkpoint folder and read from there on a restart.  One row per topic
    partition."""
    from tidewater.operators.lake import path_exists
    schema = "partition int, next_offset long"
    kept = checkpoint and f"{checkpoint.rstrip('/')}/start-offsets"
    if kept and path_exists(topic.spark, f"{kept}/_SUCCESS"):
        return {r[0]: r[1] for r in topic.spark.read.schema(schema).parquet(kept).collect()}
    ends = topic.next_offsets()
    found = {} if ends is None else {r[0]: r[1] for r in ends.collect()}
    if kept:
        topic.spark.createDataFrame(list(found.items()), schema).coalesce(1).write.mode("overwrite").parquet(kept)
    return found


def topic_depth(messages: DataFrame) -> DataFrame:
    """Sum over partitions of the end offset (last offset + 1)."""
    ends = messages.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))
    return ends.agg(F.coalesce(F.sum("end_offset"), F.lit(0)).cast("long").alias("depth"),
                    F.count("*").alias("partitions"))
