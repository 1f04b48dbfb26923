"""Snapshot-committed lake table on plain Parquet (K3, S16–S18, ST4).

When a table-format package (Iceberg, Delta) is on the classpath, use its
catalog tables instead; this ledger gives the same guarantees the pipelines
rely on with nothing but Parquet:

* data for a snapshot is written under ``data/snapshot_id=<id>/<partitions>``
  with dynamic partition overwrite, so re-running a snapshot replaces only its
  own folders;
* a snapshot becomes visible only when its row lands in ``_commits``
  (written after the data), so readers never see a partial commit;
* a replayed snapshot id that is already committed is skipped;
* time travel reads the snapshots committed at or before a timestamp.

Readers join the committed snapshots to the ``snapshot_id`` partition column,
so Spark prunes to committed folders when it runs (dynamic pruning in the plan);
no list of snapshots passes through the driver.  The ledger has one row per
commit, never per data row.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER = T.StructType([
    T.StructField("snapshot_id", T.StringType(), False),
    T.StructField("committed_at", T.TimestampNTZType(), False),
    T.StructField("operation", T.StringType(), False),
    T.StructField("added_rows", T.LongType(), False),
    T.StructField("sequence_number", T.LongType(), False),
])


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


class LedgerTable:
    """An append-only table whose commits are rows in a ledger."""

    def __init__(self, spark: SparkSession, root: str, partition_cols: list[str] | None = None,
                 clock: Callable[[], dt.datetime] = _utc_now):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_cols = list(partition_cols or [])
        self.clock = clock

    data_path = property(lambda self: f"{self.root}/data")
    ledger_path = property(lambda self: f"{self.root}/_commits")
    schema_path = property(lambda self: f"{self.root}/_schema")

    # --- metadata -----------------------------------------------------------
    def _save_schema(self, df: DataFrame) -> None:
        if path_exists(self.spark, self.schema_path):
            return
        doc = json.dumps({"schema": df.schema.jsonValue(), "partitions": self.partition_cols})
        self.spark.createDataFrame([(doc,)], "doc string").coalesce(1).write.mode(
            "overwrite").text(self.schema_path)

    def schema(self) -> T.StructType | None:
        if getattr(self, "_schema", None) is not None:
            return self._schema
        if not path_exists(self.spark, self.schema_path):
            return None
        doc = json.loads(self.spark.read.text(self.schema_path).first()[0])
        self.partition_cols = doc["partitions"]
        self._schema = T.StructType.fromJson(doc["schema"])
        return self._schema

    def commits(self) -> DataFrame:
        """One row per committed snapshot (a replayed commit row is ignored)."""
        if not path_exists(self.spark, self.ledger_path):
            return self.spark.createDataFrame([], LEDGER)
        raw = self.spark.read.schema(LEDGER).parquet(self.ledger_path)
        first = Window.partitionBy("snapshot_id").orderBy("committed_at")
        return (raw.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n"))

    def _last(self, snapshot_id: str) -> tuple[bool, dt.datetime | None, int]:
        """Is the id committed; the last commit's time and sequence number."""
        if not path_exists(self.spark, self.ledger_path):
            return False, None, 0
        raw = self.spark.read.schema(LEDGER).parquet(self.ledger_path)
        told = raw.agg(F.max((F.col("snapshot_id") == snapshot_id).cast("int")), F.max("committed_at"), F.max("sequence_number")).first()
        return bool(told[0]), told[1], told[2] or 0

    def _commit(self, rows: list[tuple[str, int]], operation: str,
                last: dt.datetime | None, number: int) -> None:
        out = []
        for k, (sid, n) in enumerate(rows):
            at = self.clock()
            if last is not None and at <= last:
                at = last + dt.timedelta(milliseconds=1)
            last = at
            out.append((sid, at, operation, int(n), number + 1 + k))
        if out:
            self.spark.createDataFrame(out, LEDGER).coalesce(1).write.mode(
                "append").parquet(self.ledger_path)

    # --- writes -------------------------------------------------------------
    def _write(self, data: DataFrame) -> None:
        self._save_schema(data.drop("snapshot_id"))
        # few files per folder; AQE still splits a skewed folder
        (data.hint("rebalance", "snapshot_id", *self.partition_cols)
         .write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("snapshot_id", *self.partition_cols)
         .parquet(self.data_path))

    def append(self, df: DataFrame, snapshot_id: str, operation: str = "append") -> int:
        """Commit ``df`` as one snapshot; a committed id is not written again.
        Rows are counted while they are written; an empty overwrite is a
        commit too, an empty append is none."""
        done, last, number = self._last(snapshot_id)
        if done:
            return 0
        obs = Observation(f"rows-{snapshot_id}")
        self._write(df.withColumn("snapshot_id", F.lit(snapshot_id)).observe(obs, F.count(F.lit(1)).alias("n")))
        n = obs.get["n"]
        if n or operation == "overwrite":
            self._commit([(snapshot_id, n)], operation, last, number)
        return n

    def append_snapshots(self, df: DataFrame, snapshot_col: str, operation: str = "append") -> dict[str, int]:
        """Write several snapshots in one job, then commit them in id order.

        The data of every snapshot is written first; each then becomes visible
        with its own ledger row, so time travel can stop between any two of
        them.  Only ids of ``df`` are committed (counted over that one column),
        whatever folders an earlier failed write has left.
        """
        data = df.withColumn("snapshot_id", F.col(snapshot_col).cast("string"))
        if snapshot_col != "snapshot_id":
            data = data.drop(snapshot_col)
        data = data.join(self.commits().select("snapshot_id"), "snapshot_id", "left_anti")
        counts = {r[0]: r[1] for r in data.groupBy("snapshot_id").count().collect()}
        self._write(data.select(*[c for c in data.columns if c != "snapshot_id"], "snapshot_id"))
        self._commit(sorted(counts.items()), operation, *self._last("")[1:])
        return counts

    # --- reads --------------------------------------------------------------
    def _scan(self) -> DataFrame | None:
        schema = self.schema()
        if schema is None or not path_exists(self.spark, self.data_path):
            return None
        fields = [f for f in schema.fields if f.name not in self.partition_cols]
        parts = [T.StructField(c, schema[c].dataType if c in schema.names else T.StringType())
                 for c in self.partition_cols]
        full = T.StructType(fields + [T.StructField("snapshot_id", T.StringType())] + parts)
        return self.spark.read.schema(full).parquet(self.data_path)

    def read(self, as_of: dt.datetime | None = None, snapshot_id: str | None = None,
             with_snapshot: bool = False) -> DataFrame:
        """Current rows, or the table as of a time / up to a snapshot id.

        Visible snapshots are the committed ones (at or before ``as_of``, up
        to ``snapshot_id``) from the last ``overwrite`` commit onwards.
        """
        schema = self.schema()
        scan = self._scan()
        if scan is None:
            return self.spark.createDataFrame([], schema or T.StructType([]))
        hist = self.snapshots()
        if as_of is not None:
            hist = hist.where(F.col("committed_at") <= F.lit(as_of).cast("timestamp_ntz"))
        number = F.col("sequence_number")
        if snapshot_id is not None:
            hist = hist.where(number <= (hist.where(F.col("snapshot_id") == snapshot_id).agg(F.max(number)).first()[0] or -1))
        start = hist.where(F.col("operation") == "overwrite").agg(F.max(number)).first()[0] or 0
        visible = hist.where(number >= start).select("snapshot_id")
        cols = [f.name for f in schema.fields] + (["snapshot_id"] if with_snapshot else [])
        return scan.join(visible, "snapshot_id", "left_semi").select(*cols)

    def overwrite(self, df: DataFrame, snapshot_id: str) -> int:
        """Commit ``df`` as the whole new content (older snapshots stay for
        time travel)."""
        return self.append(df, snapshot_id, operation="overwrite")

    def snapshots(self) -> DataFrame:
        """Snapshot history in commit order with a 1-based sequence number."""
        return self.commits()

