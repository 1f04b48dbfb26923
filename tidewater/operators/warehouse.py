"""Date-partitioned warehouse tables.

Two kinds with one interface: :class:`WarehouseTable` lives in the catalog,
:class:`PartitionedTable` is a folder.  A warehouse table is Parquet partitioned by its day column (``pos_date``,
pruned by Catalyst on equality and range filters) and then by ``load_id``.
Every write uses dynamic partition overwrite, which makes a load idempotent
per load id: a micro-batch that is retried after a failure writes the same
rows into the same (day, load_id) folders and replaces its earlier attempt
instead of duplicating it.  Constraints (NOT NULL, widths, the day range,
defaults) are enforced by ``functions.casting`` before rows get here.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.lake import delete_path, path_exists
from tidewater.schemas import WAREHOUSE_POSITIONS, Sql, Target


def ddl(name: str, targets: list[Target], partition_cols: list[str], location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a catalog-managed copy of a
    target, with NOT NULL and DEFAULT clauses (Spark 3.4+ column defaults)."""
    cols = []
    for t in targets:
        c = f"{t.name} {t.dtype.upper()}"
        if not t.nullable:
            c += " NOT NULL"
        if t.default is not None:
            c += f" DEFAULT {t.default if isinstance(t.default, Sql) else repr(t.default)}"
        cols.append(c)
    text = (f"CREATE TABLE IF NOT EXISTS {name} (\n  " + ",\n  ".join(cols)
            + f"\n) USING parquet PARTITIONED BY ({', '.join(partition_cols)})")
    if location:
        text += f" LOCATION '{location}'"
    return text


INGEST_TIME = Sql("CAST(date_trunc('SECOND', current_timestamp()) AS TIMESTAMP_NTZ)")

# The loaded position table: the target, the message it came from, the server
# time by DEFAULT and the load that wrote it.
POSITIONS = [*WAREHOUSE_POSITIONS, Target("partition", "int"), Target("offset", "bigint"),
             Target("ingest_ts", "timestamp_ntz", default=INGEST_TIME), Target("load_id", "string", nullable=False)]


def ingest_time() -> F.Column:
    """Server ingest time at second precision (``CURRENT_TIMESTAMP(0)``)."""
    return F.expr(INGEST_TIME)


def create_namespace(spark: SparkSession, name: str, location: str) -> None:
    """A database of its own for the tables of a deployment."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def _partition_counts(rows: DataFrame, parts: list[dict]) -> tuple[DataFrame, Callable[[int], int]]:
    """``rows`` with a count for each partition, told once they are written.
    Rows that the optimizer knows to be none lose their metrics: all are 0."""
    known = rows._jdf.queryExecution().optimizedPlan().maxRows()
    if not parts or known.isDefined() and known.get() == 0:
        return rows, lambda i: 0
    obs = Observation("replaced")
    counted = rows.observe(obs, *(F.count(F.when(reduce(and_, (F.col(c) == v for c, v in part.items())), 1)).alias(f"n{i}")
                                  for i, part in enumerate(parts)))
    return counted, lambda i: obs.get[f"n{i}"]


class PartitionedTable:
    """Parquet table at ``path`` partitioned by ``partition_cols``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 partition_cols: list[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_cols = list(partition_cols)

    def write(self, df: DataFrame, clustered: bool = False, replace: list[dict] | None = None) -> None:
        """Replace exactly the partitions present in ``df`` (idempotent), and
        empty those of ``replace`` (a value for every partition column) that
        have no row in ``df``; their rows are counted while ``df`` is written.

        Unless the input is already clustered by the partition columns (read
        from folders of the same layout), REBALANCE groups each folder's rows
        into few tasks — few files per folder instead of tasks × folders —
        and AQE still splits a skewed folder across tasks."""
        cols = [f.name for f in self.schema.fields]
        replace = replace or []
        out, written = _partition_counts(df.select(*cols), replace)
        if not clustered:
            out = out.hint("rebalance", *self.partition_cols)
        out.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*self.partition_cols).parquet(self.path)
        for i, part in enumerate(replace):
            if not written(i):
                delete_path(self.spark, "/".join([self.path, *(f"{c}={part[c]}" for c in self.partition_cols)]))

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        data = [f for f in self.schema.fields if f.name not in self.partition_cols]
        parts = [self.schema[c] for c in self.partition_cols]
        return (self.spark.read.schema(T.StructType(data + parts)).parquet(self.path)
                .select(*[f.name for f in self.schema.fields]))

    def purge(self) -> None:
        """``DELETE FROM t ALL`` / fresh start."""
        delete_path(self.spark, self.path)


class WarehouseTable:
    """A catalog table created from a target: widths and types by its DDL, NOT
    NULL checked on every insert (the file formats do not check it), DEFAULTs
    filled by Spark for the columns an insert does not name.

    The table lies at ``location``, so a catalog that forgets it with the
    session finds its partitions again.  Inserts overwrite exactly the
    partitions they hold rows for, like :class:`PartitionedTable`."""

    def __init__(self, spark: SparkSession, name: str, targets: list[Target], partition_cols: list[str], location: str):
        self.spark = spark
        self.name = name
        self.targets = list(targets)
        self.partition_cols = list(partition_cols)
        self.location = location.rstrip("/")
        self.defaults = [t.name for t in targets if t.default is not None]

    def create(self) -> "WarehouseTable":
        self.spark.sql(ddl(self.name, self.targets, self.partition_cols, self.location))
        if path_exists(self.spark, self.location):
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return self

    def _checked(self, t: Target) -> F.Column:
        if t.nullable:
            return F.col(t.name)
        return F.coalesce(F.col(t.name), F.raise_error(F.lit(f"NULL in NOT NULL column {t.name} of {self.name}")).cast(t.dtype)).alias(t.name)

    def write(self, df: DataFrame, clustered: bool = False, replace: list[dict] | None = None) -> None:
        """Insert by name; a column that ``df`` lacks gets its DEFAULT."""
        have = [t for t in self.targets if t.name in df.columns]
        absent = [t.name for t in self.targets if t.name not in df.columns and t.default is None and not t.nullable]
        if absent:
            raise ValueError(f"no value for {', '.join(absent)} of {self.name}")
        replace = replace or []
        rows, written = _partition_counts(df.select(*(self._checked(t) for t in have)), replace)
        if not clustered:
            rows = rows.hint("rebalance", *self.partition_cols)
        names = ", ".join(t.name for t in have)
        rows.sparkSession.sql(f"INSERT OVERWRITE {self.name} WITH ('partitionOverwriteMode' = 'dynamic') ({names}) SELECT {names} FROM {{rows}}", rows=rows)
        for i, part in enumerate(replace):
            if not written(i):
                spec = ", ".join(f"{c} = '{part[c]}'" for c in self.partition_cols)
                self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")
                delete_path(self.spark, "/".join([self.location, *(f"{c}={part[c]}" for c in self.partition_cols)]))

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*(t.name for t in self.targets))

    def purge(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.location)
        self.create()


def load_batch(table: PartitionedTable, rows: DataFrame, load_id: str) -> None:
    """Append one load (micro-batch) under its own ``load_id`` partition."""
    table.write(rows.withColumn("load_id", F.lit(load_id)))
