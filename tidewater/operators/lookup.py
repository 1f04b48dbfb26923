"""Processing-time lookup join against a reference table.

Two caches hold what was looked up, for a fixed time:

* :class:`KeyedCache` asks the store only for the keys of a batch that are not
  cached or have expired, and keeps what it got per key (a key without a
  reference row too), so a large reference is never read whole;
* :class:`ReferenceCache` re-reads a small reference whole when its age
  reaches the TTL.

Both keep their contents as a written table in the shared scratch folder: a
fixed snapshot that an executor loss or a write to the source cannot change.
An older version is removed once a newer one is written.  A change to the
reference is visible to every row processed at least one TTL after it.

Joins carry no broadcast hint: the cache is a stored table, so the planner
broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` bytes and joins by
shuffle above, where AQE splits a hot stream key.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.lake import delete_path
from tidewater.schemas import REF_ATTRIBUTES, UNKNOWN
from tidewater.session import frozen, scratch_path

DEFAULT_TTL_SECONDS = 30.0
DEFAULT_MAX_ROWS = 10_000


class _Versions:
    """Tables written one after the other; only the last is kept."""

    def __init__(self, name: str):
        self.name = name
        self.folder: str | None = None
        self.path: str | None = None
        self.number = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.folder = self.folder or scratch_path(df.sparkSession, self.name, unique=True)
        self.number += 1
        old, self.path = self.path, f"{self.folder}/version={self.number}"
        fresh = frozen(df, self.path)
        if old is not None:
            delete_path(df.sparkSession, old)
        return fresh

    def drop(self, spark: SparkSession) -> None:
        if self.folder is not None:
            delete_path(spark, self.folder)
        self.folder = self.path = None


class ReferenceCache:
    """Holds one written version of the reference table, refreshed by TTL.

    ``loader`` must build a fresh DataFrame each call (file listings and JDBC
    reads are fixed when a DataFrame is built).  ``clock`` is injectable so
    tests can move time without sleeping.
    """

    def __init__(
        self,
        loader: Callable[[], DataFrame],
        ttl_seconds: float = DEFAULT_TTL_SECONDS,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.loader = loader
        self.ttl = ttl_seconds
        self.clock = clock
        self._df: DataFrame | None = None
        self._versions = _Versions("reference-cache")
        self._loaded_at = float("-inf")
        self.refreshes = 0

    def get(self) -> DataFrame:
        now = self.clock()
        if self._df is None or now - self._loaded_at >= self.ttl:
            self._df = self._versions.write(self.loader())
            self._loaded_at = now
            self.refreshes += 1
        return self._df

    def close(self) -> None:
        if self._df is not None:
            self._versions.drop(self._df.sparkSession)
        self._df = None


class KeyedCache:
    """Reference rows by key, each with the time it was loaded.

    ``loader(keys)`` gets a DataFrame with the one column ``key`` — exactly the
    keys of a batch that are absent or expired — and returns their reference
    rows (``sources.jdbc.keyed_loader`` sends them as IN-lists).  A key may have
    several rows, or none, which is cached as well.  Between batches at most
    ``max_rows`` rows are carried over, the most recently loaded ones; others
    are asked for again when they are needed.

    The age of a row is told by the batch's processing time, or by ``clock``
    where one is given (tests).
    """

    def __init__(
        self,
        loader: Callable[[DataFrame], DataFrame],
        key: str = "icao24",
        attributes: list[str] = REF_ATTRIBUTES,
        ttl_seconds: float = DEFAULT_TTL_SECONDS,
        max_rows: int = DEFAULT_MAX_ROWS,
        clock: Callable[[], float] | None = None,
    ):
        self.loader = loader
        self.key = key
        self.attributes = list(attributes)
        self.ttl = ttl_seconds
        self.max_rows = max_rows
        self.clock = clock
        self._df: DataFrame | None = None
        self._versions = _Versions("keyed-cache")
        self.asked = 0  # keys asked of the store so far

    def _now(self, rows: DataFrame, proc_time: str | None) -> float | None:
        if self.clock is not None:
            return self.clock()
        if proc_time is None:
            return time.time()
        told = rows.agg(F.max(F.unix_micros(proc_time))).first()[0]
        return None if told is None else told / 1e6  # no rows, no keys

    def _fresh(self, spark: SparkSession, now: float) -> DataFrame | None:
        """Rows that have not expired, the newest ``max_rows`` of them."""
        if self._df is None:
            return None
        held = self._df.where(F.col("_loaded_at") > now - self.ttl)
        if held.count() > self.max_rows:
            held = held.orderBy(F.desc("_loaded_at"), self.key).limit(self.max_rows)
        return held

    def lookup(self, rows: DataFrame, proc_time: str | None = None) -> DataFrame:
        """(key, attributes) for every key of ``rows`` that has a reference
        row, none of them older than the TTL."""
        now = self._now(rows, proc_time)
        told = [self.key, *self.attributes]
        if now is None:
            fields = [rows.schema[self.key], *(T.StructField(a, T.StringType()) for a in self.attributes)]
            return rows.sparkSession.createDataFrame([], T.StructType(fields))
        keys = rows.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        fresh = self._fresh(rows.sparkSession, now)
        ask = keys if fresh is None else keys.join(fresh.select(self.key), self.key, "left_anti")
        ask = ask.persist()
        try:
            n = ask.count()
            self.asked += n
            if n or self._df is None:
                found = self.loader(ask).select(*told).withColumn("_found", F.lit(True))
                loaded = (ask.join(found, self.key, "left")
                          .select(*told, F.coalesce("_found", F.lit(False)).alias("_found"), F.lit(now).alias("_loaded_at")))
                # a batch of its own session may write; the next one reads
                self._df = self._versions.write(loaded if fresh is None else fresh.unionByName(loaded))
        finally:
            ask.unpersist()
        return self._df.where(F.col("_found") & (F.col("_loaded_at") > now - self.ttl)).select(*told)

    def close(self) -> None:
        if self._df is not None:
            self._versions.drop(self._df.sparkSession)
        self._df = None


def lookup_join(
    stream: DataFrame,
    ref: DataFrame,
    key: str = "icao24",
    attributes: list[str] = REF_ATTRIBUTES,
    default: str | None = UNKNOWN,
    dedupe: bool = False,
) -> DataFrame:
    """Left outer equi-join on ``key``; unmatched or NULL attributes → default.

    The key is not enforced: duplicate reference keys multiply stream rows
    unless ``dedupe`` keeps one row per key, the smallest.
    """
    right = ref.select(key, *attributes)
    if dedupe:
        smallest = F.min(F.struct(*attributes)).alias("_one")
        right = right.groupBy(key).agg(smallest).select(key, *(F.col("_one")[a].alias(a) for a in attributes))
    joined = stream.join(right, on=key, how="left")
    if default is None:
        return joined
    filled: list[Column] = [F.coalesce(F.col(a), F.lit(default)).alias(a) for a in attributes]
    return joined.select(*stream.columns, *filled)
