"""JDBC reference source (S15) for the lookup caches.

``reference_loader`` reads the reference whole (``ReferenceCache``); for a large
one, ``partition_column`` with bounds splits the read into ``num_partitions``
parallel range queries.  ``keyed_loader`` asks only for given keys, as IN-lists
pushed to the database (``KeyedCache``).  No JDBC database is started in this
repository's tests; the functions take any URL and driver on the classpath.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SLICE_KEYS = 500  # keys in one IN-list
MOST_KEYS = 10_000  # keys that go through the driver into IN-lists


def reference_loader(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                     columns: list[str] | None = None, partition_column: str | None = None,
                     lower: int | None = None, upper: int | None = None,
                     num_partitions: int = 8) -> Callable[[], DataFrame]:
    """A loader for ``ReferenceCache``: builds a fresh JDBC DataFrame per call
    (a DataFrame fixes its read when built, so each TTL refresh re-reads)."""
    props = dict(properties or {})

    def load() -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        for k, v in props.items():
            reader = reader.option(k, v)
        if partition_column is not None:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", lower).option("upperBound", upper)
                      .option("numPartitions", num_partitions))
        df = reader.load()
        return df.select(*columns) if columns else df
    return load


def literal(value) -> str:
    """A key as SQL text: numbers as they are, anything else quoted."""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return "'" + str(value).replace("'", "''") + "'"
    return repr(value)


def in_lists(key: str, values: list, slice_keys: int = SLICE_KEYS) -> list[str]:
    """Predicates ``key IN (...)`` of at most ``slice_keys`` values each; every
    one is a partition of the read and a query of its own."""
    values = sorted(values)
    return [f"{key} IN ({', '.join(map(literal, values[i:i + slice_keys]))})" for i in range(0, len(values), slice_keys)]


def keyed_loader(read: Callable[[list[str]], DataFrame], whole: Callable[[], DataFrame], key: str,
                 slice_keys: int = SLICE_KEYS, most_keys: int = MOST_KEYS) -> Callable[[DataFrame], DataFrame]:
    """A loader for ``KeyedCache``.  ``read(predicates)`` is the store's read
    under predicates (``jdbc_predicates``).  Up to ``most_keys`` keys are asked
    for by IN-lists; a batch with more of them reads ``whole()`` and keeps the
    rows of its keys in a join, so no unbounded list passes the driver."""
    def load(keys: DataFrame) -> DataFrame:
        asked = [r[0] for r in keys.select(key).limit(most_keys + 1).collect()]
        if len(asked) > most_keys:
            return whole().join(keys.select(key), key, "left_semi")
        if not asked:
            return whole().limit(0)
        return read(in_lists(key, asked, slice_keys))
    return load


def jdbc_predicates(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> Callable[[list[str]], DataFrame]:
    """Spark's JDBC read under predicates, one partition for each."""
    def read(predicates: list[str]) -> DataFrame:
        return spark.read.jdbc(url, table, predicates=predicates, properties=dict(properties or {}))
    return read
