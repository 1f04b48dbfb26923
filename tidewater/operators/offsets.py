"""Dense per-partition offsets for a file-backed topic, computed distributed.

A topic partition is one ordered log, and its offsets are a running count.
Numbering with ``row_number() OVER (PARTITION BY partition ...)`` would pull a
whole topic partition (possibly a third of the data for a hot key) into one
task.  Instead:

1. write the rows down, so that what produces them runs once;
2. range-partition by (partition, order) so a big topic partition is cut
   into several slices, sort inside each slice;
3. give each row a slice id and a monotonically increasing id, and write that
   too: counts and rows agree even if tasks are re-run;
4. count rows per (partition, slice) and turn the counts into running totals;
5. offset = base + rows in earlier slices + position inside the slice.

The totals are a stored table, so the planner broadcasts them by their size in
bytes and joins them by shuffle above ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import frozen, scratch_path


def assign_offsets(
    df: DataFrame,
    order_cols: list[str],
    partition_col: str = "partition",
    base: DataFrame | None = None,
    slices: int | None = None,
    offset_col: str = "offset",
    folder: str | None = None,
) -> DataFrame:
    """Add ``offset_col``: 0-based (plus ``base.next_offset``) per partition.

    ``folder`` holds what is written on the way; the caller may delete it once
    the result is written."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "offsets", unique=True)
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = frozen(df, f"{folder}/rows")
    ranged = frozen(rows.repartitionByRange(n, partition_col, *order_cols)
                    .sortWithinPartitions(partition_col, *order_cols)
                    .withColumn("_slice", F.spark_partition_id())
                    .withColumn("_rid", F.monotonically_increasing_id()), f"{folder}/ranged")
    earlier = Window.partitionBy(partition_col).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    stats = (ranged.groupBy(partition_col, "_slice")
             .agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
             .drop("_n"))
    if base is not None:
        stats = stats.join(base.select(partition_col, "next_offset"), partition_col, "left")
    else:
        stats = stats.withColumn("next_offset", F.lit(0).cast("long"))
    out = ranged.join(frozen(stats, f"{folder}/totals"), [partition_col, "_slice"], "inner")
    offset = (F.coalesce(F.col("next_offset"), F.lit(0)) + F.col("_before")
              + (F.col("_rid") - F.col("_first")))
    return out.withColumn(offset_col, offset.cast("long")).drop(
        "_slice", "_rid", "_first", "_before", "next_offset")
