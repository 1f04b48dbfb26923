"""Dense per-partition offsets without one task per topic partition."""

from pyspark.sql import functions as F

from tidewater.operators.offsets import assign_offsets


def test_offsets_dense_with_a_hot_partition(spark):
    # partition 0 holds a third of the rows (a hot key)
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 5).alias("partition"),
        F.col("id").alias("seq"))
    out = assign_offsets(df, ["seq"], "partition", slices=6)
    got = out.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                                       F.count(F.lit(1)).alias("n"), F.countDistinct("offset").alias("d"))
    for r in got.collect():
        assert r["lo"] == 0 and r["hi"] == r["n"] - 1 and r["d"] == r["n"]
    # order follows seq inside a partition
    firsts = out.where("partition = 0").orderBy("offset").limit(3).collect()
    assert [r["seq"] for r in firsts] == [0, 3, 6]


def test_offsets_continue_after_base(spark):
    df = spark.range(0, 10).select(F.lit(0).alias("partition"), F.col("id").alias("seq"))
    base = spark.createDataFrame([(0, 100)], "partition int, next_offset long")
    out = assign_offsets(df, ["seq"], "partition", base=base)
    assert sorted(r["offset"] for r in out.collect()) == list(range(100, 110))


def test_offsets_dense_after_an_unordered_shuffle(spark):
    # rows arrive through a round-robin shuffle from several map tasks, whose
    # blocks can be fetched in any order: counts and ids must still agree
    df = (spark.range(0, 60000, numPartitions=6).repartition(8)
          .select(F.lit(0).alias("partition"), F.col("id").alias("seq")))
    out = assign_offsets(df, ["seq"], "partition", slices=5)
    r = out.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                F.countDistinct("offset").alias("d"),
                F.sum((F.col("offset") != F.col("seq")).cast("int")).alias("moved")).first()
    assert (r["lo"], r["hi"], r["d"], r["moved"]) == (0, 59999, 60000, 0)
