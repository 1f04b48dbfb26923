"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words.  A document's expected copies are its
source's target over its source's words (times its own weight over the source's
mean weight, where a weight column is named).  The whole copies are certain.
What is left of the target is a sample of fixed size, in words, with the
fractions as unequal inclusion probabilities p: a document gets a uniform
number u out of its id and text and ranks by the odds of u over the odds of p;
documents are taken from the smallest rank on until the words are there.  The
document at the border gives its first words, as many as are missing, so that
a source's words differ from its target by less than one.

No source is sorted as a whole.  Ranks fall into ``BUCKETS`` equal parts of
r / (1 + r); words are added up by source and bucket, running sums over these
(at most ``BUCKETS`` rows a source) find the bucket at the border, and only the
documents in that bucket are ordered.  Near the border a part holds at most one
of ``BUCKETS`` of the source's rows, whatever the probabilities.  The source
table has one row per source; Spark broadcasts it only while its stored size is
below ``spark.sql.autoBroadcastJoinThreshold``.

Null text has no words and takes none.  Null sources are one source, ordered
last; an empty name is another.  A null id is hashed as such.  Rows that share
id, source and text rank alike: at the border some are taken and some are not,
always as many.  A source without words has target 0.  An empty table gives an
empty result.  Other columns are not looked at, unless ``keep_row`` carries the
whole row along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, stored

BUCKETS = 1 << 16
WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"
# --- fixed values: u is the first 13 hexadecimal digits of an MD5, 52 bits ---
DIGITS = 13
# --- end fixed values -----------------------------------------------------


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) with weight and target.

    A source over ``cap`` times its size stays there and the excess goes to the
    others by weight: the level c with sum(min(cap * size, c * weight)) = total
    * all words, found by running sums over the sources in the order in which
    they fill up.  One row per source."""
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.get(F.array(*map(F.lit, weights)), F.col("place") % len(weights))
    full = F.col("source_size") * F.lit(cap)
    ranked = ranked.select("source", "source_size", weight.alias("weight"), full.alias("full"), (full / weight).alias("fills"))
    before = Window.orderBy("fills", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) * total - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # a source is full when the level of those not yet full is at least its own
    open_level = ranked.withColumn("level", level).withColumn("open", F.col("level") < F.col("fills"))
    first = F.min(F.when(F.col("open"), F.struct("fills", F.col("source").isNull().alias("last"), "source", "level"))).over(every)["level"]
    return open_level.withColumn("c", first).select(
        "source", "source_size", "weight",
        F.when(F.col("open"), F.col("weight") * F.col("c")).otherwise(F.col("full")).alias("target"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = 1.5, cap: float = 2.0, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", weight_col: str | None = None, keep_row: bool = False) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, whole (certain
    copies), extra (words of one more copy: 0, all, or those still missing at
    the border) and taken; with ``keep_row`` also the input row as ``row``.

    ``weight_col`` (null or not above 0: weight 0, never preferred) makes the
    expected copies unequal within a source; ``cap`` bounds the copies of a
    source and of a document."""
    text = column(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.concat_ws("\n", F.coalesce(column(id_col).cast("string"), F.lit("")), F.coalesce(text, F.lit(""))).cast("binary"))
    own = F.greatest(F.coalesce(column(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight_col else F.lit(1.0)
    rows = stored(docs.select(
        column(id_col).cast("long").alias("doc_id"), column(source_col).cast("string").alias("source"), size.alias("size"),
        F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long").alias("u"), own.alias("own"),
        *([F.struct("*").alias("row")] if keep_row else [])), "mix-rows")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("own") * F.col("size")).alias("weighted"))
    sums = stored(sums, "mix-sums")
    plan = targets(sums.select("source", "source_size"), weights, total, cap)
    plan = plan.withColumnRenamed("source", "s").join(sums.select("source", "weighted"), _same("s", "source")).drop("source")
    plan = stored(plan, "mix-plan")

    sized = rows.join(plan, _same("source", "s")).drop("s", "weight")
    expected = F.least(F.when(F.col("weighted") > 0, F.col("target") * F.col("own") / F.col("weighted")).otherwise(F.lit(0.0)), F.lit(cap))
    sized = sized.withColumn("whole", F.floor(expected).cast("long"))
    p = F.greatest(expected - F.col("whole"), F.lit(2.0 ** -50))
    u = (F.col("u") + 0.5) / F.lit(2.0 ** (4 * DIGITS))
    sized = sized.withColumn("rank", (u / (1 - u)) / (p / (1 - p)))
    sized = sized.withColumn("bucket", F.least(F.floor(F.col("rank") / (1 + F.col("rank")) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    # a document with `cap` certain copies has no further one to give
    sized = sized.withColumn("free", F.when(F.col("whole") + 1 <= cap, F.col("size")).otherwise(F.lit(0).cast("long")))

    by_bucket = sized.groupBy("source", "bucket").agg(F.sum("free").alias("free"), F.sum(F.col("whole") * F.col("size")).alias("certain"),
                                                      F.first("target").alias("target"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("source")
    by_bucket = (by_bucket.withColumn("upto", F.sum("free").over(running))
                 .withColumn("need", F.round(F.col("target") - F.sum("certain").over(whole)).cast("long")))
    # the first bucket whose words reach the need; a source short of words has none
    border = (by_bucket.where("upto >= need").groupBy("source")
              .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("free")).alias("before"), "need")).alias("b"))
              .select(F.col("source").alias("s"), F.col("b.bucket").alias("edge"), "b.before", "b.need"))
    border = stored(border, "mix-border")

    placed = sized.join(border, _same("source", "s"), "left").drop("s")
    keep = ["row"] if keep_row else []
    told = ["doc_id", "source", "size", "source_size", "target", "whole", *keep]
    clear = placed.where(F.col("edge").isNull() | (F.col("bucket") != F.col("edge"))).select(
        *told, F.when(F.col("edge").isNull() | (F.col("bucket") < F.col("edge")), F.col("free")).otherwise(F.lit(0).cast("long")).alias("extra"))
    ordered = Window.partitionBy("source").orderBy("rank", "u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = F.col("need") - F.col("before") - (F.sum("free").over(ordered) - F.col("free"))
    edge = placed.where(F.col("bucket") == F.col("edge")).withColumn("missing", missing)
    edge = edge.select(*told, F.greatest(F.least(F.col("missing"), F.col("free")), F.lit(0).cast("long")).alias("extra"))
    return clear.unionByName(edge).withColumn("taken", F.col("whole") * F.col("size") + F.col("extra"))


def mixed_rows(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for every copy.  The
    copy at a source's border holds the document's first words, joined by
    single spaces."""
    found = mix(docs, text_col=text_col, keep_row=True, **how)
    parts = F.concat(F.array_repeat(F.col("size"), F.col("whole").cast("int")), F.when(F.col("extra") > 0, F.array("extra")).otherwise(F.array().cast("array<bigint>")))
    copies = found.select("row", "size", F.explode(parts).alias("n")).where("n > 0")
    text = F.col("row")[text_col]
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("n").cast("int")), " ")
    told = {text_col: F.when(F.col("n") < F.col("size"), cut).otherwise(text)}
    return copies.select(*(told.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "size", "source_size", "target", "taken")
