"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds the hashes of its distinct 5-word shingles.  Sets are
ordered globally: shingles met often last, by counts over all documents, the
others by hash.  With A(n) = ceil(t n), the l-prefix of a set of n is its first
n - A(n) + l shingles; two sets that link share at least min(l, l') shingles of
their prefixes, and more: whatever is common beyond the prefix that ends first
lies in that set's last A - l shingles, so c shared prefix shingles allow at
most c + max(A - l, A' - l') common ones.  Each document picks its l by
estimated cost (prefix postings plus verifications, the latter by the counts
of its prefix shingles divided by l), and a pair is verified only when its
prefixes leave room for that many shared shingles.

Documents with equal sets are one representative from the start.  Components
do not need every pair of a large group: first every set is checked against
the set that is most central in its postings (star), the links are joined into
components, and then all pairs of different components that share enough are
checked, which completes the join.  No link between components can be missed,
and no group is expanded into its pairs.

Postings that only one set has are dropped by a range sort over (shingle, set),
which splits a frequent shingle over many tasks.  A set's unshared prefix
shingles are in no other set, which bounds what it can share with any partner:
postings meet only if both sets' bounds allow a link and, shared postings taken
from the smallest on, enough of them are left for the shared number needed.  Large steps are written to
the shared checkpoint folder.

Hashes have 64 bits.  Null text has no words; without words a set is empty and
links with nothing; a null id gets a null component and links with nothing;
repeated rows are copies of each other; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, chunks, column, mix, ngram_hashes, prepare, stored, tokens, utf8
from .components import components, extended

WORDS = 5
ORDER_ROWS = 1 << 17  # shingles whose counts set the order (bounds the broadcast)
LENGTHS = (1, 2, 4, 8)  # prefix extensions to choose from
VERIFY = 50  # cost of a verification in postings
SEEN = 200_000  # set ids a task remembers, to send the postings of copies once


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for a, b in chunks([t or "" for t in texts]):
        h, begins = tokens([utf8(t).lower() for t in texts[a:b]], WORD)
        for i, j in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            if j - i >= WORDS:
                out.append(np.unique(ngram_hashes(h[i:j], WORDS)))
            else:  # the whole sequence as one shingle
                out.append(mix(ngram_hashes(h[i:j], j - i) + np.uint64(j - i)) if j > i else h[:0])
    return out


def set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def _sets_and_counts(batches):
    """kind 0: (doc_id, n, set id); kind 1: (shingle, count) of those that a
    batch of documents holds at least twice."""
    for b in batches:
        sets = shingle_sets(b.column(1).to_pylist())
        names, n = ["kind", "x", "n", "s"], len(sets)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0] * n, pa.int8()), b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64())], names=names)
        if n:
            values, counts = np.unique(np.concatenate(sets), return_counts=True)
            values, counts = values[counts > 1], counts[counts > 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * len(values), pa.int8()), _signed(values), pa.array(counts, pa.int64()), _signed(values)], names=names)


def choose_prefix(s: np.ndarray, often: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The prefix of a set in the global order, and its l."""
    n = len(s)
    k = np.minimum(np.searchsorted(often, s), len(often) - 1) if len(often) else np.zeros(n, dtype=np.int64)
    known = often[k] == s if len(often) else np.zeros(n, dtype=bool)
    weight = np.where(known, counts[k], 0) if len(often) else np.zeros(n, dtype=np.int64)
    order = np.argsort(weight, kind="stable")  # ties stay by hash
    need = (3 * n + 3) // 4
    total = np.cumsum(np.maximum(weight[order] - 1, 0))
    cost = {}
    for m in LENGTHS:
        if m <= need:
            p = n - need + m
            cost[m] = p + VERIFY * float(total[p - 1]) / m
    best = min(cost, key=lambda m: (cost[m], m))
    return s[order[: n - need + best]], best


def _needed(n: Column) -> Column:
    return F.floor((3 * n + 3) / 4)


def _least_shared() -> Column:
    """The least number of prefix shingles that two linking sets share."""
    need = F.ceil(3 * (F.col("n") + F.col("n2")) / 7)
    beyond = F.greatest(_needed(F.col("n")) - F.col("l"), _needed(F.col("n2")) - F.col("l2"))
    return F.greatest(F.least("l", "l2"), need - beyond)


def _lengths(n1: Column, n2: Column) -> Column:
    return (4 * n1 >= 3 * n2) & (4 * n2 >= 3 * n1)


def _feasible() -> Column:
    """Can the sets of two postings link at all?  ``most`` is what a set can
    have in common with any other: all but its unshared prefix shingles."""
    union = 3 * (F.col("n") + F.col("n2"))
    return _lengths(F.col("n"), F.col("n2")) & (7 * F.col("most") >= union) & (7 * F.col("most2") >= union)


def _shared_only(batches):
    """Of rows sorted by (shingle, set): each once, without shingles of a single
    set.  The partition's first and last rows stay, as others may follow there."""
    held, tied = None, True
    for b in batches:
        if not b.num_rows:
            continue
        x = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:
            x = [np.concatenate([h, c]) for h, c in zip(held, x, strict=True)]
        fresh = np.ones(len(x[0]), dtype=bool)
        fresh[1:] = (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1])
        x = [c[fresh] for c in x]
        same = x[0][1:] == x[0][:-1]
        keep = np.zeros(len(x[0]), dtype=bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= tied
        held, tied = [c[-1:] for c in x], bool(keep[-1])
        keep[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in x], names=b.schema.names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=["shingle", "s", "n", "l"])


def _verified(batches):
    for b in batches:
        keep = []
        for r1, r2 in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(r1, dtype=np.uint64), np.frombuffer(r2, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    told = stored(rows.mapInArrow(_sets_and_counts, "kind byte, x long, n long, s long"), "jaccard-sets")
    members = told.filter("kind = 0").select(F.col("x").alias("doc_id"), "n", "s")
    often = (told.filter("kind = 1").groupBy("x").agg(F.sum("n").alias("n")).filter("n > 3")
             .orderBy(F.col("n").desc(), "x").limit(ORDER_ROWS).toPandas())
    often = often.assign(x=often.x.to_numpy(np.int64).view(np.uint64)).sort_values("x")
    order = spark.sparkContext.broadcast((often.x.to_numpy(), often.n.to_numpy(np.int64)))

    def postings(batches):
        seen: set[int] = set()
        for b in batches:
            out: list[tuple] = []
            for s in shingle_sets(b.column(0).to_pylist()):
                if not len(s) or (key := set_id(s)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                out.append((*choose_prefix(s, *order.value), key, len(s)))
            if out:
                size = [len(p) for p, *_ in out]
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate([p for p, *_ in out])), pa.array(np.repeat([k for _, _, k, _ in out], size)),
                     pa.array(np.repeat(np.array([n for *_, n in out], dtype=np.int32), size)),
                     pa.array(np.repeat(np.array([m for _, m, _, _ in out], dtype=np.int32), size))], names=["shingle", "s", "n", "l"])

    schema = "shingle long, s long, n int, l int"
    sent = stored(rows.filter("doc_id is not null").select("text").mapInArrow(postings, schema), "jaccard-postings")
    shared = stored(sent.repartitionByRange("shingle", "s").sortWithinPartitions("shingle", "s").mapInArrow(_shared_only, schema), "jaccard-shared")

    # star: every set against the one that is most central in its postings,
    # the one with the largest part of its prefix shared
    central = shared.groupBy("s", "n", "l").agg(F.count("*").alias("central"))
    central = stored(central.select("s", (_needed(F.col("n")) - F.col("l") + F.col("central")).alias("most"),
                                    (F.col("central") / (F.col("n") - _needed(F.col("n")) + F.col("l"))).alias("part")), "jaccard-central")
    posted = stored(shared.join(central, "s"), "jaccard-posted")
    leaders = posted.groupBy("shingle").agg(F.max(F.struct("part", "n", "s", "l", "most")).alias("top"))
    star = (posted.join(leaders, "shingle").filter("s <> top.s").select("s", "n", "l", "most", *(F.col(f"top.{c}").alias(f"{c}2") for c in ("s", "n", "l", "most")))
            .filter(_feasible()).groupBy("s", "s2").agg(F.count("*").alias("c"))
            .groupBy("s").agg(F.max(F.struct("c", "s2")).alias("best")))
    links = _verify(rows, members, stored(star.select(F.col("s").alias("a"), F.col("best.s2").alias("b")), "jaccard-star"))
    first = components(links, "jaccard-first")

    # the rest: pairs of different components
    dealt = posted.join(first, posted["s"] == first["id"], "left").select("shingle", "s", "n", "l", "most", F.coalesce("component", "s").alias("k"))
    mixed = dealt.groupBy("shingle").agg(F.min("k").alias("k1"), F.max("k").alias("k2")).filter("k1 <> k2").select("shingle")
    dealt = stored(dealt.join(mixed, "shingle", "left_semi"), "jaccard-mixed")
    # what a set can share is now in its mixed postings; in the order of their
    # sizes the first common one must leave room for all that a link needs
    size = dealt.groupBy("shingle").agg(F.count("*").alias("size"))
    whole = Window.partitionBy("s")
    dealt = (dealt.join(size, "shingle")
             .withColumn("room", F.row_number().over(whole.orderBy(F.col("size").desc(), F.col("shingle").desc())))
             .withColumn("most", _needed(F.col("n")) - F.col("l") + F.count("*").over(whole)).drop("size"))
    dealt = stored(dealt, "jaccard-ranked")
    other = dealt.select("shingle", *(F.col(c).alias(f"{c}2") for c in ("s", "n", "l", "most", "k", "room")))
    pairs = dealt.join(other, "shingle").filter((F.col("k") < F.col("k2")) & _feasible() & (F.least("room", "room2") >= _least_shared())).select("s", "s2").distinct()
    more = _verify(rows, members, stored(pairs.select(F.col("s").alias("a"), F.col("s2").alias("b")), "jaccard-rest"))
    groups = extended(first, more, "jaccard-groups")

    full = (members.join(groups, members["s"] == groups["id"], "left")
            .select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "s")).alias("k")))
    least = full.filter("doc_id is not null").groupBy("k").agg(F.min("doc_id").alias("component_id"))
    return (full.join(least.filter("k is not null"), "k", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def _verify(rows: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids whose whole sets link."""
    asked = pairs.select(F.col("a").alias("s")).union(pairs.select(F.col("b").alias("s"))).distinct()
    ids = members.filter("doc_id is not null").join(asked, "s", "left_semi").groupBy("s").agg(F.min("doc_id").alias("doc_id"))
    ids = stored(ids.select("doc_id").distinct(), "jaccard-asked")

    def sets(batches):
        for b in batches:
            found = shingle_sets(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([set_id(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())], names=["s", "set"])

    full = rows.join(ids, "doc_id", "left_semi").select("text").mapInArrow(sets, "s long, set binary")
    # rows that share an id may have other texts: only the sets asked for, each once
    full = stored(full, "jaccard-full").join(asked, "s", "left_semi").dropDuplicates(["s"])
    one, two = full.select(F.col("s").alias("a"), F.col("set").alias("set_a")), full.select(F.col("s").alias("b"), F.col("set").alias("set_b"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(_verified, "a long, b long")
