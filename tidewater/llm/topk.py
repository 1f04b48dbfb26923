"""Exact top-k by inner product: threshold algorithm over sorted lists.

Vectors are cut into blocks.  In a block every dimension has its list, sorted
by value once for all queries; a query walks all lists at once, from the top
where its weight is positive and from the bottom where it is negative, and
scores in full what it meets for the first time.  The bound on all it has not
met is the sum of the values at the walked depth times the weights; once the
kth score found beats it, the query is done with the block (a tie walks on: the
unmet row may have the smaller id).  Depths double, so a query scores each row
at most once and stops within twice the depth it needs.

Queries meet candidates in blocks, dealt over a grid of query groups (about
``QUERY_ROWS`` each) by slabs of blocks; every (block, group) is one row of
work of the same size whatever the vectors hold, and gives k rows per query.

Null vectors, and vectors with null or non-finite components, take no part.
Repeated rows (same id, same vector) count once; a row with the query's id is
not its candidate.  Vectors meet others of their own length only; scores beyond
64 bits saturate.  Ties go to the smaller id.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import column, prepare

BLOCK_ROWS, QUERY_ROWS, SLABS = 4096, 512, 16


def quantized(c: Column) -> Column:
    """floor(256 * x) of each component, or null for a vector that takes no part."""
    fine = c.isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(c, lambda x: F.floor(x.cast("double") * 256).cast("long")))


def _blocks(rows_most: int):
    def run(batches):
        serial, held = TaskContext.get().partitionId() << 32, {}

        def close(dim):
            nonlocal serial
            ids, vecs = zip(*held.pop(dim), strict=True)
            serial += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([serial]), pa.array([dim], pa.int32()), pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()),
                 pa.array([np.array(vecs, dtype="<i8").tobytes()], pa.binary())], names=["block", "dim", "ids", "vecs"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = held.setdefault(len(v), [])
                rows.append((i, v))
                if len(rows) >= rows_most or len(held) > 8:
                    yield close(len(v))
        for dim in list(held):
            yield close(dim)
    return run


def _matrix(ids: bytes, vecs: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, dtype="<i8")
    return found, np.frombuffer(vecs, dtype="<i8").reshape(len(found), dim)


def threshold_topk(ids: np.ndarray, vecs: np.ndarray, qids: np.ndarray, queries: np.ndarray, k: int):
    """(query, id, score, scored) of each query's k best rows of one block;
    ``scored`` is how many of its rows the query has scored."""
    n, dim = vecs.shape
    big = dim * float(np.abs(vecs).max(initial=0)) * float(np.abs(queries).max(initial=0))
    kind = np.float64 if big < 2**53 else object
    # the lists, once for the block: row numbers by value, and each row's place
    # from the top and from the bottom of every list
    order = np.argsort(vecs, axis=0, kind="stable")
    low = np.empty((dim, n), dtype=np.int32)
    np.put_along_axis(low, order.T, np.arange(n, dtype=np.int32)[None, :], axis=1)
    top = n - 1 - low
    sorted_k, vecs_k, out = np.take_along_axis(vecs, order, axis=0).astype(kind), vecs.astype(kind), []
    for own, query in zip(qids.tolist(), queries):
        q, up, down = query.astype(kind), query > 0, query < 0
        first = np.full(n, n, dtype=np.int32)  # the depth that meets a row
        for lists in (top[up], low[down]):
            if len(lists):
                np.minimum(first, lists.min(axis=0), out=first)
        done, depth, scored = 0, k, 0
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=kind)
        while True:
            depth = min(depth, n)
            new = np.flatnonzero((first >= done) & (first < depth)) if depth < n else np.flatnonzero(first >= done)
            scored += len(new)
            new = new[ids[new] != own]
            best_ids, best = np.concatenate([best_ids, ids[new]]), np.concatenate([best, vecs_k[new] @ q])
            if len(best) > k:
                keep = np.lexsort((best_ids, -best))[:k] if kind is np.float64 else np.array(sorted(range(len(best)), key=lambda x: (-best[x], best_ids[x]))[:k])
                best_ids, best = best_ids[keep], best[keep]
            if depth == n:
                break
            bound = sorted_k[n - depth][up] @ q[up] + sorted_k[depth - 1][down] @ q[down]
            if len(best) == k and best.min() > bound:
                break
            done, depth = depth, 2 * depth
        out += [(own, int(i), int(x), scored) for i, x in sorted(zip(best_ids.tolist(), best.tolist()), key=lambda r: (-r[1], r[0]))]
    return out


def _search(k: int):
    low, high = -(1 << 63), (1 << 63) - 1

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                found = threshold_topk(*_matrix(r["ids"], r["vecs"], r["dim"]), *_matrix(r["q_ids"], r["q_vecs"], r["dim"]), k)
                cols = list(zip(*found, strict=True)) or [[], [], [], []]
                cols[2] = [min(high, max(low, s)) for s in cols[2]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score", "scored"])
    return run


def topk(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` best rows for each row that ``queries`` (a condition on the id,
    named ``vec_id``) selects: query_id, rank, vec_id, score."""
    prepare(vectors.sparkSession)
    rows = (vectors.select(column(id_col).cast("long").alias("vec_id"), quantized(column(vec_col)).alias("v"))
            .filter("vec_id is not null and v is not null").dropDuplicates(["vec_id", "v"]))
    blocks = rows.mapInArrow(_blocks(BLOCK_ROWS), "block long, dim int, ids binary, vecs binary")
    groups = (rows.filter(queries).mapInArrow(_blocks(QUERY_ROWS), "block long, dim int, ids binary, vecs binary")
              .select(F.col("block").alias("group"), F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")))
    # a grid: a query group meets the blocks of one slab in one task
    n_groups = max(1, -(-rows.filter(queries).count() // QUERY_ROWS))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    groups = groups.withColumn("g", deal("group", n_groups)).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SLABS - 1))))
    blocks = blocks.withColumn("s", deal("block", SLABS)).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    work = (blocks.join(groups, (F.col("dim") == F.col("q_dim")) & (blocks["g"] == groups["g"]) & (blocks["s"] == groups["s"]))
            .select("dim", "ids", "vecs", "q_ids", "q_vecs"))
    found = work.mapInArrow(_search(k), "query_id long, vec_id long, score long, scored long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
