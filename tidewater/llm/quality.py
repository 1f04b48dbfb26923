"""Quality rules: base counts of a text and a hashed n-gram likelihood ratio.

The ratio compares two multinomials over hashed word unigrams and bigrams: the
trusted target (documents labelled good) and the raw corpus (every document).
A document's score is the mean over its n-grams of log p_target - log p_raw,
so it does not depend on length.  The threshold is fixed from labelled
documents that took no part in the target counts, and every document is held
against it alike.

Counts of the raw corpus cover all documents; labelled rows are a bounded
sample (``SAMPLE`` of each kind, the smallest hashes of their ids).  What is
collected is the count table (``BUCKETS`` rows) and the scores of the sample.

Null or empty text: all counts 0, base_failed.  Repeated rows are scored each
on its own.  Without labelled good documents the ratio is 0 everywhere and the
base rules decide.  Null ids are scored like any other row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TOKEN, WORD, chunks, column, mix, ngram_hashes, prepare, tokens, utf8

BUCKETS = 1 << 16
SAMPLE = 10_000
TRUSTED_LOSS = 20  # rejecting a good labelled document weighs this many kept bad ones
# --- fixed values: the characters counted as symbols ----------------------
SYMBOLS = "#*$%&|<>"
# --- end fixed values -----------------------------------------------------
BLANKS = " \t\n\x0b\x0c\r"


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the unigrams and bigrams of the texts in ASCII lower case
    (tokens: runs of word bytes or of punctuation), and the text of each."""
    h, begins = tokens([utf8(t).lower() for t in texts], TOKEN)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    if len(h) > 1:
        pair = owner[1:] == owner[:-1]
        h, owner = np.concatenate([mix(h), ngram_hashes(h, 2)[pair]]), np.concatenate([owner, owner[1:][pair]])
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64), owner


def base_counts(texts: list[str | None]) -> np.ndarray:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each."""
    out = np.zeros((len(texts), 5), dtype=np.int64)
    h, begins = tokens(list(map(utf8, texts)), WORD)
    out[:, 0] = np.diff(begins)
    for k, text in enumerate(texts):
        if text:
            lines = [x for x in text.split("\n") if x.strip(BLANKS)]
            out[k, 1:4] = len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))
    if len(h) > 5:
        owner = np.repeat(np.arange(len(texts)), np.diff(begins))
        own = np.flatnonzero(owner[4:] == owner[:-4])  # windows within one text
        grams = ngram_hashes(h, 5)[own] + mix(owner[own].astype(np.uint64) + np.uint64(1))
        _, which, counts = np.unique(grams, return_inverse=True, return_counts=True)
        starts = own[counts[which] > 1]
        edge = np.bincount(starts, minlength=len(h) + 1) - np.bincount(starts + 5, minlength=len(h) + 1)
        out[:, 4] = np.bincount(owner[np.cumsum(edge)[:-1] > 0], minlength=len(texts))
    return out


def _labelled(labels: DataFrame) -> DataFrame:
    """Bounded sample of labelled ids with their part: 1 target counts, 2 good
    for the threshold, 3 bad for the threshold."""
    ids = (labels.filter("doc_id is not null and quality is not null")
           .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.min("quality").alias("quality"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic"))
           .withColumn("h", F.xxhash64("doc_id")))
    good = ids.filter("quality = 1 and toxic = 0").orderBy("h", "doc_id").limit(2 * SAMPLE)
    bad = ids.filter("quality = 0").orderBy("h", "doc_id").limit(SAMPLE)
    good = good.select("doc_id", F.when(F.col("h") % 2 == 0, 1).otherwise(2).alias("part"))
    return good.unionByName(bad.select("doc_id", F.lit(3).alias("part")))


def _count(batches):
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        texts, parts = batch.column(0).to_pylist(), np.array([p == 1 for p in batch.column(1).to_pylist()])
        for a, b in chunks([t or "" for t in texts]):
            f, owner = features(texts[a:b])
            raw += np.bincount(f, minlength=BUCKETS)
            target += np.bincount(f[parts[a:b][owner]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "n_raw", "n_target"])


def weights(docs: DataFrame, labelled: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of each bucket; the target is smoothed towards
    the raw corpus with one pseudo count a bucket."""
    rows = docs.join(F.broadcast(labelled), "doc_id", "left").select("text", "part")
    found = (rows.mapInArrow(_count, "bucket long, n_raw long, n_target long")
             .groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target"))
             .toPandas())  # BUCKETS rows at most
    raw, target = np.ones(BUCKETS), np.zeros(BUCKETS)
    raw[found["bucket"]] += found["n_raw"]
    target[found["bucket"]] = found["n_target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    p_raw = raw / raw.sum()
    p_target = (target + BUCKETS * p_raw) / (target.sum() + BUCKETS)
    return np.log(p_target) - np.log(p_raw)


def scores(texts: list[str | None], table: np.ndarray) -> np.ndarray:
    """Mean log ratio of each text; 0 without tokens."""
    out = np.zeros(len(texts))
    for a, b in chunks([t or "" for t in texts]):
        f, owner = features(texts[a:b])
        n = np.bincount(owner, minlength=b - a)
        out[a:b] = np.bincount(owner, weights=table[f], minlength=b - a) / np.maximum(n, 1)
    return out


def cut(good: list[float], bad: list[float]) -> float:
    """The score that separates the labelled samples at the least loss, in the
    middle of its gap; below all good scores when there is nothing to separate."""
    if not good:
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    at = np.unique(np.concatenate([good, bad, [good[0]]]))
    loss = TRUSTED_LOSS * np.searchsorted(good, at) / len(good) + (len(bad) - np.searchsorted(bad, at)) / max(1, len(bad))
    k = int(np.flatnonzero(loss == loss.min())[-1])
    return float((at[k] + at[k - 1]) / 2) if k else float(at[0])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """Per row: id, the base counts, llr (mean log ratio), base_failed, kept;
    with ``keep_row`` also the whole input row as struct ``row``."""
    spark = prepare(docs.sparkSession)
    plain = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    labelled = _labelled(labels)
    table = weights(plain, labelled)
    shared = spark.sparkContext.broadcast(table)

    def sample(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(scores(b.column(0).to_pylist(), shared.value))], names=["part", "llr"])

    held = plain.join(F.broadcast(labelled.filter("part > 1")), "doc_id")
    found = held.select("text", "part").mapInArrow(sample, "part int, llr double").toPandas() if table.any() else None
    threshold = -np.inf if found is None else cut(list(found.llr[found.part == 2]), list(found.llr[found.part == 3]))

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            base = np.concatenate([np.empty((0, 5), np.int64), *(base_counts(texts[i:j]) for i, j in chunks([t or "" for t in texts]))])
            llr = scores(texts, shared.value)
            failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
            cols = [b.column(0), *(pa.array(base[:, k]) for k in range(5)), pa.array(llr), pa.array(failed), pa.array(~failed & (llr >= threshold))]
            names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"]
            if keep_row:
                cols, names = [*cols, b.column(2)], [*names, "row"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double, base_failed boolean, kept boolean"
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"),
                       *([F.struct("*").alias("row")] if keep_row else []))
    schema = T.StructType.fromDDL(schema)
    if keep_row:
        schema = schema.add("row", rows.schema["row"].dataType)
    return rows.mapInArrow(run, schema)
