"""Periodic runs of words by the dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q and at least
``max(6, 4 * q)`` words that cannot be extended with that period.  For every
power of two L the dictionary names the factors of L words: names of 2 * L words
are pairs of names of L words.  A factor's next occurrence d words on, both
within 2 * L words, and the one after it again d on, are an arithmetic
progression that proposes the period d; neighbouring positions with the same
proposal cover a stretch, which is extended word by word and kept once, however
many lengths propose it.

Nothing is missed: with q <= L < 2 * q the next occurrence of a factor inside a
run is exactly q on, and a run of 4 * q words has room for two such positions
with three occurrences each.  A name that occurs once in its text is not carried
to longer factors, as no longer factor there can repeat.

Texts are handled in chunks within an Arrow batch; a longer text is a chunk of
its own, whole.  Null text and text without words have no runs; rows are handled
one by one, so repeated rows give repeated results; an empty table gives an
empty result; other columns are not looked at.  Where an id is null no words are
replaced (:func:`repeated_words`).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, column, prepare

LEAST_WORDS, LEAST_PERIODS = 6, 4


def names_of(words: list) -> np.ndarray:
    """A number for every word, the same for equal words: the place where the
    word stands last."""
    last = dict(zip(words, range(len(words))))
    return np.fromiter(map(last.__getitem__, words), dtype=np.int64, count=len(words))


def proposals(names: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Distinct (start, end, period) proposed for the texts laid one after the
    other in ``names`` (equal only within a text); ``ends`` holds for every word
    where its text ends.  Sorted."""
    n = len(names)
    found = [np.empty((0, 3), dtype=np.int64)]
    name, at, size = names, np.arange(n), 1
    while len(at):
        order = np.lexsort((at, name))
        at, name = at[order], name[order]
        same = name[1:] == name[:-1]
        repeats = np.zeros(len(at), dtype=bool)
        repeats[1:] |= same
        repeats[:-1] |= same
        at, name = at[repeats], name[repeats]
        if not len(at):
            break
        # the next two occurrences: equally far, within 2 * size words
        step = at[1:] - at[:-1]
        near = (name[1:] == name[:-1]) & (step <= size)
        three = near[:-1] & near[1:] & (step[:-1] == step[1:])
        if three.any():
            first, period = at[:-2][three], step[:-1][three]
            order = np.argsort(first)
            first, period = first[order], period[order]
            new = np.ones(len(first), dtype=bool)
            new[1:] = (first[1:] != first[:-1] + 1) | (period[1:] != period[:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(first)) - 1
            start, q = first[begin], period[begin]
            end = first[last] + size + 2 * q
            long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
            found.append(np.stack([start, end, q], axis=1)[long])
        # names of twice the length
        rank = np.empty(len(at), dtype=np.int64)
        rank[0] = 0
        np.cumsum(name[1:] != name[:-1], out=rank[1:])
        dense = np.full(n, -1, dtype=np.int64)
        dense[at] = rank
        right = at + size
        fits = right < n
        second = np.where(fits, dense[np.minimum(right, n - 1)], -1)
        whole = (second >= 0) & (at + 2 * size <= ends[at])
        at, name = at[whole], rank[whole] * (rank[-1] + 1) + second[whole]
        size *= 2
    return np.unique(np.concatenate(found), axis=0)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries are equal, in blocks of growing size."""
    done, block, n = 0, 32, min(len(a), len(b))
    while done < n:
        differ = np.flatnonzero(a[done:done + block] != b[done:done + block])
        if len(differ):
            return done + int(differ[0])
        done, block = min(n, done + block), block * 2
    return done


def extend(names: np.ndarray, lo: int, hi: int, start: int, end: int, q: int) -> tuple[int, int]:
    """The largest stretch around (start, end) with period q within lo..hi."""
    end += _common(names[end - q:hi - q], names[end:hi])
    start -= _common(names[lo + q:start + q][::-1], names[lo:start][::-1])
    return start, end


def runs_of(words_of: list[list]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every text, by start, then period."""
    sizes = np.array([len(w) for w in words_of], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    if not begins[-1]:
        return [[] for _ in words_of]
    names = np.concatenate([names_of(w) + b for w, b in zip(words_of, begins)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in words_of]
    proposed = proposals(names, np.repeat(begins[1:], sizes))
    owners = np.searchsorted(begins, proposed[:, 0], "right") - 1
    seen = set()
    for (start, end, q), k in zip(proposed.tolist(), owners.tolist()):
        lo = int(begins[k])
        start, end = extend(names, lo, int(begins[k + 1]), start, end, q)
        if (start, end) not in seen:  # smaller periods of a stretch come first
            seen.add((start, end))
            out[k].append((start - lo, end - start, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; of equal
    ones the first."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """False for the words that stand in a run after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, q in found:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def repeated_words(doc_id: int | None, words: list) -> list:
    """The words of a document, every tenth document (by the CRC of its id)
    with its tail overwritten by repeats of a stretch of it."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (1 + (n - a) // len(unit)))[:n - a]


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, runs array<struct<start:long,length:long,period:long>>, "
          "runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long")
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _tell(doc_id, words: list, found: list) -> tuple:
    kept = words
    if found:
        kept = [w for w, k in zip(words, kept_words(len(words), found).tolist()) if k]
    top = strongest(found) or (None, None, None)
    told = "".join("%d,%d,%d\n" % r for r in found).encode()
    return (doc_id, len(found), *top, [dict(zip(("start", "length", "period"), r)) for r in found],
            hashlib.sha256(told).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(), len(words), len(words) - len(kept)), kept


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, keep_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_runs, the strongest run (start, length, period; null
    without one), all runs, digests of the runs and of the kept words, n_words
    and n_dropped; with ``keep_text`` also ``collapsed``, the kept words joined
    by single spaces.  ``plant`` overwrites the tail of every tenth document
    with repeats first (:func:`repeated_words`)."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows, kept = [], []
            for i, j in chunks([t or b"" for t in texts]):
                # bytes are split at exactly the six ASCII blanks
                words = [(t or b"").split() for t in texts[i:j]]
                if plant:
                    words = [repeated_words(d, w) for d, w in zip(ids[i:j], words)]
                for d, w, found in zip(ids[i:j], words, runs_of(words)):
                    row, left = _tell(d, w, found)
                    rows.append(row)
                    if keep_text:
                        kept.append(b" ".join(left))
            if not rows:
                continue
            types = [pa.int64()] * 5 + [pa.list_(RUN), pa.string(), pa.string(), pa.int64(), pa.int64()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            names = ["doc_id", "n_runs", "start", "length", "period", "runs", "runs_sha256", "collapsed_sha256", "n_words", "n_dropped"]
            if keep_text:
                cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "collapsed"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").cast("binary").alias("text"))
    out = rows.mapInArrow(run, SCHEMA + (", collapsed binary" if keep_text else ""))
    return out.withColumn("collapsed", out["collapsed"].cast("string")) if keep_text else out


def digest(found: DataFrame) -> DataFrame:
    return found.selectExpr("doc_id", "n_runs", "start", "length", "period", "1000 * length div period as exponent_milli",
                            "runs_sha256", "collapsed_sha256")
