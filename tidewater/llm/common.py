"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path, ship_package

# Arrow batches handed to Python tasks: rows and bytes, whichever comes first.
BATCH_ROWS = 1000
BATCH_BYTES = "32m"


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the Python workers and bound their Arrow batches."""
    ship_package(spark)
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        spark.conf.set(key, value)
    return spark


def column(name: str):
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage with a copy that survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def runs(codes: np.ndarray, inside: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, lengths and 64-bit hashes of the tokens of a code array.

    ``start`` marks the first code of each token; what lies between tokens is
    not ``inside``.  The hash is a sum over codes mixed with their positions,
    so it is one pass over the array however many tokens there are."""
    at = np.flatnonzero(start)
    if not len(at):
        return at, at, np.empty(0, dtype=np.uint64)
    codes, inside = codes[at[0]:], inside[at[0]:]
    n = len(codes)
    place = np.arange(n, dtype=np.uint64) - np.repeat((at - at[0]).astype(np.uint64), np.diff(at, append=at[0] + n))
    v = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D)
    v ^= v >> np.uint64(29)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(32)
    v *= inside
    return at, np.add.reduceat(inside, at - at[0], dtype=np.int64), np.add.reduceat(v, at - at[0])


CHUNK = 1 << 20  # codes handled at a time


def chunks(texts: list, most: int = CHUNK):
    """Ranges (from, to) of texts of about ``most`` codes; a longer text alone."""
    at = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, k
            at, size = k, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def byte_classes(spaces: bytes, marks: bool) -> np.ndarray:
    """Class of each byte: 0 space, 1 word; with ``marks`` 2 for ASCII
    punctuation, so that words and punctuation are tokens of their own."""
    out = np.ones(256, dtype=np.uint8)
    if marks:
        out[[b for b in range(128) if not (chr(b).isalnum() or b == 95)]] = 2
    out[list(spaces)] = 0
    return out


WORD = byte_classes(b" \t\n\x0b\x0c\r", False)  # words [^\x20\x09-\x0D]+
TOKEN = byte_classes(b" \t\n\x0b\x0c\r", True)


def tokens(texts: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, and where each text's tokens begin
    (one more entry than texts)."""
    codes = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    kind = classes[codes]
    start = kind != 0
    start[1:] &= kind[1:] != kind[:-1]
    at, _, h = runs(codes, kind != 0, start)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return h, np.searchsorted(at, begins)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every other."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for every run of ``n`` consecutive words, in order."""
    out = h[: len(h) - n + 1]
    for k in range(1, n):
        out = mix(out) + h[k: len(h) - n + 1 + k]
    return mix(out)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")
