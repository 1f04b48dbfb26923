"""Packing documents into training windows: online sum-of-squares.

Every document is its ids and an end id.  Whole windows are cut off a longer
document first; what is left (shorter than a window) goes to the fill level
that makes the sum of squared counts of partly filled windows smallest, as in
online sum-of-squares bin packing.  ``levels[h]`` counts the open windows
filled to ``h``; a placement changes two entries, so each choice is a vector
difference over that array.  Ties go to the fuller level.

Tasks pack their own rows, without a shuffle, and every window is filled by
that rule until the task's rows end.  What is open then is poured one after
another into full windows (documents may be cut anywhere), which leaves one
partial window; it is cut into windows whose lengths are powers of two, which
need no padding.  The level array bounds the levels, not the windows on them:
the open windows' ids stay in memory (some hundreds of windows for tens of
thousands of documents, 8 kB each).  ``max_open`` can bound them where a
task's memory must be; beyond it the open windows are poured early.

Null and empty texts hold the end id alone; repeated rows are packed each on
its own; an empty table gives an empty result; other columns are not looked
at.  Sequence ids are unique across tasks: the task's partition in the high
bits, a running number in the low 33.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import WordBpe, byte_symbols, tokenizer_bytes
from .common import column, prepare

FAR = 1 << 40


class LibraryBpe(WordBpe):
    """Ids by the tokenizers library, asked once for each distinct word."""

    loaded: dict[str, WordBpe] = {}

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        super().__init__(raw)
        self.model = Tokenizer.from_str(raw.decode()).model
        self.symbols = byte_symbols()

    def word(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize("".join(map(self.symbols.__getitem__, word.encode())))]


class Packer:
    """The level array and its open windows.  A piece is (row, start, ids);
    ``put`` and ``finish`` return closed windows as lists of pieces."""

    def __init__(self, window: int, max_open: int | None = None):
        self.window, self.max_open = window, max_open
        self.by_rule = self.poured = 0  # windows closed
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list] = {}
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level to put ``size`` ids on: 0 opens a window."""
        w, n = self.window, self.levels
        top = w - size
        best, at = 2 * int(n[size]) + 1, 0  # a new window
        if top > 1:
            rise = np.where(n[1:top] > 0, 2 * (n[1 + size:w] - n[1:top]) + 2, FAR)[::-1]
            k = int(rise.argmin())
            if rise[k] <= best and rise[k] < FAR:
                best, at = int(rise[k]), top - 1 - k
        if n[top] and 1 - 2 * int(n[top]) <= best:  # closes a window
            at = top
        return at

    def put(self, piece) -> list[list]:
        size = len(piece[2])
        at = self.level_for(size)
        if at:
            windows = self.open[at]
            pieces = windows.pop()
            self.levels[at] -= 1
        else:
            pieces = []
            self.n_open += 1
        pieces.append(piece)
        if at + size == self.window:
            self.n_open -= 1
            self.by_rule += 1
            return [pieces]
        self.open.setdefault(at + size, []).append(pieces)
        self.levels[at + size] += 1
        return self.pour() if self.max_open is not None and self.n_open > self.max_open else []

    def pour(self) -> list[list]:
        """Refill all open windows one after another; one stays open at most."""
        pieces = [p for h in sorted(self.open, reverse=True) for w in self.open[h] for p in w]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        done, current, room = [], [], self.window
        for row, start, ids in pieces:
            while len(ids):
                head, ids = ids[:room], ids[room:]
                current.append((row, start, head))
                start, room = start + len(head), room - len(head)
                if not room:
                    done.append(current)
                    current, room = [], self.window
        if current:
            fill = self.window - room
            self.open[fill] = [current]
            self.levels[fill] = self.n_open = 1
        self.poured += len(done)
        return done

    def finish(self) -> list[list]:
        done = self.pour()
        rest = [p for windows in self.open.values() for w in windows for p in w]
        left = sum(len(p[2]) for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            current = []
            while size:
                row, start, ids = rest.pop(0)
                current.append((row, start, ids[:size]))
                if len(ids) > size:
                    rest.insert(0, (row, start + size, ids[size:]))
                size -= min(size, len(ids))
            done.append(current)
        return done


SCHEMA = "doc_id long, start long, length long, token_bytes binary, doc_tokens long, sequence_id long, offset long"
FIELDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("token_bytes", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
         end_id: int = 1, max_open: int | None = None) -> DataFrame:
    """One row per piece: where it comes from (``doc_id``, ``start``,
    ``length``, ``doc_tokens``), its ids as little-endian unsigned 32-bit
    integers, and where it lies (``sequence_id``, ``offset``)."""
    spark = prepare(docs.sparkSession)
    raw = spark.sparkContext.broadcast(tokenizer_bytes(tokenizer))

    def run(batches):
        bpe, packer = LibraryBpe.load(raw.value), Packer(window, max_open)
        serial = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        end = np.array([end_id], dtype="<u4")

        def close(windows):
            nonlocal serial
            for pieces in windows:
                offset = 0
                for (doc, total), start, ids in pieces:
                    out.append((doc, start, len(ids), ids.tobytes(), total, serial, offset))
                    offset += len(ids)
                serial += 1

        def batch():
            cols = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, FIELDS, strict=True)], schema=FIELDS)

        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), bpe.encode_all(b.column(1).to_pylist()), strict=True):
                ids = np.concatenate([ids, end])
                row, full = (doc, len(ids)), len(ids) // window * window
                close([[(row, at, ids[at:at + window])] for at in range(0, full, window)])
                if full < len(ids):
                    close(packer.put((row, full, ids[full:].copy())))
                if len(out) >= 1000:
                    yield batch()
        close(packer.finish())
        if out:
            yield batch()

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("token_bytes").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
