"""BPE encoding and decoding with a tokenizer file of the public kind: NFC,
lower case, white space dropped, byte-level symbols, word-end suffix.

Every word is encoded on its own by the queue of merge ranks: symbols form a
doubly linked list, the queue holds (rank, position, merged id) of each
adjacent pair that can merge, and an entry whose pair has changed meanwhile is
skipped.  Decoding looks every id up and joins the vocabulary strings (with a
space, as a file without a decoder asks).

Null text is empty and gives no ids; repeated rows are encoded each on its
own; an empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, prepare, runs

# White space as the tokenizer file's \\s sees it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACES, LETTER, NUMBER, OTHER = range(4)
MAX_FILE_MB = 64
MAX_WORDS, MAX_IDS = 1_500_000, 8_000_000  # a task forgets its words beyond these


def code_classes() -> np.ndarray:
    """Class of every code point: space, letter, number, other."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACES, f"[{SPACE}]+")):
        for m in regex.finditer(pattern, every):
            out[ord(m[0][0]): ord(m[0][-1]) + 1] = kind
    return out


def word_starts(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Marks the first code of each word: a run of letters, a single number, a
    run of others; an apostrophe alone before s, t, m, d, re, ve or ll takes
    these letters with it."""
    start = kind != SPACES
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    quote = np.flatnonzero((codes[:-1] == 39) & start[:-1] & (kind[1:] == LETTER))
    if len(quote):
        first = codes[quote + 1]
        second = np.where(quote + 2 < len(codes), codes[np.minimum(quote + 2, len(codes) - 1)], 0)
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = (second == ord("e")) & np.isin(first, [ord("r"), ord("v")]) | (first == ord("l")) & (second == ord("l"))
        start[quote[one | two] + 1] = False
        for taken, size in ((one, 2), (two & ~one, 3)):
            after = quote[taken] + size
            after = after[after < len(codes)]
            start[after] |= kind[after] == LETTER
    return start


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it prints, else the
    next free code point from 256."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(free)
            free += 1
    return out


class WordBpe:
    """Encoder and decoder built from the bytes of a tokenizer file."""

    loaded: dict[str, WordBpe] = {}

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + suffix] for s in symbols]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = added
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.strings = [""] * (1 + max([*vocab.values(), *added.values()]))
        for s, i in [*vocab.items(), *added.items()]:
            self.strings[i] = s
        self.kinds = code_classes()
        self.forget()

    def forget(self):
        """Words met so far: sorted hashes, each with its run in ``flat``."""
        self.known, self.first, self.count = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, dtype="<u4")

    @classmethod
    def load(cls, raw: bytes) -> WordBpe:
        key = hashlib.sha256(raw).hexdigest()
        if key not in cls.loaded:
            cls.loaded[key] = cls(raw)
        return cls.loaded[key]

    def word(self, word: str) -> list[int]:
        """Ids of one word: queue of merge ranks over a linked symbol list."""
        data = word.encode("utf-8")
        ids = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        n, get = len(ids), self.merges.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(m[0], i, m[1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1])))]
        heapify(queue)
        while queue:
            _, i, merged = heappop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0:
                continue
            m = get((ids[i], ids[j]))
            if m is None or m[1] != merged:  # stale: the pair here has changed
                continue
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if m := get((merged, ids[k])):
                    heappush(queue, (m[0], i, m[1]))
            p = before[i]
            if p >= 0 and (m := get((ids[p], merged))):
                heappush(queue, (m[0], p, m[1]))
        return [x for x in ids if x >= 0]

    def _slots(self, hashes: np.ndarray, spell) -> np.ndarray:
        """Places in ``known`` of sorted distinct hashes; ``spell(k)`` gives the
        word of the kth, asked for when it is met first."""
        if len(self.known) > MAX_WORDS or len(self.flat) > MAX_IDS:
            self.forget()
        at = np.searchsorted(self.known, hashes)
        new = np.flatnonzero(self.known[np.minimum(at, len(self.known) - 1)] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            ids = self.words([spell(k) for k in new.tolist()])
            count = np.array([len(x) for x in ids])
            first = len(self.flat) + np.cumsum(count) - count
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), dtype="<u4", count=int(count.sum()))])
            where = at[new]
            self.known = np.insert(self.known, where, hashes[new])
            self.first, self.count = np.insert(self.first, where, first), np.insert(self.count, where, count)
            at = np.searchsorted(self.known, hashes)
        return at

    def words(self, words: list[str]) -> list[list[int]]:
        return [self.word(w) for w in words]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without added tokens: every distinct word of the chunk
        is looked up once, then all ids are gathered together."""
        ready = [t.lower() if t.isascii() else unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t in texts]
        joined = "\n".join(ready)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kind = self.kinds[codes]
        at, size, h = runs(codes, kind != SPACES, word_starts(codes, kind))
        if not len(at):
            return [np.empty(0, dtype="<u4")] * len(texts)
        distinct, sample, which = np.unique(h, return_index=True, return_inverse=True)
        slots = self._slots(distinct, lambda k: joined[at[sample[k]]: at[sample[k]] + size[sample[k]]])[which]
        count = self.count[slots]
        ends = np.cumsum(count)
        ids = self.flat[np.repeat(self.first[slots] - (ends - count), count) + np.arange(ends[-1])]
        begins = np.cumsum([0, *(len(t) + 1 for t in ready)])
        cuts = np.concatenate([[0], ends])[np.searchsorted(at, begins)]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, little-endian unsigned 32-bit."""
        parts, owner = [], []  # runs of plain text or added tokens, and whose they are
        for k, text in enumerate(texts):
            found = self.split.split(text) if text and self.split and self.split.search(text) else [text or ""]
            parts += found
            owner += [k] * len(found)
        ids: list[np.ndarray] = []
        for a, b in chunks(parts):
            ids += self._plain(["" if p in self.added else p for p in parts[a:b]])
        if len(parts) == len(texts):
            return ids
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for k, part, x in zip(owner, parts, ids, strict=True):
            out[k].append(np.array([self.added[part]], dtype="<u4") if part in self.added else x)
        return [np.concatenate(x) for x in out]

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


def tokenizer_bytes(path: str) -> bytes:
    """The tokenizer file, read once on the driver; its size is bounded."""
    with open(path, "rb") as f:
        raw = f.read()
    if len(raw) > MAX_FILE_MB << 20:
        raise ValueError(f"{path}: over {MAX_FILE_MB} MB")
    return raw


def list_array(parts: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    values = np.concatenate(parts) if parts else np.empty(0, dtype="<u4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (array<int>) and the decoded text.

    No shuffle; each task keeps one batch and a bounded number of words met."""
    spark = prepare(docs.sparkSession)
    raw = spark.sparkContext.broadcast(tokenizer_bytes(tokenizer))

    def run(batches):
        bpe = WordBpe.load(raw.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = bpe.encode_all(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), list_array(ids), pa.array([bpe.decode(x) for x in ids], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
