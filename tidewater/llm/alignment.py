"""Aligning the tokens of two tokenizers over the same bytes.

Tokenizer A is a byte-level BPE file, B a piece model with byte fallback that
puts a space before the text; A encodes space + text.  Where tokens of both end
at the same byte a group ends; an A and a B token whose byte ranges overlap are
linked.  A pair of ids counts how many links of the whole corpus hold it.

1. Every document is aligned and each task adds up its pairs; these sums are
   written (one row per pair and task, or per ``MOST_LINKS`` links).
2. The distinct pairs are dealt into shards by their B id.  Every shard gets a
   minimal perfect hash (``perfect_hash``) with its keys beside it.  The tasks'
   sums become dense count vectors indexed by the hash, and vectors are added up
   in a tree, ``FAN_IN`` at a time.  A shard holds all pairs of its B ids, so it
   also knows which pairs have their B id's highest count.
3. Every document is aligned again and looks its pairs up: by hash, then by
   comparing the key.  The shards are broadcast while they hold at most
   ``broadcast_pairs`` pairs (17 bytes each and the hash); beyond it documents
   and shards meet in a join by pair.

Texts are cut where neither tokenizer joins what is left and right: before a
blank that follows a non-blank, but not before blanks that stand inside a piece
of B's vocabulary.  Both tokenizers end a token there, so groups and links do
not cross, and a task aligns a stretch it has met before only once.  Stretches
are encoded by the libraries themselves.

Null and empty texts, and those whose tokens' bytes are not space + text, have
no tokens: zeros and an empty digest; their links count nowhere.  Rows are
handled one by one, repeated rows give repeated results and count each.  An
empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import SPACE, byte_symbols, tokenizer_bytes
from .common import chunks, column, prepare, stored
from .perfect_hash import PerfectHash

BROADCAST_PAIRS = 4_000_000
SHARD_PAIRS = 1 << 18  # pairs in a shard, about
VECTOR_ROWS = 1 << 20  # task sums that go into one dense vector, about
FAN_IN = 16
MOST_PIECES, MOST_LINKS = 600_000, 4_000_000  # a task forgets its stretches beyond these
SLICE = 1 << 20  # characters cut at a time
BLOCK = 1000  # stretches encoded as one text
B_ID = np.uint64(0xFFFFFFFF)
OLD = "\u0250"  # Latin letters before this one are in every edition of Unicode
# --- fixed values: where A's byte level splits a text ----------------------
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- end fixed values -----------------------------------------------------
FIELDS = ("n_a", "n_b", "n_groups", "n_links", "bad")


def decoded_entries(vocab: dict[str, int]) -> list[bytes]:
    """Bytes of every byte-level vocabulary entry, by id."""
    code = {s: b for b, s in enumerate(byte_symbols())}
    out = [b""] * (1 + max(vocab.values()))
    for entry, i in vocab.items():
        out[i] = bytes(code[c] for c in entry) if all(c in code for c in entry) else entry.encode()
    return out


class Pieces(dict):
    """Stretches met → their numbers; new ones are numbered as they come and
    wait in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Aligner:
    """Both tokenizers, and what is known of the stretches met so far: per
    stretch the FIELDS and its group string, and the pair keys of all links in
    one row, each with the number of its stretch."""

    loaded: dict[str, Aligner] = {}

    def __init__(self, a_file: bytes, b_file: bytes, spell: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.spell = spell
        self.a = Tokenizer.from_buffer(a_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = decoded_entries(vocab)
        # the same merges as ranks, for stretches of old letters only: the two
        # libraries may know different editions of the newer ones
        added = {t["content"] for t in json.loads(a_file)["added_tokens"]}
        self.quick = tiktoken.Encoding("a", pat_str=SPLIT, special_tokens={}, mergeable_ranks={self.a_bytes[i]: i for s, i in vocab.items() if s not in added}).encode_ordinary
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        byte = [self.b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(pieces, byte)]
        self.space = pieces.index("▁")
        plain = [p for p, b in zip(pieces, byte) if not b and len(p) > 1]
        if any(re.search("[^▁]▁", p) for p in plain):
            raise ValueError("a piece goes on after a space: texts cannot be cut there")
        inside = sorted({c for p in plain for c in p if c != " " and re.match(f"[{SPACE}]", c)})
        glue = "".join(map(re.escape, inside))
        glued = f"(?:[{glue}][{SPACE}]*)?" if inside else ""
        self.find = re.compile(f"[{SPACE}]*(?:[^{SPACE}]+{glued})+|[{SPACE}]+").findall
        bare = f"(?![{glue}])" if inside else ""
        self.border = re.compile(f"(?<=[^{SPACE}]){bare}[{SPACE}]")
        self.open_end = re.compile(f"[{SPACE}]\\Z").search
        self.a_len, self.b_len = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        # strings of ids with what can follow them; A's, then B's
        names = [f"{i}{sep}" for ids, seps in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for sep in seps for i in range(len(ids))]
        self.names = np.array(names, dtype=object)
        self.forget()

    @classmethod
    def load(cls, a_file: bytes, b_file: bytes, spell: bool = True) -> Aligner:
        key = hashlib.sha256(a_file).hexdigest() + hashlib.sha256(b_file).hexdigest() + str(spell)
        if key not in cls.loaded:
            cls.loaded[key] = cls(a_file, b_file, spell)
        cls.loaded[key].forget()
        return cls.loaded[key]

    def forget(self):
        self.known = Pieces()
        self.told: list[str] = []
        self.fact = np.empty((0, len(FIELDS)), dtype=np.int64)
        self.keys, self.owner = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

    def full(self) -> bool:
        return len(self.known) > MOST_PIECES or len(self.keys) > MOST_LINKS

    def _encode_a(self, text: str) -> list[int]:
        return self.quick(text) if text.isascii() or max(text) < OLD else self.a.encode(text, add_special_tokens=False).ids

    def _encode_b(self, text: str) -> list[int]:
        """Ids within a text: the model puts a space before what it encodes,
        which stands for the stretch's own first space."""
        if text[0] == " ":
            return self.b.encode(text[1:]) if len(text) > 1 else [self.space]
        ids = self.b.encode(text)
        if ids[0] != self.space:
            raise ValueError(f"no space of its own before {text[:20]!r}")
        return ids[1:]

    def _encode(self, new: list[str]) -> tuple[list[list[int]], list[list[int]], list[list[int]], list[int]]:
        """Ids of A and of B of blocks of stretches, the stretches in each
        block, and those whose bytes do not come back (they are in no block).

        A block is encoded as one text; it is cut at the stretches' borders, so
        it has the ids that its stretches have.  A stretch that ends in a blank
        (the end of a text) is a block of its own."""
        old, rest, alone = [], [], []
        for k, p in enumerate(new):
            (alone if self.open_end(p) else old if p.isascii() or max(p) < OLD else rest).append(k)
        blocks = [part[i:i + BLOCK] for part in (old, rest) for i in range(0, len(part), BLOCK)] + [[k] for k in alone]
        a_ids, b_ids, members, bad = [], [], [], []
        while blocks:
            block = blocks.pop()
            text = "".join([new[k] for k in block])
            a, b, raw = self._encode_a(text), self._encode_b(text), text.encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b)):
                a_ids.append(a)
                b_ids.append(b)
                members.append(block)
            elif len(block) > 1:  # find those that differ
                half = len(block) // 2
                blocks += [block[:half], block[half:]]
            else:
                bad += block
        return a_ids, b_ids, members, bad

    def _learn(self):
        """Align the new stretches, all in one go."""
        new, first = self.known.new, len(self.fact)
        if not new:
            return
        self.known.new = []
        a_ids, b_ids, members, bad = self._encode(new)
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=sum(map(len, ids))) for ids in (a_ids, b_ids))
        order = np.fromiter(chain.from_iterable(members), dtype=np.int64, count=len(new) - len(bad))
        size = np.cumsum([len(new[k].encode()) for k in order.tolist()], dtype=np.int64)  # where each ends, in bytes
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        both = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        twice = np.zeros(len(both), dtype=bool)
        twice[1:] = both[1:] == both[:-1]
        ends, common = both[~twice], both[twice]
        if len(size) and not (len(common) and np.array_equal(common[np.searchsorted(common, size)], size)):
            raise ValueError("a token reaches over the border of a stretch")
        keys = (a[np.searchsorted(a_end, ends)].astype(np.uint64) << np.uint64(32)) | b[np.searchsorted(b_end, ends)].astype(np.uint64)
        at = [np.searchsorted(x, size, "right") for x in (a_end, b_end, common, ends)]
        fact = np.zeros((len(new), len(FIELDS)), dtype=np.int64)
        fact[order, :4] = np.stack([np.diff(x, prepend=0) for x in at], axis=1)
        fact[bad, 4] = 1
        self.fact = np.concatenate([self.fact, fact])
        self.keys = np.concatenate([self.keys, keys])
        self.owner = np.concatenate([self.owner, first + np.repeat(order, fact[order, 3])])
        if self.spell:
            self._spell(a, b, np.searchsorted(common, a_end), np.searchsorted(common, b_end), order, (at[0] + at[1]).tolist(), len(new))

    def _spell(self, a, b, a_group, b_group, order, token_at, n_new):
        """Group strings: A's ids, then B's, group by group."""
        n, m = len(self.a_bytes), len(self.b_bytes)
        which = np.empty(len(a) + len(b), dtype=np.int64)
        a_place = np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")
        b_place = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
        which[a_place] = a + n * (np.append(a_group[1:], -1) != a_group)
        which[b_place] = 2 * n + b + m * (np.append(b_group[1:], -1) != b_group)
        words, told, begin = self.names[which].tolist(), [""] * n_new, 0
        for k, end in zip(order.tolist(), token_at):
            told[k] = "".join(words[begin:end])[:-1]
            begin = end
        self.told += told

    def slots(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the stretches of all texts, and where each text's begin
        (one more entry than texts)."""
        out, begins, number = [], [0], self.known.__getitem__
        for text in texts:
            n, at, whole = 0, 0, " " + text
            while text and at < len(whole):
                cut = self.border.search(whole, at + SLICE)
                end = cut.start() if cut else len(whole)
                pieces = self.find(whole, at, end)
                out.append(np.fromiter(map(number, pieces), dtype=np.int32, count=len(pieces)))
                n, at = n + len(pieces), end
            begins.append(begins[-1] + n)
        self._learn()
        return np.concatenate(out) if out else np.empty(0, np.int32), np.array(begins)


def sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` between the begins."""
    total = np.concatenate([np.zeros((1, values.shape[1]), dtype=np.int64), np.cumsum(values, axis=0)])
    return total[begins[1:]] - total[begins[:-1]]


def _batch(keys: np.ndarray, counts: np.ndarray, rows: int = 1 << 18):
    for at in range(0, len(keys), rows):
        yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + rows].astype(np.int64)), pa.array(counts[at:at + rows])], names=["key", "n"])


def pair_sums(rows: DataFrame, a_file: Broadcast, b_file: Broadcast) -> DataFrame:
    """(key, n): links of a pair of ids within a task, or a part of one."""

    def run(batches):
        al = Aligner.load(a_file.value, b_file.value, spell=False)
        met = np.zeros(0, dtype=np.int64)

        def told():
            n = met[al.owner]
            yield from _batch(*added(al.keys[n > 0], n[n > 0]))

        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in chunks(texts):
                slots, begins = al.slots(texts[i:j])
                bad = sums(al.fact[slots][:, 4:], begins)[:, 0] > 0
                n = np.bincount(slots[np.repeat(~bad, np.diff(begins))], minlength=len(al.known))
                n[:len(met)] += met
                met = n
                if al.full():
                    yield from told()
                    al.forget()
                    met = np.zeros(0, dtype=np.int64)
        yield from told()

    return rows.mapInArrow(run, "key long, n long")


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def shard_of(shards: int):
    return F.pmod(F.col("key").bitwiseAND(F.lit(int(B_ID))), F.lit(shards)).cast("int").alias("shard")


def _functions(table: pa.Table) -> pa.Table:
    """One shard's keys → its perfect hash and the keys in that order."""
    keys = np.unique(table.column("key").to_numpy().astype(np.uint64))
    phf = PerfectHash.build(keys)
    placed = np.empty(len(keys), dtype="<u8")
    placed[phf.numbers(keys)] = keys
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "pairs": pa.array([len(keys)], pa.int64()),
                     "hash": pa.array([phf.dumps()], pa.binary()), "keys": pa.array([placed.tobytes()], pa.binary())})


def _dense(left: pa.Table, right: pa.Table) -> pa.Table:
    """Task sums of one shard and branch → a dense count vector."""
    phf = PerfectHash.loads(right.column("hash")[0].as_py())
    vector = np.zeros(phf.n, dtype="<i8")
    np.add.at(vector, phf.numbers(left.column("key").to_numpy().astype(np.uint64)), left.column("n").to_numpy())
    return pa.table({"shard": pa.array([right.column("shard")[0].as_py()], pa.int32()),
                     "branch": pa.array([right.column("branch")[0].as_py()], pa.int32()),
                     "vector": pa.array([vector.tobytes()], pa.binary())})


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), dtype="<i8") for v in table.column("vector"))
    return pa.table({"shard": table.column("shard").slice(0, 1), "branch": table.column("branch").slice(0, 1),
                     "vector": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def best_pairs(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """True for the pairs with the highest count of their B id."""
    b = keys & B_ID
    ids, which = np.unique(b, return_inverse=True)
    top = np.zeros(len(ids), dtype=np.int64)
    np.maximum.at(top, which, counts)
    return counts == top[which]


def _finished(table: pa.Table) -> pa.Table:
    keys = np.frombuffer(table.column("keys")[0].as_py(), dtype="<u8")
    counts = np.frombuffer(table.column("vector")[0].as_py(), dtype="<i8")
    return table.drop_columns(["vector"]).append_column("counts", pa.array([counts.tobytes()], pa.binary())).append_column(
        "best", pa.array([best_pairs(keys, counts).tobytes()], pa.binary()))


def count_shards(tasks: DataFrame) -> tuple[DataFrame, int, int]:
    """Shards (shard, pairs, hash, keys, counts, best) of the summed counts, the
    number they are dealt by and the number of distinct pairs, from the stored
    sums of the tasks."""
    distinct = stored(tasks.select("key").distinct(), "align-pairs")
    pairs = distinct.count()
    shards = max(1, -(-pairs // SHARD_PAIRS))
    functions = stored(distinct.select("key", shard_of(shards)).groupBy("shard").applyInArrow(
        _functions, "shard int, pairs long, hash binary, keys binary"), "align-functions")
    branches = max(1, -(-tasks.count() // (shards * VECTOR_ROWS)))
    salted = tasks.select("key", "n", shard_of(shards), F.pmod(F.xxhash64("key", "n"), F.lit(branches)).cast("int").alias("branch"))
    held = functions.select("shard", "hash", F.explode(F.sequence(F.lit(0), F.lit(branches - 1))).alias("branch"))
    layout = "shard int, branch int, vector binary"
    vectors = stored(salted.groupBy("shard", "branch").cogroup(held.groupBy("shard", "branch")).applyInArrow(_dense, layout), "align-vectors")
    while branches > 1:
        branches = -(-branches // FAN_IN)
        above = vectors.withColumn("branch", F.expr(f"branch div {FAN_IN}").cast("int"))
        vectors = stored(above.groupBy("shard", "branch").applyInArrow(_added, layout), "align-vectors")
    done = functions.join(vectors.drop("branch"), "shard").select("shard", "pairs", "hash", "keys", "vector")
    return stored(done.groupBy("shard").applyInArrow(
        _finished, "shard int, pairs long, hash binary, keys binary, counts binary, best binary"), "align-shards"), shards, pairs


class PairCounts:
    """The shards in memory: counts and best flags by perfect hash."""

    def __init__(self, modulus: int, rows: list):
        self.modulus = modulus
        self.shards = {r[0]: (PerfectHash.loads(r[1]), np.frombuffer(r[2], "<u8"), np.frombuffer(r[3], "<i8"), np.frombuffer(r[4], "?")) for r in rows}

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """(count, best, absent) of each key."""
        out = np.zeros((len(keys), 3), dtype=np.int64)
        out[:, 2] = 1
        shard = ((keys & B_ID) % np.uint64(self.modulus)).astype(np.int64)
        for s in np.unique(shard).tolist():
            if s in self.shards:
                own = np.flatnonzero(shard == s)
                phf, held, counts, best = self.shards[s]
                number = phf.numbers(keys[own])
                there = (number >= 0) & (held[number] == keys[own])
                own, number = own[there], number[there]
                out[own, 0], out[own, 1], out[own, 2] = counts[number], best[number], 0
        return out


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long"


def _documents(rows: DataFrame, a_file: Broadcast, b_file: Broadcast, shared: Broadcast | None, with_groups: bool) -> DataFrame:
    """Second pass.  With ``shared`` shards also n_best and count_sum, else the
    distinct pairs of each row with their number of links."""

    def run(batches):
        al = Aligner.load(a_file.value, b_file.value)
        counts = None if shared is None else PairCounts(*shared.value)
        scores = np.zeros((0, 3), dtype=np.int64)  # count, best and absent, summed over a stretch's links
        for b in batches:
            ids, texts = b.column(0), [t or "" for t in b.column(1).to_pylist()]
            for i, j in chunks(texts):
                slots, begins = al.slots(texts[i:j])
                found = sums(al.fact[slots], begins)
                good = found[:, 4] == 0
                found *= good[:, None]
                groups = [";".join(map(al.told.__getitem__, slots[x:y].tolist())) if ok and y > x else "" for x, y, ok in zip(begins[:-1], begins[1:], good)]
                cols = [ids.slice(i, j - i), *(pa.array(found[:, k]) for k in range(4)),
                        pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups], pa.string())]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
                if with_groups:
                    cols, names = [*cols, pa.array(groups, pa.large_string())], [*names, "groups"]
                if counts is not None:
                    scores = _scores(counts, al, scores)
                    total = sums(scores[slots], begins) * good[:, None]
                    if total[:, 2].any():
                        raise RuntimeError("a pair of a counted text has no count")
                    cols, names = [*cols, pa.array(total[:, 1]), pa.array(total[:, 0])], [*names, "n_best", "count_sum"]
                else:
                    pairs = _pairs(al, slots, begins, good)
                    cols, names = [*cols, *(pa.array(x, pa.list_(pa.int64())) for x in pairs)], [*names, "keys", "links"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
                if al.full():
                    al.forget()
                    scores = np.zeros((0, 3), dtype=np.int64)

    schema = DOCUMENT + ", groups_sha256 string" + (", groups string" if with_groups else "")
    schema += ", keys array<long>, links array<long>" if shared is None else ", n_best long, count_sum long"
    return rows.mapInArrow(run, schema)


def _scores(counts: PairCounts, al: Aligner, scores: np.ndarray) -> np.ndarray:
    """(count, best, absent) of every stretch, over its links; ``scores`` holds
    those of the stretches met before.  A stretch that stands only in texts
    without tokens can hold a pair that was not counted; no other text uses
    it."""
    begin = int(scores.shape[0] and al.fact[:len(scores), 3].sum())
    keys, owner = al.keys[begin:], al.owner[begin:]
    if len(scores) == len(al.fact):
        return scores
    more = np.zeros((len(al.fact) - len(scores), 3), dtype=np.int64)
    if len(keys):
        distinct, which = np.unique(keys, return_inverse=True)
        values = counts.look_up(distinct)[which]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        more[owner[first] - len(scores)] = np.add.reduceat(values, first, axis=0)
    return np.concatenate([scores, more])


def _pairs(al: Aligner, slots: np.ndarray, begins: np.ndarray, good: np.ndarray) -> tuple[list, list]:
    """Distinct pair keys of every text and how many links hold each."""
    size = al.fact[:, 3]
    links_of = np.zeros(len(size), dtype=np.int64)  # where a stretch's links begin
    first = np.flatnonzero(np.concatenate([[True], al.owner[1:] != al.owner[:-1]])) if len(al.owner) else []
    links_of[al.owner[first]] = first
    keys, n = [], []
    for x, y, ok in zip(begins[:-1], begins[1:], good):
        own = slots[x:y] if ok else slots[:0]
        count = size[own]
        at = np.repeat(links_of[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        k, c = added(al.keys[at], np.ones(len(at), dtype=np.int64))
        keys.append(k.astype(np.int64))
        n.append(c)
    return keys, n


def align(docs: DataFrame, a_tokenizer: str, b_model: str, id_col: str = "doc_id", text_col: str = "text",
          broadcast_pairs: int = BROADCAST_PAIRS, with_groups: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256; ``with_groups`` adds the groups themselves as text
    (``a1,a2|b1;a3|b2,b3``: decimal ids of A and B in order)."""
    spark = prepare(docs.sparkSession)
    share = spark.sparkContext.broadcast
    a_file, b_file = share(tokenizer_bytes(a_tokenizer)), share(tokenizer_bytes(b_model))
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    shards, modulus, pairs = count_shards(stored(pair_sums(rows, a_file, b_file), "align-sums"))
    told = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else [])]
    if pairs <= broadcast_pairs:
        held = share((modulus, [tuple(map(_plain, r)) for r in shards.select("shard", "hash", "keys", "counts", "best").collect()]))
        return _documents(rows, a_file, b_file, held, with_groups).select(*told)
    found = stored(_documents(rows, a_file, b_file, None, with_groups).withColumn("rid", F.monotonically_increasing_id()), "align-documents")
    links = found.select("rid", F.explode(F.arrays_zip("keys", "links")).alias("x")).select("rid", F.col("x.keys").alias("key"), F.col("x.links").alias("m"))
    scored = (links.join(pair_counts(shards), "key").groupBy("rid")
              .agg(F.sum(F.col("m") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("m") * F.col("n")).alias("count_sum")))
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")}
    return found.join(scored, "rid", "left").select(*(zero.get(c, c) for c in told))


def _plain(value):
    return bytes(value) if isinstance(value, (bytes, bytearray)) else value


def pair_counts(shards: DataFrame) -> DataFrame:
    """(key, n, best): one row per distinct pair, A id in the upper and B id in
    the lower 32 bits."""

    def run(batches):
        for b in batches:
            for keys, counts, best in zip(*(b.column(k).to_pylist() for k in ("keys", "counts", "best"))):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, "<i8")), pa.array(np.frombuffer(counts, "<i8")),
                                                  pa.array(np.frombuffer(best, "?"))], names=["key", "n", "best"])

    return shards.select("keys", "counts", "best").mapInArrow(run, "key long, n long, best boolean")


def pair_table(spark: SparkSession, docs: DataFrame, a_tokenizer: str, b_model: str, text_col: str = "text") -> DataFrame:
    """The corpus's id pairs with their counts: (a_id, b_id, n, best)."""
    prepare(spark)
    share = spark.sparkContext.broadcast
    rows = docs.select(F.lit(None).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    sums_ = stored(pair_sums(rows, share(tokenizer_bytes(a_tokenizer)), share(tokenizer_bytes(b_model))), "align-sums")
    return pair_counts(count_shards(sums_)[0]).select(
        F.shiftright("key", 32).cast("int").alias("a_id"), F.col("key").bitwiseAND(F.lit(int(B_ID))).cast("int").alias("b_id"), "n", "best")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
