"""Alignment of two tokenizers against the libraries on whole texts."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest

from tidewater.llm import alignment
from tidewater.llm.perfect_hash import PerfectHash

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "   ", "\n", " \n\t x", "one", "a  b   c    ", "a\r\nb \r\n c\r", "({\r\n});\r\n\r\n", "x;\r y,\r\rz", "foo\r", "\r",
    "a　b 　 c　　 d", "\xa0a\xa0 b \x85c d", "a\x1cb !\x1c! \x1f", "<|endoftext|> x <s></s> <unk> <0x41>", "a▁b c", "▁",
    "don't we'll I'M 'S ''s ...??!! 12345 1st", "ﬁ ① ²½ é é 你好 世界。नमस्ते दुनिया مرحبا", "﻿a​b\x00c", "😀👩‍👩‍👧 x", "\n\n\nfn main() {\n\treturn  0;\n}\n",
    "same words here", "same words here", "é́ ́x", "A" * 3000, " " * 300 + "x" + "\n" * 50, "ab " * 2000,
]


def brute(texts):
    """Per text: (n_a, n_b, n_groups, n_links, groups, links) by whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    code = {v: k for k, v in _byte_level().items()}
    entry = {i: bytes(code[c] for c in s) if i != 50256 else s.encode() for s, i in a.get_vocab().items()}
    out = []
    for t in texts:
        if not t:
            out.append((0, 0, 0, 0, "", []))
            continue
        raw = (" " + t).encode()
        ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        ba = [entry[i] for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != raw or b"".join(bb) != raw:
            out.append((0, 0, 0, 0, "", []))
            continue
        ends = []
        for parts in (ba, bb):
            at, e = 0, []
            for p in parts:
                e.append((at, at + len(p)))
                at += len(p)
            ends.append(e)
        links, j = [], 0
        for i, (s, e) in enumerate(ends[0]):
            while ends[1][j][1] <= s:
                j += 1
            k = j
            while k < len(ib) and ends[1][k][0] < e:
                links.append((ia[i], ib[k]))
                k += 1
        both = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
        told, x, y = [], 0, 0
        for cut in both:
            ga, gb = [], []
            while x < len(ia) and ends[0][x][1] <= cut:
                ga.append(ia[x])
                x += 1
            while y < len(ib) and ends[1][y][1] <= cut:
                gb.append(ib[y])
                y += 1
            told.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        out.append((len(ia), len(ib), len(both), len(links), ";".join(told), links))
    return out


def _byte_level():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = {b: chr(b) for b in keep}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(free)
            free += 1
    return out


def expected(rows):
    found = brute([t for _, t in rows])
    counts = collections.Counter(x for f in found for x in f[5])
    top = collections.Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return collections.Counter(
        (d, *f[:4], sum(counts[x] == top[x[1]] for x in f[5]), sum(counts[x] for x in f[5]), hashlib.sha256(f[4].encode()).hexdigest() if f[4] else "")
        for (d, _), f in zip(rows, found)), counts


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()
    return [(None if k == 3 else min(k, 20), t) for k, t in enumerate(ODD)] + [(100 + r.doc_id, r.text) for r in docs]


def test_alignment_equals_whole_texts(spark, rows):
    df = spark.createDataFrame([(*r, "x", k) for k, r in enumerate(rows)], "doc_id long, text string, `n_a` string, `keys` int").repartition(3)
    want, counts = expected(rows)
    assert collections.Counter(tuple(r) for r in alignment.digest(alignment.align(df, A, B)).collect()) == want
    groups = {r.groups for r in alignment.align(df, A, B, with_groups=True).collect()}
    assert groups == {f[4] for f in brute([t for _, t in rows])}
    pairs = {(r.a_id, r.b_id): r.n for r in alignment.pair_table(spark, df, A, B).collect()}
    assert pairs == dict(counts)


def test_alignment_without_broadcast_and_with_many_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD_PAIRS", 64)
    monkeypatch.setattr(alignment, "VECTOR_ROWS", 1)
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    some = rows[:len(ODD) + 10]
    df = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
    want, _ = expected(some)
    assert collections.Counter(tuple(r) for r in alignment.digest(alignment.align(df, A, B, broadcast_pairs=0)).collect()) == want
    assert collections.Counter(tuple(r) for r in alignment.digest(alignment.align(df, A, B)).collect()) == want


def test_alignment_forgets_and_cuts(rows, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 5)
    al = alignment.Aligner(open(A, "rb").read(), open(B, "rb").read())
    texts = [t for _, t in rows if t]
    slots, begins = al.slots(texts)
    found = alignment.sums(al.fact[slots], begins)
    for f, x, y, want in zip(found.tolist(), begins[:-1], begins[1:], brute(texts)):
        if f[4]:
            assert want[0] == 0
        else:
            assert tuple(f[:4]) == want[:4]
            assert ";".join(al.told[s] for s in slots[x:y]) == want[4]


def test_quick_ranks_equal_the_merges():
    """Every vocabulary entry, and runs of entries, as both libraries see them."""
    al = alignment.Aligner(open(A, "rb").read(), open(B, "rb").read())
    texts = [b.decode("utf-8", "ignore") for b in al.a_bytes]
    texts = [t for t in texts if t and max(t) < alignment.OLD]
    rng = np.random.default_rng(7)
    for n, size in ((60_000, 2), (30_000, 4)):
        texts += ["".join(texts[k] for k in row) for row in rng.integers(0, 40_000, (n, size))]
    assert [al.quick(t) for t in texts] == [e.ids for e in al.a.encode_batch_fast(texts, add_special_tokens=False)]


def test_empty_table_gives_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.digest(alignment.align(empty, A, B)).collect() == []
    nothing = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in alignment.digest(alignment.align(nothing, A, B)).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_long_texts(spark):
    texts = ["x" * 1_000_000, "word " * 300_000, "\n".join(["a line of text"] * 50_000), " " * 500_000 + "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = alignment.align(df, A, B).collect()
    assert [r.n_links >= max(r.n_a, r.n_b) > 0 for r in got] == [True] * 4


@pytest.mark.parametrize("n", [0, 1, 2, 100, 5000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    phf = PerfectHash.loads(PerfectHash.build(keys).dumps())
    assert sorted(phf.numbers(keys).tolist()) == list(range(len(keys)))
    assert (phf.numbers(rng.integers(0, 2**63, 50).astype(np.uint64)) < max(1, len(keys))).all()
