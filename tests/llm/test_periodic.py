"""Periodic runs against all starts and periods tried one by one."""

import collections
import hashlib
import random
import zlib

import pytest

from tidewater.llm import periodic


def brute(words):
    n, spans = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                spans.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in spans.items())


def told(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def random_words(rng):
    kind, n = rng.randrange(4), rng.randrange(0, 80)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        unit = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        return [rng.choice("abc") for _ in range(rng.randrange(5))] + (unit * 12)[:n] + [rng.choice("abc") for _ in range(rng.randrange(5))]
    if kind == 2:
        a, b = "a", "ab"  # Fibonacci words hold many runs that overlap
        while len(b) < n:
            a, b = b, b + a
        return list(b[:n])
    out = []
    while len(out) < n:
        out += rng.choice(["a", "b", "ab", "aab", "abcab"]) * rng.randrange(1, 8)
    return out


def test_runs_equal_brute_force():
    rng = random.Random(11)
    texts = [random_words(rng) for _ in range(1500)]
    assert periodic.runs_of(texts) == [brute(t) for t in texts]
    assert sum(map(len, periodic.runs_of(texts))) > 500


TEXTS = [None, "", " \n\t ", "one", "a a a a a a", "a a a a a", "a b a b a b a b c", "é é é é é é\x85é", "x " * 3000, "same words " * 9, "same words " * 9,
         "p q r " * 700 + "z " + "q r p " * 50]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(None if k == 4 else min(k, 10), t, k, "x") for k, t in enumerate(TEXTS)]
    return out + [(1000 + k, " ".join(random_words(rng)), k, None) for k in range(400)]


def test_query_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, `runs` int, `start.x` string").repartition(3)
    got = periodic.digest(periodic.find_runs(df, plant=True)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(told(r[0], r[1]) for r in rows)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = periodic.digest(periodic.find_runs(docs, plant=True)).collect()
    want = [told(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 8000]
    assert set(want) <= set(map(tuple, got)) and len(got) == docs.count()


def test_collapsed_text(spark):
    df = spark.createDataFrame([(1, "go go go go go go on"), (2, "a b\nc")], "doc_id long, text string")
    got = {r.doc_id: (r.collapsed, r.n_dropped, [tuple(x) for x in r.runs]) for r in periodic.find_runs(df, keep_text=True).collect()}
    assert got == {1: ("go on", 5, [(0, 6, 1)]), 2: ("a b c", 0, [])}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.digest(periodic.find_runs(empty, plant=True)).collect() == []


@pytest.mark.parametrize("text", ["a " * 1_000_000, "a b c d e f g " * 150_000, "a x a y " * 250_000, "w" * 3_000_000,
                                  " ".join(f"w{k % 977}" for k in range(700_000)), " ".join("ab"[bin(k).count("1") % 2] for k in range(500_000))])
def test_long_texts(text):
    words = text.encode().split()
    for start, length, q in periodic.runs_of([words])[0]:
        assert length >= max(6, 4 * q)
        assert words[start:start + length - q] == words[start + q:start + length]
        assert start == 0 or words[start - 1] != words[start - 1 + q]
        assert start + length == len(words) or words[start + length] != words[start + length - q]
