"""Chat, top-k, pages and the pipeline against brute force, and on odd rows."""

import collections
import hashlib
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import chat, page_text, packing, queries, topk

SF = "/root/testdata/sf0.001"
NEEDS = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
TABLES = ["documents", "embeddings", "pages", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@NEEDS
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, con, name):
    from tools.oracle_check import _rows

    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()], False) == _rows(columns, cur.fetchall(), False)


def test_chat_round_trip(spark):
    marks = [chat.START, chat.SEP, chat.END, "<\\|", "<\\\\|im_end|>", "<", "|", "\\", "<|", "<|other|>", "\n", "é"]
    rng = np.random.default_rng(1)
    rows = [(c, t, str(rng.choice(["user", "assistant", "a<|im_sep|>b", "<", "\\"])), "".join(rng.choice(marks, rng.integers(0, 6))), "x")
            for c in range(30) for t in range(c % 7 + 1)]
    rows += [(None, 1, None, None, "x"), (50, None, "assistant", "no turn", "x"), (50, 1, "assistant", "again", "x"), (50, 1, "assistant", "again", "x")]
    out = {r.conv_id: r for r in chat.digest(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string"))).collect()}
    groups = collections.defaultdict(list)
    for c, t, role, text, _ in rows:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    for c, turns in groups.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        r = out.pop(c)
        assert r.round_trip and r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert not out
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_escapes_only_what_conflicts(spark):
    rows = [(1, 0, "user", "plain <b> | text"), (1, 1, "assistant", "has <|im_end|> inside")]
    r = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert r.n_escaped == 1 and "plain <b> | text" in r.formatted and "<\\|im_end|> inside" in r.formatted
    assert "".join(s.text for s in r.segments) == r.formatted


def brute_topk(vectors, k):
    ints = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in vectors}
    out = []
    for q, x in ints.items():
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in ints.items() if i != q and len(y) == len(x))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = np.random.default_rng(6)
    vectors = [(k, rng.normal(size=8).astype(np.float32).tolist()) for k in range(400)]
    vectors += [(k, vectors[3][1]) for k in range(400, 420)]  # ties
    vectors += [(k, [0.0] * 8) for k in range(420, 430)] + [(450, [1.0, 2.0]), (451, [3.0, -1.0])]
    bad = [(1000, None), (1050, [None] + [0.5] * 7), (1100, [float("nan")] * 8), (1150, [float("inf")] + [0.0] * 7), (None, [0.1] * 8)]
    df = spark.createDataFrame(vectors + bad + vectors[:30], "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(3)
    got = sorted(tuple(r) for r in topk.topk(df, F.col("vec_id") % 50 == 0, 5).collect())
    assert got == brute_topk(vectors, 5)
    assert topk.topk(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_threshold_stops_early():
    rng = np.random.default_rng(7)
    vecs = rng.integers(-5, 6, (4000, 4))
    vecs[:20] = 1000  # far above the rest in every list
    found = topk.threshold_topk(np.arange(4000), vecs, np.array([-1]), np.array([[3, 2, 1, 4]]), 5)
    assert [f[1] for f in found] == [0, 1, 2, 3, 4] and found[0][3] < 200  # rows scored, of 4000
    # one row after the other leaves the lead: the walk goes on as long as it must
    steps = np.stack([np.arange(4000), -np.arange(4000)], axis=1)
    for q in ([5, 1], [1, 5], [-1, 1], [0, 0]):
        got = topk.threshold_topk(np.arange(4000), steps, np.array([7]), np.array([q]), 3)
        want = sorted((-int(np.dot(q, v)), i) for i, v in enumerate(steps) if i != 7)[:3]
        assert [(f[1], f[2]) for f in got] == [(i, -x) for x, i in want]
        assert 3 <= got[0][3] <= 4000
    huge = topk.threshold_topk(np.arange(3), np.array([[2**62], [2**61], [-5]]), np.array([9]), np.array([[4]]), 2)
    assert [(f[1], f[2]) for f in huge] == [(0, 2**64), (1, 2**63)]


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="<p>x</p>";</script></head><body>
<header><p>Site name</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-banner"><p>We use cookies, as all do. Accept them, please.</p></div>
<article><h1>A title &amp; more</h1><p>First   paragraph, with <b>bold</b> words.
And a line.<p>Second one<br>after a break.</p><aside><p>See also these other articles, which are many.</p></aside></article>
<section id="comments"><h3>Comments</h3><p>I think, as a reader, that this is good. Really.</p></section>
<form><p>Write to us, please.</p><input></form><div class="ad">Buy now, buy more, buy again.</div><footer>&copy; us</footer></body></html>"""


def test_page_text(spark):
    model = page_text.train()
    assert model.text(PAGE) == "A title & more\nFirst paragraph, with bold words. And a line.\nSecond one\nafter a break."
    rows = [(1, "u", PAGE, 0), (1, "u", PAGE, 0), (2, None, None, 0), (3, "v", "", 0), (None, "w", "<p>broken <b>markup, which goes on and on, as long as it can", 0), (4, "x", "</div><<>&#x41;&bad; <!-- ", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = page_text.digest(page_text.extract(df)).collect()
    assert len(out) == 6 and [r.text for r in out if r.page_id in (2, 3)] == ["", ""]
    assert [r.text for r in out if r.page_id is None] == ["broken markup, which goes on and on, as long as it can"]
    assert all(r.n_chars == len(r.text) for r in out)
    assert page_text.extract(df.limit(0)).count() == 0


def test_marginals_equal_enumeration():
    """Sum-product on a small tree against the sum over all labellings."""
    model = page_text.train()
    page = page_text.Page("<body><div><p>Some words, here.</p><ul><li><a>x</a></li></ul></div><p>y</p></body>")
    n = len(page.nodes)
    odds = page_text.evidence(page) @ model.w
    total, content = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [bits >> k & 1 for k in range(n)]
        log = sum(odds[k] for k in range(n) if y[k])
        log += sum(model.ties[int(x.tag in page_text.LEAVES), y[x.parent], y[k]] for k, x in enumerate(page.nodes) if k)
        total += np.exp(log)
        content += np.exp(log) * np.array(y)
    assert np.allclose(model.marginals(page), content / total)


@NEEDS
def test_pages_held_out(spark):
    """Trained on every other page, the model finds the articles of the rest."""
    pages = duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet' ORDER BY page_id").fetchall()
    model = page_text.train([h for h, in pages[::2]])
    right = 0
    for html, in pages[1::2]:
        page = page_text.Page(html)
        own = page_text.own_labels(page)
        right += model.text(html) == "\n".join(t for k, t in page.blocks if own[k])
    assert right >= 0.98 * len(pages[1::2])


@NEEDS
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at, sizes = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF).cache()
        sizes.append(at.count())
        if name != "packing":
            assert at.columns == docs.columns
    assert sizes[0] > sizes[1] >= sizes[2] >= sizes[3] == sizes[4] > 0
    assert packing.digest(at).select("doc_id").distinct().count() == sizes[4]
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        for some in (odd, odd.limit(0)):
            assert stage(spark, some, SF).count() >= 0


def test_page_text_without_end_tags():
    """End tags of hidden elements that are left out hide no blocks."""
    model = page_text.train()
    told = "It goes on for a while, with commas and full stops, as in a report. "
    want = "\n".join(f"{k} {told.strip()}" for k in (1, 2))
    body = f"<article><p>1 {told}</p><p>2 {told}</p></article>"
    for page in (f"<html><head><title>x</title><body>{body}</body></html>", f"<head><meta charset=utf-8><title>x</title>{body}",
                 f"<html><head><title>x</title></head><body><select><option>a<option>b{body}</body></html>",
                 *(f"<body><{tag}>label{body}</body>" for tag in ("button", "select", "svg", "noscript", "object")),
                 f"<body><article><p>1 {told}</p><button>go<p>2 {told}</p></article><p><button>b</button></p></body>"):
        assert model.text(page) == want, page
    assert [t for _, t in page_text.Page(f"<head><title>x</title>{told}").blocks] == [told.strip()]
    hidden = f"<body>{body}<noscript><p>3 {told}</p></noscript><button><div>4 {told}</div></button></body>"
    assert model.text(hidden) == want


def test_near_duplicates_of_rows_that_share_an_id(spark):
    copy = " ".join(f"w{k}" for k in range(40))
    own = " ".join(f"v{k}" for k in range(40))
    rows = [(1, copy), (7, copy), (7, own), (8, "x " + own), (9, "equal row"), (9, "equal row"), (None, copy)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicate_removal(spark, docs, "").collect()
    assert sorted(((r.doc_id or 0), r.text) for r in got) == sorted([(0, copy), (1, copy), (7, own), (9, "equal row")])


def test_pages_with_broken_markup_are_read_in_time():
    import time
    n = 100_000
    for html in ("<a>x" * n, "<i>" * n + "x</b>" * n, "<div>" * n + "x", "<p>x<i>" * n, "<div>" + "<b>" * n + "<p>x</p>" * n, "<li>x" * n, "<select>" * 2000 + "<p>x" * n, "</p>" * n):
        began = time.time()
        page = page_text.Page(html)
        assert time.time() - began < 60 and len(page.nodes) >= 1
