"""Pareto order sampling against the contract written out plainly."""

import collections

import pytest
from pyspark.sql import functions as F

from tidewater.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, `rank.x` int, own int"


def text(n):
    return " \t".join(f"w{k}" for k in range(n))


def plain_targets(sizes, weights=(5, 2, 1), total=1.5, cap=2):
    """Shares by weight; what is over ``cap`` is shared again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, rest, still = dict.fromkeys(names, 0.0), total * sum(sizes.values()), set(names)
    while rest > 1e-9 and still:
        per = rest / sum(w[s] for s in still)
        for s in still:
            target[s] += per * w[s]
        rest = sum(max(0.0, target[s] - cap * sizes[s]) for s in names)
        for s in names:
            if target[s] >= cap * sizes[s]:
                target[s] = float(cap * sizes[s])
                still.discard(s)
    return target


@pytest.fixture(scope="module")
def rows():
    out = [(k, text(1 + k * 7 % 90), ("b", "a", None, "", "z", "Ä")[min(k % 13, 5)], "x", 1, k % 4) for k in range(900)]
    out += [(k, text(5), "hot", "x", 1, None) for k in range(2000, 2600)]
    out += [(7, text(40), "same", "x", 1, 2)] * 50 + [(None, text(3), "same", "x", 1, 2)] * 9
    out += [(9000, text(50_000), "long", "x", 1, 1), (9001, text(10), "long", "x", 1, 1), (9002, None, "long", "x", 1, 1), (9003, "", "nothing", "x", 1, 1)]
    return out


def check(got, rows, **how):
    sizes = collections.Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    target = plain_targets(sizes, **how)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= how.get("cap", 2) * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.51, s
    assert collections.Counter((r.doc_id, r.source, r.size) for r in got) == collections.Counter((r[0], r[2], len((r[1] or "").split())) for r in rows)


def test_sources_meet_their_targets(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df.repartition(5)).collect()
    check(got, rows)
    again = mixing.digest(mixing.mix(df.repartition(3, "own"))).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, mixing.digest(spark.createDataFrame(got)).collect()), key=repr)
    # whole copies but for one document at the border of each source
    cut = collections.Counter(r.source for r in got if r.size and r.taken % r.size)
    assert all(n == 1 for n in cut.values())


def test_other_shares(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    check(mixing.mix(df, weights=(1.0, 9.0), total=0.4, cap=1.0).collect(), rows, weights=(1, 9), total=0.4, cap=1)


def test_buckets_change_nothing(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA)
    want = collections.Counter(map(tuple, mixing.mix(df).collect()))
    for n in (1, 7):
        monkeypatch.setattr(mixing, "BUCKETS", n)
        assert collections.Counter(map(tuple, mixing.mix(df).collect())) == want


def test_ranks_follow_the_odds(spark):
    """Among equal documents those of greater weight are taken about as often
    as their inclusion probability says."""
    df = spark.range(6000).selectExpr("id as doc_id", "concat('t ', id) as text", "'s' as source", "1 + id % 3 as pref")
    got = mixing.mix(df, total=0.3, weight_col="pref").join(df.select("doc_id", "pref"), "doc_id")
    share = {r.pref: r.x for r in got.groupBy("pref").agg((F.sum("taken") / F.sum("size")).alias("x")).collect()}
    for pref, x in share.items():
        assert x == pytest.approx(0.3 * pref / 2, abs=0.05)


def test_the_mix_itself(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = mixing.mix(df)
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    words = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).collect()}
    assert words == {r.source: r.n for r in found.groupBy("source").agg(F.sum("taken").alias("n")).where("n > 0").collect()}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).collect() == [] and mixing.mixed_rows(empty).collect() == []
    none = spark.createDataFrame([(1, None, None, "", 0, 0), (2, "", "a", "", 0, 0)], SCHEMA)
    assert {(r.doc_id, r.target, r.taken) for r in mixing.mix(none).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_native(spark, rows):
    plan = mixing.mix(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
