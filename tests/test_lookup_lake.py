"""Lookup join with TTL cache (J1–J4) and the snapshot ledger (K3, S16–S18, ST4)."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators.lake import LedgerTable
from tidewater.operators.lookup import KeyedCache, ReferenceCache, lookup_join
from tidewater.sources import jdbc

REF = "icao24 string, registration string, aircraft_type string, operator string, country string"


def _stream(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "icao24 string, n int")


def test_defaults_and_duplicates(spark):
    ref = spark.createDataFrame([
        ("a", "R1", "B738", "Op A", "IE"),
        ("b", "R2", "A320", None, "GB"),          # matched, NULL operator
        ("c", "R3", "A320", "Op C", "DE"),
        ("c", "R3b", "A320", "Op C2", "DE"),      # key not enforced
    ], REF)
    out = lookup_join(_stream(spark, ["a", "b", "c", "zz"]), ref)
    rows = sorted((r["icao24"], r["registration"], r["operator"]) for r in out.collect())
    assert rows == [("a", "R1", "Op A"), ("b", "R2", "UNKNOWN"), ("c", "R3", "Op C"),
                    ("c", "R3b", "Op C2"), ("zz", "UNKNOWN", "UNKNOWN")]
    deduped = lookup_join(_stream(spark, ["c"]), ref, dedupe=True)
    assert deduped.count() == 1


def test_broadcast_goes_by_stored_bytes(spark):
    ref = spark.createDataFrame([("a", "R", "T", "O", "C")], REF)
    cache = ReferenceCache(lambda: ref)
    plan = lambda: lookup_join(_stream(spark, ["a"]), cache.get())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "BroadcastHashJoin" not in plan() and lookup_join(_stream(spark, ["a"]), cache.get()).count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    cache.close()


class Store:
    """A reference store that writes down which keys it was asked for."""

    def __init__(self, spark, rows):
        self.spark, self.rows, self.asked = spark, rows, []

    def load(self, keys):
        self.asked.append(sorted(r[0] for r in keys.collect()))
        return self.spark.createDataFrame(self.rows, REF).join(keys, "icao24", "left_semi")


def test_keyed_cache_asks_only_for_absent_and_expired_keys(spark):
    store = Store(spark, [("a", "R1", "T", "Op A", "IE"), ("b", "R2", "T", "Op B", "GB"), ("b", "R2b", "T", "Op B", "GB"), ("c", "R3", "T", "Op C", "DE")])
    now = [0.0]
    cache = KeyedCache(store.load, ttl_seconds=30, clock=lambda: now[0])

    def enriched(*keys):
        rows = _stream(spark, keys)
        return sorted((r["icao24"], r["registration"]) for r in lookup_join(rows, cache.lookup(rows)).collect())

    assert enriched("a", "a", "zz") == [("a", "R1"), ("a", "R1"), ("zz", "UNKNOWN")]
    rows = _stream(spark, ["a", None])
    assert {r["registration"] for r in lookup_join(rows, cache.lookup(rows)).collect()} == {"R1", "UNKNOWN"}
    assert store.asked == [["a", "zz"]]
    now[0] = 10.0
    assert enriched("a", "zz") == [("a", "R1"), ("zz", "UNKNOWN")]      # inside the TTL: nothing is asked
    assert store.asked == [["a", "zz"]]
    assert enriched("a", "b") == [("a", "R1"), ("b", "R2"), ("b", "R2b")]  # only the absent key
    assert store.asked[1:] == [["b"]]
    store.rows = [("a", "NEW", "T", "Op A", "IE"), ("b", "NEW", "T", "Op B", "GB")]
    now[0] = 30.0                                                        # a and zz have expired, b has not
    assert enriched("a", "b", "zz") == [("a", "NEW"), ("b", "R2"), ("b", "R2b"), ("zz", "UNKNOWN")]
    assert store.asked[2:] == [["a", "zz"]] and cache.asked == 5
    # only the last version is kept
    from tidewater.operators.lake import path_exists
    folder = cache._versions.folder
    assert [k for k in range(1, 9) if path_exists(spark, f"{folder}/version={k}")] == [cache._versions.number]
    cache.close()
    assert not path_exists(spark, folder)


def test_keyed_cache_carries_at_most_max_rows(spark):
    store = Store(spark, [(k, k, k, k, k) for k in "abcdef"])
    now = [0.0]
    cache = KeyedCache(store.load, ttl_seconds=100, max_rows=2, clock=lambda: now[0])
    for at, keys in ((0.0, "ab"), (1.0, "cd"), (2.0, "e")):
        now[0] = at
        rows = _stream(spark, list(keys))
        assert {r["registration"] for r in lookup_join(rows, cache.lookup(rows)).collect()} == set(keys)
    now[0] = 3.0
    rows = _stream(spark, ["c", "d", "e", "a"])
    assert {r["registration"] for r in lookup_join(rows, cache.lookup(rows)).collect()} == set("acde")
    assert store.asked[:3] == [["a", "b"], ["c", "d"], ["e"]] and "a" in store.asked[3] and "e" not in store.asked[3]


def test_keyed_loader_sends_in_lists_and_has_a_way_for_many_keys(spark):
    ref = spark.createDataFrame([(k, k, k, k, k) for k in ("a", "b", "it's")], REF)
    sent, whole = [], []

    def read(predicates):
        sent.append(predicates)
        return ref.where(" OR ".join(p.replace("'it''s'", '"it\'s"') for p in predicates))

    load = jdbc.keyed_loader(read, lambda: whole.append(1) or ref, "icao24", slice_keys=2, most_keys=3)
    keys = spark.createDataFrame([("b",), ("a",), ("it's",)], "icao24 string")
    assert sorted(r[0] for r in load(keys).collect()) == ["a", "b", "it's"]
    assert sent == [["icao24 IN ('a', 'b')", "icao24 IN ('it''s')"]] and not whole
    many = spark.createDataFrame([("a",), ("b",), ("x",), ("y",)], "icao24 string")
    assert sorted(r[0] for r in load(many).collect()) == ["a", "b"] and len(whole) == 1 and len(sent) == 1
    assert load(keys.limit(0)).count() == 0
    assert jdbc.in_lists("k", [3, 1, 2], 2) == ["k IN (1, 2)", "k IN (3)"]


def test_ttl_cache_sees_change_only_after_ttl(spark, tmp_path):
    path = str(tmp_path / "ref")
    spark.createDataFrame([("3f7062", "EI-DWA", "B738", "Ryanair", "IE")], REF).write.parquet(path)
    now = [0.0]
    cache = ReferenceCache(lambda: spark.read.parquet(path), ttl_seconds=30, clock=lambda: now[0])
    first = cache.get()
    assert first.first()["operator"] == "Ryanair"
    spark.createDataFrame([("3f7062", "EI-DWA", "B738", "Changed", "IE")], REF).write.mode(
        "overwrite").parquet(path)
    now[0] = 29.0
    stale = cache.get()
    assert stale.first()["operator"] == "Ryanair" and cache.refreshes == 1
    now[0] = 30.0
    old = cache._versions.path
    fresh = cache.get()
    assert fresh.first()["operator"] == "Changed" and cache.refreshes == 2 and fresh.count() == 1
    from tidewater.operators.lake import path_exists
    assert not path_exists(spark, old)             # the older version is removed
    cache.close()


def _clock(start):
    t = [start]

    def tick():
        t[0] += dt.timedelta(seconds=10)
        return t[0]
    return tick


def test_ledger_time_travel_and_replay(spark, tmp_path):
    lake = LedgerTable(spark, str(tmp_path / "lake"), ["pos_date"], clock=_clock(dt.datetime(2026, 1, 1)))
    a = spark.createDataFrame([("x", 1, "2026-06-22"), ("y", 2, "2026-06-22")], "k string, v int, pos_date string")
    b = spark.createDataFrame([("z", 3, "2026-06-23")], "k string, v int, pos_date string")
    assert lake.read().count() == 0
    assert lake.append(a, "s1") == 2
    assert lake.append(b, "s2") == 1
    assert lake.append(a, "s1") == 0               # replayed batch id: skipped
    assert lake.read().count() == 3
    commits = {r["snapshot_id"]: r["committed_at"] for r in lake.commits().collect()}
    assert lake.read(as_of=commits["s1"] - dt.timedelta(seconds=1)).count() == 0
    assert lake.read(as_of=commits["s1"]).count() == 2
    assert lake.read(as_of=commits["s2"] + dt.timedelta(days=1)).count() == 3
    hist = [(r["snapshot_id"], r["sequence_number"], r["added_rows"]) for r in
            lake.snapshots().orderBy("sequence_number").collect()]
    assert hist == [("s1", 1, 2), ("s2", 2, 1)]


def test_uncommitted_data_is_invisible(spark, tmp_path):
    lake = LedgerTable(spark, str(tmp_path / "lake"), ["pos_date"])
    a = spark.createDataFrame([("x", 1, "2026-06-22")], "k string, v int, pos_date string")
    lake.append(a, "s1")
    # data folder of a snapshot whose commit never happened
    a.withColumn("snapshot_id", F.lit("s9")).write.mode("append").partitionBy(
        "snapshot_id", "pos_date").parquet(lake.data_path)
    assert lake.read().count() == 1
    plan = lake.read().where(F.col("pos_date") == "2026-06-22")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "pos_date" in plan


def test_overwrite_starts_a_new_version(spark, tmp_path):
    t = LedgerTable(spark, str(tmp_path / "ref"))
    t.overwrite(spark.createDataFrame([("a", "old")], "k string, op string"), "v1")
    t.overwrite(spark.createDataFrame([("a", "new")], "k string, op string"), "v2")
    assert [r["op"] for r in t.read().collect()] == ["new"]
    assert [r["op"] for r in t.read(snapshot_id="v1").collect()] == ["old"]
