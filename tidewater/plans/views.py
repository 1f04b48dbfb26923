"""Analog views over the driver tables.

The reference's data is random and clock-based; these views derive the same
record shapes from the given tables so that every query's work grows with
them.  Each view has an equal DuckDB SQL text in ``plans.oracle``.

* positions    ← events      (one aircraft position per event)
* aircraft_ref ← supplier ⋈ nation  (reference table, key s_suppkey)
* weather rows ← events      (one observation per event, station = type)
* products     ← part        (v1 even keys, v2 odd keys)
* lake commits ← orders      (one snapshot per order year)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import configure


_MEMO: dict = {}


def memo(name: str, build):
    """Constant Column lists built once per process (each F.* call is a JVM
    round trip; the same trees serve every query)."""
    if name not in _MEMO:
        _MEMO[name] = build()
    return _MEMO[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Message offsets: one topic partition, offset = event_id (dense from 0).
def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed positions with ``event_id`` kept as the message offset."""
    return table(spark, sf_dir, "events").select(*memo("positions", _position_columns))


def _position_columns():
    ts = F.date_trunc("millisecond", F.col("ts")).cast("timestamp_ntz")
    return [
        F.col("event_id"),
        F.lpad(F.col("user_id").cast("string"), 6, "0").alias("icao24"),
        F.concat(F.lit("EV"), F.col("user_id").cast("string")).alias("callsign"),
        F.round(F.col("value") / 10, 6).alias("latitude"),
        F.round(-F.col("value") / 5, 6).alias("longitude"),
        F.floor(F.col("value") * 80).cast("int").alias("altitude"),
        F.col("value").alias("velocity"),
        (F.col("event_id") % 360).cast("double").alias("heading"),
        (F.col("event_id") % 101 - 50).cast("int").alias("vertical_rate"),
        (F.col("event_type") == "signup").alias("on_ground"),
        F.lpad((F.col("event_id") % 10000).cast("string"), 4, "0").alias("squawk"),
        ts.alias("ts"),
        ts.cast("date").alias("pos_date"),
    ]


# Fault injection, as the producer's --inject-errors: message index 0, N, 2N…
INJECT_EVERY = 5
# Delimited-only fault: a truncated line (11 fields) on offsets 3, 10, 17, …
TRUNCATE_EVERY, TRUNCATE_AT = 7, 3


def is_injected(offset_col: str = "event_id") -> F.Column:
    return F.col(offset_col) % INJECT_EVERY == 0


def is_truncated(offset_col: str = "event_id") -> F.Column:
    return F.col(offset_col) % TRUNCATE_EVERY == TRUNCATE_AT


def aircraft_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference rows keyed like positions; operator NULL for negative balances."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "inner").select(
        F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("icao24"),
        F.concat(F.lit("REG-"), F.col("s_suppkey").cast("string")).alias("registration"),
        F.concat(F.lit("T"), F.col("n_regionkey").cast("string")).alias("aircraft_type"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("operator"),
        F.col("n_name").alias("country"),
    )


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed weather observations plus the message they travel in.

    A message is one CSV document: the rows of one event hour, cut into chunks
    of at most ``WEATHER_CHUNK`` event ids, so no message grows with the data.
    It lands 10 minutes after its last observation, so some chunks land in the
    next hour (the reference's hour-edge case).
    """
    ev = table(spark, sf_dir, "events")
    obs = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    return ev.select(
        F.col("event_id"),
        F.upper(F.substring("event_type", 1, 4)).alias("station_id"),
        obs.alias("observation_ts"),
        ((F.col("event_id") % 500 - 200).cast("decimal(6,0)") / 10).cast("decimal(5,1)").alias("temperature_c"),
        (F.col("user_id") % 60).cast("smallint").alias("wind_speed_kts"),
        ((F.col("event_id") * 7) % 360).cast("smallint").alias("wind_direction"),
        F.floor(F.col("value") * 20).cast("int").alias("visibility_m"),
        ((F.col("event_id") % 1000).cast("decimal(6,0)") / 100).cast("decimal(6,2)").alias("precipitation_mm"),
        (F.lit(950) + (F.col("event_id") % 1000).cast("decimal(6,0)") / 10).cast("decimal(7,1)").alias("pressure_hpa"),
        F.when(F.col("value") < 100, "VFR").when(F.col("value") < 200, "MVFR")
         .when(F.col("value") < 300, "IFR").otherwise("LIFR").alias("conditions"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("event_hour"),
        F.floor(F.col("event_id") / WEATHER_CHUNK).alias("chunk"),
    )


WEATHER_CHUNK = 1000
LANDING_DELAY = "INTERVAL 10 MINUTES"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product records: version 1 for even part keys, version 2 (with the
    three optional fields) for odd keys."""
    p = table(spark, sf_dir, "part")
    v2 = F.col("p_partkey") % 2 == 1
    return p.select(
        F.when(v2, 2).otherwise(1).alias("version"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("category"),
        (F.lit(1704067200000) + F.col("p_partkey") * 60000).alias("ts"),
        F.when(v2, F.col("p_brand")).alias("description"),
        F.when(v2, F.concat(F.lit("size-"), F.col("p_size").cast("string"))).alias("subcategory"),
        F.when(v2, (F.col("p_size") % 50).cast("double")).alias("discount_pct"),
    )


def order_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the snapshot they are committed in (their order year)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"),
        F.year("o_orderdate").cast("string").alias("snapshot"),
    )
