"""Result queries run against loaded tables.

Each takes the table as a DataFrame and returns a DataFrame; aggregations
are plain ``groupBy().agg()`` so Catalyst does partial (map-side)
aggregation before the shuffle, and a hot key only ever costs one partial row
per task.  Sorted top-k uses ``orderBy().limit()``, which plans as a
per-task top-k merged on the driver (``TakeOrderedAndProject``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_summary(t: DataFrame, key: str = "icao24", ts: str = "ts") -> DataFrame:
    """Global count, first/last timestamp and exact distinct keys."""
    return t.agg(
        F.count(F.lit(1)).alias("positions_received"),
        F.min(ts).alias("earliest_ts"),
        F.max(ts).alias("latest_ts"),
        F.countDistinct(key).alias("aircraft_seen"),
    )


def per_key_summary(t: DataFrame) -> DataFrame:
    """Two-key group with count and mean altitude, busiest first."""
    return (t.groupBy("icao24", "callsign")
            .agg(F.count(F.lit(1)).alias("position_count"),
                 F.avg(F.col("altitude").cast("double")).alias("avg_altitude_ft"))
            .orderBy(F.desc("position_count"), "icao24", "callsign"))


def per_key_avg_int(t: DataFrame) -> DataFrame:
    """``CAST(AVG(CAST(altitude AS FLOAT)) AS INTEGER)`` truncates."""
    return (t.groupBy(F.trim("icao24").alias("icao24"), F.trim("callsign").alias("callsign"))
            .agg(F.count(F.lit(1)).alias("positions"),
                 F.avg(F.col("altitude").cast("double")).cast("int").alias("avg_alt_ft"))
            .orderBy("icao24", "callsign"))


def enriched_summary(t: DataFrame) -> DataFrame:
    """Per aircraft: count and the (functionally dependent) reference values."""
    return (t.groupBy(F.trim("icao24").alias("icao24"), F.trim("callsign").alias("callsign"))
            .agg(F.count(F.lit(1)).alias("positions"),
                 F.max("registration").alias("registration"),
                 F.max("aircraft_type").alias("ac_type"),
                 F.max("operator").alias("operator"),
                 F.max("country").alias("country"))
            .orderBy("icao24", "callsign"))


def station_summary(t: DataFrame) -> DataFrame:
    """Weather per station; the mean is the exact sum over the count."""
    return (t.groupBy("station_id")
            .agg(F.count(F.lit(1)).alias("total_obs"),
                 (F.sum("temperature_c").cast("double") / F.count("temperature_c")).alias("avg_temp_c"),
                 F.max("wind_speed_kts").alias("max_wind_kts"))
            .orderBy("station_id"))


def ingest_lag(t: DataFrame, ingest_col: str = "ingest_ts", ts: str = "ts") -> DataFrame:
    """Mean (ingest_ts - ts) in seconds per aircraft."""
    lag = (F.unix_micros(F.col(ingest_col).cast("timestamp"))
           - F.unix_micros(F.col(ts).cast("timestamp")))
    return (t.groupBy("icao24")
            .agg(F.count(F.lit(1)).alias("positions"),
                 (F.avg(lag) / F.lit(1e6)).alias("avg_lag_s"))
            .orderBy("icao24"))


def status_line(t: DataFrame, ts: str = "ts") -> DataFrame:
    """``STATUS rows=<n> latest=<max ts or none>``; an empty table gives rows=0."""
    agg = t.agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("latest"))
    return agg.select(F.concat(
        F.lit("STATUS rows="), F.col("n").cast("string"), F.lit(" latest="),
        F.coalesce(F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("none")),
    ).alias("status"))


def status_line_keys(t: DataFrame, key: str = "icao24", ts: str = "ts") -> DataFrame:
    """The status line with the number of distinct keys."""
    agg = t.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("keys"), F.max(ts).alias("latest"))
    return agg.select(F.concat(
        F.lit("STATUS rows="), F.col("n").cast("string"), F.lit(" keys="), F.col("keys").cast("string"), F.lit(" latest="),
        F.coalesce(F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("none")),
    ).alias("status"))


def top_n(t: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return t.orderBy(*order).limit(n)


def sample_n(t: DataFrame, n: int, seed: int, order: list[str]) -> DataFrame:
    """N random rows, then shown in key order.  Random means the smallest
    digests of key, time and seed, so a seed picks the same rows however the
    table is partitioned; rows with equal keys and times go by their values."""
    mark = F.md5(F.concat_ws("|", F.col(order[0]), F.date_format(order[1], "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(str(seed))))
    rest = [c for c in t.columns if c not in order]
    return t.orderBy(mark, *order, *rest).limit(n).orderBy(*order)


def recent_rows(t: DataFrame, day_col: str = "pos_date", ts: str = "ts") -> DataFrame:
    """Rows of the latest day, newest first (the reference uses CURRENT_DATE).
    On a table partitioned by day the maximum reads no data column and the
    scalar subquery becomes a partition filter."""
    latest = t.agg(F.max(day_col)).first()[0]  # one value
    return t.where(F.col(day_col) == F.lit(latest)).orderBy(F.desc(ts))


def by_key(t: DataFrame, key: str, value: str, ts: str = "ts") -> DataFrame:
    return t.where(F.col(key) == F.lit(value)).orderBy(F.desc(ts))


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial great-circle bearing from point 1 to point 2, in [0, 360)."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dl = F.radians(lon2 - lon1)
    x = F.sin(dl) * F.cos(p2)
    y = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(x, y)) + F.lit(360.0), F.lit(360.0))


def window_rows(t: DataFrame, start: dt.datetime, end: dt.datetime, ts: str = "observation_ts") -> DataFrame:
    """Rows with ``start <= ts < end``; literals, so the scan filters them."""
    start, end = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    return t.where((F.col(ts) >= start) & (F.col(ts) < end))


def hour_window_counts(t: DataFrame) -> DataFrame:
    """Per landing hour: rows inside the half-open [hour, hour + 1h) window."""
    start = F.make_timestamp_ntz(
        F.year("landing_date"), F.month("landing_date"), F.dayofmonth("landing_date"),
        F.col("landing_hour").cast("int"), F.lit(0), F.lit(0))
    inside = (F.col("observation_ts") >= start) & (F.col("observation_ts") < start + F.expr("INTERVAL 1 HOUR"))
    return (t.groupBy("landing_date", "landing_hour", inside.alias("in_window"))
            .agg(F.count(F.lit(1)).alias("rows")))
