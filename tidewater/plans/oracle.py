"""DuckDB SQL equal to each registered query (the correctness oracle).

The analog views are restated here as SQL common table expressions over the
driver's tables; each query's text computes its expected result directly
from the source tables, without the encode/decode round trip.
"""

from __future__ import annotations

POSITIONS = """
positions AS (
  SELECT event_id,
         lpad(CAST(user_id AS VARCHAR), 6, '0') AS icao24,
         'EV' || CAST(user_id AS VARCHAR) AS callsign,
         round(value / 10, 6) AS latitude,
         round(-value / 5, 6) + 0.0 AS longitude,   -- Spark's round gives 0.0, not -0.0
         CAST(floor(value * 80) AS INTEGER) AS altitude,
         value AS velocity,
         CAST(event_id % 360 AS DOUBLE) AS heading,
         CAST(event_id % 101 - 50 AS INTEGER) AS vertical_rate,
         event_type = 'signup' AS on_ground,
         lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') AS squawk,
         CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS ts,
         CAST(ts AS DATE) AS pos_date
  FROM events)"""

LAKE = """
lake AS (
  SELECT event_id AS "offset", icao24, callsign,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE latitude END AS latitude,
         longitude, altitude, velocity, heading, vertical_rate,
         CASE WHEN on_ground THEN 1 ELSE 0 END AS on_ground, squawk,
         strftime(ts, '%Y-%m-%d') AS pos_date, ts
  FROM positions WHERE event_id % 7 <> 3)"""

WAREHOUSE = """
wh AS (
  SELECT event_id AS "offset", icao24, callsign, pos_date,
         CAST(latitude AS DECIMAL(9,6)) AS latitude,
         CAST(longitude AS DECIMAL(10,6)) AS longitude,
         altitude,
         CAST(velocity AS DECIMAL(7,2)) AS velocity,
         CAST(heading AS DECIMAL(6,2)) AS heading,
         vertical_rate,
         CAST(CASE WHEN on_ground THEN 1 ELSE 0 END AS TINYINT) AS on_ground,
         squawk, ts
  FROM positions WHERE event_id % 7 <> 3 AND event_id % 5 <> 0)"""

REF = """
ref AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS icao24,
         'REG-' || CAST(s_suppkey AS VARCHAR) AS registration,
         'T' || CAST(n_regionkey AS VARCHAR) AS aircraft_type,
         CASE WHEN s_acctbal >= 0 THEN s_name END AS operator,
         n_name AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

REF_DUPS = """
ref2 AS (
  SELECT * FROM ref
  UNION ALL
  SELECT icao24, registration || '-B', aircraft_type, operator, country
  FROM ref WHERE CAST(icao24 AS BIGINT) % 10 = 0)"""

ENRICHED = """
enriched AS (
  SELECT l.*, coalesce(r.registration, 'UNKNOWN') AS registration,
         coalesce(r.aircraft_type, 'UNKNOWN') AS aircraft_type,
         coalesce(r.operator, 'UNKNOWN') AS operator,
         coalesce(r.country, 'UNKNOWN') AS country
  FROM lake l LEFT JOIN {ref} r ON l.icao24 = r.icao24)"""

TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"

ENVELOPE_COLUMNS = """icao24, callsign, strftime(ts, '%Y-%m-%d') AS pos_date,
         {lat} AS latitude, longitude, CAST(altitude AS DOUBLE) AS altitude, velocity, heading,
         CAST(vertical_rate AS DOUBLE) AS vertical_rate,
         CASE WHEN on_ground THEN 1 ELSE 0 END AS on_ground, squawk,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts"""

BEARING = """
  (degrees(atan2(sin(radians(longitude - (-0.46))) * cos(radians(latitude)),
                 cos(radians(51.47)) * sin(radians(latitude))
                 - sin(radians(51.47)) * cos(radians(latitude)) * cos(radians(longitude - (-0.46)))))
   + 360.0) % 360.0"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORACLE: dict[str, str] = {
    "delimited_scan": with_(POSITIONS, LAKE) + "SELECT * FROM lake",
    "delimited_rejects": with_(POSITIONS) + """
SELECT event_id AS "offset", 'PARSE' AS error_stage, CAST(NULL AS VARCHAR) AS error_column,
       'expected 12 fields, got 11' AS error_message
FROM positions WHERE event_id % 7 = 3""",
    "cast_rejects": with_(POSITIONS) + """
SELECT event_id AS "offset", 'PARSE' AS error_stage, CAST(NULL AS VARCHAR) AS error_column,
       'expected 12 fields, got 11' AS error_message
FROM positions WHERE event_id % 7 = 3
UNION ALL
SELECT event_id, 'CAST', 'latitude', 'null in NOT NULL column'
FROM positions WHERE event_id % 7 <> 3 AND event_id % 5 = 0""",
    "encode_line": with_(POSITIONS) + """
SELECT event_id AS "offset",
       icao24 || '|' || callsign || '|' || CAST(latitude AS VARCHAR) || '|'
       || CAST(longitude AS VARCHAR) || '|' || CAST(altitude AS VARCHAR) || '|'
       || CAST(velocity AS VARCHAR) || '|' || CAST(heading AS VARCHAR) || '|'
       || CAST(vertical_rate AS VARCHAR) || '|' || CASE WHEN on_ground THEN '1' ELSE '0' END || '|'
       || squawk || '|' || strftime(ts, '%Y-%m-%d') || '|'
       || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || chr(10) AS line
FROM positions""",
    "json_roundtrip": with_(POSITIONS) + """
SELECT event_id AS "offset", icao24, callsign, latitude, longitude, altitude, velocity, heading,
       vertical_rate, CASE WHEN on_ground THEN 1 ELSE 0 END AS on_ground, squawk,
       strftime(ts, '%Y-%m-%d') AS pos_date, ts
FROM positions""",
    "envelope_decode": with_(POSITIONS) + "SELECT event_id AS \"offset\", "
        + ENVELOPE_COLUMNS.format(lat="latitude") + "\nFROM positions WHERE event_id % 5 <> 0",
    "warehouse_load": with_(POSITIONS, WAREHOUSE) + "SELECT *, TRUE AS stamped, 'load-0' AS load_id FROM wh",
    "lookup_join": with_(POSITIONS, LAKE, REF, ENRICHED.format(ref="ref")) + "SELECT * FROM enriched",
    "lookup_join_dups": with_(POSITIONS, LAKE, REF, REF_DUPS, ENRICHED.format(ref="ref2"))
        + "SELECT * FROM enriched",
    "enriched_summary": with_(POSITIONS, LAKE, REF, ENRICHED.format(ref="ref")) + """
SELECT trim(icao24) AS icao24, trim(callsign) AS callsign, count(*) AS positions,
       max(registration) AS registration, max(aircraft_type) AS ac_type,
       max(operator) AS operator, max(country) AS country
FROM enriched GROUP BY 1, 2 ORDER BY 1, 2""",
    "table_summary": with_(POSITIONS, WAREHOUSE) + """
SELECT count(*) AS positions_received, min(ts) AS earliest_ts, max(ts) AS latest_ts,
       count(DISTINCT icao24) AS aircraft_seen
FROM wh""",
    "per_key_summary": with_(POSITIONS, WAREHOUSE) + """
SELECT icao24, callsign, count(*) AS position_count,
       avg(CAST(altitude AS DOUBLE)) AS avg_altitude_ft
FROM wh GROUP BY icao24, callsign ORDER BY position_count DESC, icao24, callsign""",
    "per_key_avg_int": with_(POSITIONS, LAKE) + """
SELECT trim(icao24) AS icao24, trim(callsign) AS callsign, count(*) AS positions,
       CAST(trunc(avg(CAST(altitude AS DOUBLE))) AS INTEGER) AS avg_alt_ft
FROM lake GROUP BY 1, 2 ORDER BY 1, 2""",
    "ingest_lag": with_(POSITIONS, WAREHOUSE) + """
SELECT icao24, count(*) AS positions,
       avg(CAST(("offset" % 10) * 1000000 AS BIGINT)) / 1e6 AS avg_lag_s
FROM wh GROUP BY icao24 ORDER BY icao24""",
    "status_line": with_(POSITIONS, WAREHOUSE) + """
SELECT 'STATUS rows=' || CAST(count(*) AS VARCHAR) || ' latest='
       || coalesce(strftime(max(ts), '%Y-%m-%d %H:%M:%S.%g'), 'none') AS status
FROM wh""",
    "status_line_keys": with_(POSITIONS, WAREHOUSE) + """
SELECT 'STATUS rows=' || CAST(count(*) AS VARCHAR) || ' keys=' || CAST(count(DISTINCT icao24) AS VARCHAR) || ' latest='
       || coalesce(strftime(max(ts), '%Y-%m-%d %H:%M:%S.%g'), 'none') AS status
FROM wh""",
    "top_n": with_(POSITIONS, WAREHOUSE) + """
SELECT * FROM wh ORDER BY velocity DESC, "offset" LIMIT 10""",
    "sample_n": with_(POSITIONS, LAKE) + """
SELECT * FROM lake
ORDER BY md5(icao24 || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || '|42'), "offset" LIMIT 10""",
    "recent_rows": with_(POSITIONS, WAREHOUSE) + """
SELECT * FROM wh WHERE pos_date = (SELECT max(pos_date) FROM wh) ORDER BY ts DESC""",
    "recent_by_key": with_(POSITIONS, LAKE) + """
SELECT * FROM lake WHERE icao24 = '000007' ORDER BY ts DESC""",
    "bearing": with_(POSITIONS, LAKE) + f"""
SELECT "offset", icao24, round({BEARING}, 1) AS bearing FROM lake""",
    "dlq_split": """
SELECT CAST('0x' || substr(md5(lpad(CAST(user_id AS VARCHAR), 6, '0')), 1, 4) AS INTEGER) % 4 AS "partition",
       row_number() OVER (PARTITION BY CAST('0x' || substr(md5(lpad(CAST(user_id AS VARCHAR), 6, '0')), 1, 4) AS INTEGER) % 4
                          ORDER BY event_id) - 1 AS "offset",
       'adsb-positions-envelope' AS orig_topic, 0 AS orig_partition, event_id AS orig_offset,
       'VALUE_CONVERTER' AS stage,
       'org.apache.kafka.connect.errors.DataException' AS exception_class,
       'Converter error: null value for a required (non-optional) field' AS exception_message
FROM events WHERE event_id % 5 = 0""",
    "topic_depth": """
SELECT count(*) AS depth,
       count(DISTINCT CAST('0x' || substr(md5(lpad(CAST(user_id AS VARCHAR), 6, '0')), 1, 4) AS INTEGER) % 4) AS partitions
FROM events WHERE event_id % 5 = 0""",
    "dlq_replay": with_(POSITIONS) + """
SELECT (SELECT max(event_id) + 1 FROM events) + row_number() OVER (ORDER BY event_id) - 1 AS "offset",
       event_id AS orig_offset, """ + ENVELOPE_COLUMNS.format(lat="round(-longitude / 2, 6)") + """
FROM positions WHERE event_id % 5 = 0""",
}

ORACLE["record_balance"] = """
WITH e AS (
  SELECT CASE event_id % 11 WHEN 0 THEN 'null message' WHEN 1 THEN 'blank latitude'
                            WHEN 2 THEN 'short record' WHEN 3 THEN 'wrong type' ELSE 'none' END AS fault
  FROM events),
r AS (SELECT unnest(['delimited', 'lake', 'json', 'envelope', 'weather']) AS route),
t AS (SELECT *, fault = 'none' OR fault = 'blank latitude' AND route IN ('lake', 'json') AS fine FROM e, r)
SELECT route, fault, count(*) AS records,
       count(CASE WHEN fine THEN 1 END) AS good,
       count(CASE WHEN NOT fine AND route <> 'envelope' THEN 1 END) AS rejected,
       count(CASE WHEN NOT fine AND route = 'envelope' THEN 1 END) AS dead,
       TRUE AS balanced
FROM t GROUP BY route, fault"""

ORDERS_LAKE = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       strftime(o_orderdate, '%Y-%m') AS order_month
FROM orders"""

WEATHER = """
w AS (
  SELECT event_id, upper(substr(event_type, 1, 4)) AS station_id,
         CAST(date_trunc('second', ts) AS TIMESTAMP) AS observation_ts,
         CAST((event_id % 500 - 200) / 10.0 AS DECIMAL(5,1)) AS temperature_c,
         CAST(user_id % 60 AS SMALLINT) AS wind_speed_kts,
         CAST((event_id * 7) % 360 AS SMALLINT) AS wind_direction,
         CAST(floor(value * 20) AS INTEGER) AS visibility_m,
         CAST((event_id % 1000) / 100.0 AS DECIMAL(6,2)) AS precipitation_mm,
         CAST(950 + (event_id % 1000) / 10.0 AS DECIMAL(7,1)) AS pressure_hpa,
         CASE WHEN value < 100 THEN 'VFR' WHEN value < 200 THEN 'MVFR'
              WHEN value < 300 THEN 'IFR' ELSE 'LIFR' END AS conditions,
         date_trunc('hour', ts) AS event_hour,
         floor(event_id / 1000) AS chunk
  FROM events),
m AS (
  SELECT event_hour, chunk, max(observation_ts) + INTERVAL 10 MINUTE AS landed, count(*) AS n
  FROM w GROUP BY event_hour, chunk),
wl AS (
  SELECT w.*, strftime(m.landed, '%Y-%m-%d') AS landing_date, strftime(m.landed, '%H') AS landing_hour,
         m.landed
  FROM w JOIN m USING (event_hour, chunk))"""

WEATHER_COLS = """station_id, observation_ts, temperature_c, wind_speed_kts, wind_direction,
       visibility_m, precipitation_mm, pressure_hpa, conditions"""

ORACLE.update({
    "lake_current": ORDERS_LAKE,
    "time_travel": ORDERS_LAKE + " WHERE year(o_orderdate) <= 1998",
    "snapshot_history": """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS snapshot_id,
       row_number() OVER (ORDER BY year(o_orderdate)) AS sequence_number,
       'append' AS operation, count(*) AS added_rows
FROM orders GROUP BY year(o_orderdate)""",
    "partition_filter": with_(POSITIONS, WAREHOUSE) + """
SELECT * FROM wh WHERE pos_date = DATE '2024-01-15'""",
    "csv_scan": with_(WEATHER) + """
SELECT strftime(landed, '%Y-%m-%d') AS landing_date, strftime(landed, '%H') AS landing_hour,
       count(*) AS files,
       CAST(sum(n + CASE WHEN hour(event_hour) % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows
FROM m GROUP BY 1, 2""",
    "weather_load": with_(WEATHER) + f"SELECT {WEATHER_COLS} FROM w",
    "hour_reload": with_(WEATHER) + f"SELECT {WEATHER_COLS}, landing_date, landing_hour FROM wl",
    "hour_scoped_load": with_(WEATHER) + f"""
SELECT {WEATHER_COLS}, landing_date, landing_hour FROM wl
WHERE date_trunc('hour', landed) >= TIMESTAMP '2024-01-15 06:00:00' AND date_trunc('hour', landed) < TIMESTAMP '2024-01-15 18:00:00'""",
    "window_rows": with_(WEATHER) + f"""
SELECT {WEATHER_COLS} FROM w
WHERE observation_ts >= TIMESTAMP '2024-01-15 06:00:00' AND observation_ts < TIMESTAMP '2024-01-15 18:00:00'""",
    "manifest_files": """
SELECT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS stage_id,
       CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + length(o_orderstatus) + 13) AS BIGINT) AS bytes,
       count(*) AS lines, CAST(0 AS BIGINT) AS missing
FROM orders GROUP BY 1
UNION ALL SELECT 900000 + i, NULL, NULL, 1 FROM range(3) AS g(i)""",
    "hour_window_filter": with_(WEATHER) + """
SELECT landing_date, landing_hour,
       observation_ts >= date_trunc('hour', landed)
         AND observation_ts < date_trunc('hour', landed) + INTERVAL 1 HOUR AS in_window,
       count(*) AS rows
FROM wl GROUP BY 1, 2, 3""",
    "station_summary": with_(WEATHER) + """
SELECT station_id, count(*) AS total_obs,
       CAST(sum(temperature_c) AS DOUBLE) / count(temperature_c) AS avg_temp_c,
       max(wind_speed_kts) AS max_wind_kts
FROM w GROUP BY station_id ORDER BY station_id""",
    "ref_seed": with_(REF) + "SELECT * FROM ref",
    "ref_update": with_(REF) + """
SELECT icao24, registration, aircraft_type,
       CASE WHEN icao24 = '000007' THEN 'UPDATED OPERATOR' ELSE operator END AS operator, country
FROM ref""",
})

PRODUCTS = """
prod AS (
  SELECT CASE WHEN p_partkey % 2 = 1 THEN 2 ELSE 1 END AS ver,
         CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_retailprice AS price,
         p_type AS category, epoch_ms(1704067200000 + p_partkey * 60000) AS ts,
         CASE WHEN p_partkey % 2 = 1 THEN p_brand END AS description,
         CASE WHEN p_partkey % 2 = 1 THEN 'size-' || CAST(p_size AS VARCHAR) END AS subcategory,
         CASE WHEN p_partkey % 2 = 1 THEN CAST(p_size % 50 AS DOUBLE) END AS discount_pct
  FROM part)"""

AVRO_POSITION_COLS = """event_id AS "offset", icao24, callsign, latitude, longitude, altitude, velocity,
       heading, vertical_rate, on_ground, squawk, epoch_ms(ts) AS ts"""

ORACLE.update({
    "avro_raw_roundtrip": with_(POSITIONS) + f"SELECT {AVRO_POSITION_COLS} FROM positions",
    "avro_framed_roundtrip": with_(POSITIONS) + f"""
SELECT {AVRO_POSITION_COLS}, CASE WHEN event_id % 2 = 1 THEN 2 ELSE 1 END AS schema_id
FROM positions""",
    "container_split": with_(PRODUCTS) + """
SELECT ver AS container_id, count(*) AS records FROM prod GROUP BY ver ORDER BY ver""",
    "schema_evolution": with_(PRODUCTS) + """
SELECT ver, product_id, price, description, discount_pct FROM prod""",
    "nested_filter": with_(PRODUCTS) + """
SELECT product_id, name, discount_pct FROM prod WHERE discount_pct > 20.0""",
    "unnest_struct": with_(PRODUCTS) + """
SELECT ver AS container_id, product_id, name, price, category, ts, description, subcategory,
       discount_pct
FROM prod""",
    "validity_counts": "SELECT 'OK' AS validity, count(*) AS cnt FROM part",
})
