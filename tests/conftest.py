import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# --- fixed values: the fleet of the position producer, in order -----------
FLEET = [
    ("4ca87a", "EIN101"), ("400a5b", "BAW213"), ("3c4b0f", "DLH463"), ("3950f2", "AFR674"),
    ("34618a", "IBE601"), ("4841d8", "KLM649"), ("4b1803", "SWR100"), ("440a45", "VIR025"),
    ("4073d6", "TOM3XT"), ("3f7062", "RYR4421"),
]
# --- end fixed values -----------------------------------------------------

BASE_MS = 1782129600000  # 2026-06-22 12:00:00 UTC


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import local_session
    s = local_session("*", app="tidewater-tests")
    yield s
    s.stop()


def position_rows(n: int, start: int = 0):
    """Message i is aircraft i % 10, one second apart (as the producer)."""
    rows = []
    for i in range(start, start + n):
        icao, cs = FLEET[i % 10]
        ms = BASE_MS + i * 1000 + (i % 3) * 5
        rows.append({
            "offset": i, "icao24": icao, "callsign": cs,
            "latitude": round(51.47 + i * 1e-4, 6), "longitude": round(-0.46 - i * 1e-4, 6),
            "altitude": 37000 - i, "velocity": 490.5, "heading": 285.1,
            "vertical_rate": 0, "on_ground": i % 10 == 9, "squawk": "2341",
            "ts_ms": ms, "ts": dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms),
        })
    return rows


def positions_df(spark, n: int, start: int = 0):
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("offset", T.LongType()), T.StructField("icao24", T.StringType()),
        T.StructField("callsign", T.StringType()), T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()), T.StructField("altitude", T.IntegerType()),
        T.StructField("velocity", T.DoubleType()), T.StructField("heading", T.DoubleType()),
        T.StructField("vertical_rate", T.IntegerType()), T.StructField("on_ground", T.BooleanType()),
        T.StructField("squawk", T.StringType()), T.StructField("ts_ms", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
    ])
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in position_rows(n, start)], schema)


def text_messages(spark, lines, topic="t", start=0, key=None):
    """Topic rows from text values (offsets from ``start``)."""
    from tidewater.schemas import TOPIC_SCHEMA
    now = dt.datetime(2026, 6, 22, 12, 0, 0)
    rows = [(key.encode() if key else None, None if v is None else (v.encode() if isinstance(v, str) else v),
             topic, 0, start + i, now, 0, None) for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, TOPIC_SCHEMA)
