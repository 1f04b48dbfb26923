"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
correctness gate, run locally), plus the entry smoke check."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tidewater.plans.queries import QUERIES
from tools.oracle_check import TABLES, _rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["icao24", "callsign", "positions", "registration", "ac_type", "operator", "country"]


def test_every_query_has_an_oracle():
    assert not set(QUERIES) - set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(cols, rows, False) == _rows(ocols, orows, False)
