"""Plan properties the design relies on at scale (checked on sf0.001)."""

import os

import pytest

from tidewater.plans import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _days_read(df) -> set:
    return {f.split("pos_date=")[1][:10] for f in df.inputFiles()}


def test_day_filter_prunes_partitions(spark):
    assert _days_read(Q.q_partition_filter(spark, SF)) == {"2024-01-15"}


def test_time_travel_prunes_to_committed_snapshots(spark):
    plan = _formatted(Q.q_time_travel(spark, SF))
    scan = [x for x in plan.split("\n") if "PartitionFilters" in x and "snapshot_id" in x]
    assert scan and "dynamicpruning" in scan[0]


def test_lookup_join_broadcasts_the_small_reference(spark):
    plan = _plan(Q.q_lookup_join(spark, SF))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "SortMergeJoin" not in plan


def test_decode_and_cast_need_no_shuffle(spark):
    assert "Exchange" not in _plan(Q.warehouse_rows(spark, SF))
    assert "Exchange" not in _plan(Q.q_envelope_decode(spark, SF))


def test_envelope_fields_are_looked_up_once(spark):
    assert _plan(Q.q_envelope_decode(spark, SF)).count("[latitude]") <= 1


def test_time_window_reaches_the_scan(spark):
    pushed = [x for x in _formatted(Q.q_window_rows(spark, SF)).split("\n") if "PushedFilters" in x][0]
    assert "GreaterThanOrEqual(observation_ts" in pushed and "LessThan(observation_ts" in pushed


def test_recent_rows_read_one_day(spark):
    assert len(_days_read(Q.q_recent_rows(spark, SF))) == 1 < len(_days_read(Q.positions_table(spark, SF).read()))


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(Q.q_table_summary(spark, SF))
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "props" not in scan            # events.props is never read
