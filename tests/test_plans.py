"""Physical plans: what is split, pruned, pre-aggregated and kept out of Python."""

import pytest

import __spark_entry__ as entry
from telemetra.operators.quality import dedup_readings
from telemetra.operators.reports import running_totals, sensor_kpis
from telemetra.operators.scale import group_sizes, join_groups
from telemetra.operators.scoring import detect_anomalies

SF_DIR = "/root/testdata/sf0.001"
STREAMS = ("T4_history_stream",)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(STREAMS)))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for operator in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan


def test_scans_read_what_they_need(spark):
    def schema(name):
        return plan_of(entry.queries()[name](spark, SF_DIR)).split("ReadSchema: ")[1].split("\n")[0]

    assert schema("A1_running_totals") == "struct<user_id:bigint,event_type:string,value:double>"
    assert schema("A5_store_totals") == "struct<event_type:string>"
    recent = plan_of(entry.queries()["F2_recent"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts," in recent


def test_copies_are_dropped_before_the_shuffle(readings):
    plan = plan_of(dedup_readings(readings([("co2", 1.0)]), ["room_id", "sensor_type"], ["event_id"]))
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_totals_are_combined_before_the_shuffle(readings):
    plan = plan_of(running_totals(readings([("co2", 1.0)])))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


def test_newest_rows_are_limited_before_the_shuffle(readings):
    df = readings([("co2", 1.0)])
    plan = plan_of(sensor_kpis(df, 60, "2024-01-01", newest=5))
    assert "row_number(), 5, Partial" in plan


def test_window_stats_are_computed_once(readings):
    df = detect_anomalies(readings([("co2", 1.0)]), order=["event_id"], strategy="plain")
    plan = plan_of(df)
    assert plan.count("stddev_pop(") == 1 and plan.count("Exchange") == 1


def test_chunked_window_has_no_single_partition(readings):
    df = detect_anomalies(readings([("co2", 1.0)] * 20), order=["event_id"], strategy="chunked")
    window = plan_of(df).split("stddev_pop")[1]
    assert "hashpartitioning(_chunk" in window
    # the only single partition counts the rows of each sort partition
    single = window.split("Exchange SinglePartition")
    assert len(single) == 2 and "keys=[_part" in single[1]


def test_group_sizes_and_broadcast(spark, readings):
    df = readings([("co2", 1.0)] * 3 + [("light", 1.0), (None, 1.0)])
    sizes = group_sizes(df, ["sensor_type"])
    assert sizes == (3, 3)
    assert group_sizes(df.limit(0), ["sensor_type"]) == (0, 0)
    per_group = df.groupBy("sensor_type").count()
    small = join_groups(df, per_group, ["sensor_type"], sizes.groups)
    assert "BroadcastHashJoin" in plan_of(small)
    assert sorted(r["count"] for r in small.collect()) == [1, 1, 3, 3, 3]
    many = join_groups(df, per_group, ["sensor_type"], 10**9)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in many
