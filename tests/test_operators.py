import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starweave.operators import (first_per_group, insert_new_members, latest_per_key,
                                 scd2_apply, sequence_within_group, upsert)
from starweave.plans import dims, facts
from starweave.sources import testdata_sources
from starweave.sources.arrivals import hot_sessions
from tests.conftest import SF_SMALL, ts


def test_first_and_latest_per_group_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("s", ts("2024-01-01 10:00:00"), "e2", "b"), ("s", ts("2024-01-01 10:00:00"), "e1", "a"),
         ("s", ts("2024-01-01 11:00:00"), "e0", "c"), ("t", None, "e9", "x"),
         ("t", ts("2024-01-01 09:00:00"), "e8", "y")], "k string, t timestamp_ntz, id string, v string")
    first = {r.k: r.v for r in first_per_group(df, ["k"], ["t", "id"]).collect()}
    assert first == {"s": "a", "t": "x"}   # ascending: ties by id, nulls first
    latest = {r.k: r.v for r in latest_per_key(df, ["k"], ["t", "id"]).collect()}
    assert latest == {"s": "c", "t": "y"}  # descending, nulls last


def test_upsert_replaces_inserts_never_deletes(spark):
    tgt = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    upd = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    got = sorted(tuple(r) for r in upsert(tgt, upd, "k").collect())
    assert got == [("a", 1), ("b", 20), ("c", 30)]


def test_upsert_rejects_duplicate_and_null_keys(spark):
    tgt = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="duplicate"):
        upsert(tgt, spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int"), "k")
    with pytest.raises(ValueError, match="null"):
        upsert(tgt, spark.createDataFrame([(None, 1)], "k string, v int"), "k")


def test_insert_new_members_ignores_null_member(spark):
    # anti_join_null: a null among target members must not hide new members
    tgt = spark.createDataFrame([("x",), (None,)], "category string")
    inc = spark.createDataFrame([("x",), ("y",)], "category string")
    got = sorted((r.category or "") for r in insert_new_members(tgt, inc, "category").collect())
    assert got == ["", "x", "y"]


DIM = "sr_id string, status string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def _v(sr, st, t):
    return (sr, st, ts(t), None, True)


def test_scd2_lifecycle_three_runs(spark):
    d0 = spark.createDataFrame([_v("sr1", "submitted", "2024-01-01 00:00:00")], DIM)
    d1 = scd2_apply(d0, spark.createDataFrame([_v("sr1", "matched", "2024-01-02 00:00:00")], DIM),
                    ["sr_id"], ["status"])
    d2 = scd2_apply(d1, spark.createDataFrame([_v("sr1", "completed", "2024-01-03 00:00:00")],
                                              DIM), ["sr_id"], ["status"])
    rows = sorted(d2.collect(), key=lambda r: r.valid_from)
    assert [r.status for r in rows] == ["submitted", "matched", "completed"]
    assert [r.is_current for r in rows] == [False, False, True]
    assert rows[0].valid_to == rows[1].valid_from and rows[1].valid_to == rows[2].valid_from
    # unchanged status opens nothing
    d3 = scd2_apply(d2, spark.createDataFrame([_v("sr1", "completed", "2024-01-04 00:00:00")],
                                              DIM), ["sr_id"], ["status"])
    assert d3.count() == 3


def test_scd2_null_to_value_is_a_change_and_late_versions_sort_in(spark):
    d0 = spark.createDataFrame([_v("sr1", None, "2024-01-01 00:00:00"),
                                _v("sr2", "matched", "2024-01-05 00:00:00")], DIM)
    d1 = scd2_apply(d0, spark.createDataFrame([_v("sr1", "submitted", "2024-01-02 00:00:00"),
                                               _v("sr2", "submitted", "2024-01-03 00:00:00")], DIM),
                    ["sr_id"], ["status"])
    rows = {(r.sr_id, r.status): r for r in d1.collect()}
    assert rows[("sr1", None)].is_current is False and rows[("sr1", "submitted")].is_current
    # the older sr2 version arrives late: it sorts before the current one
    assert rows[("sr2", "submitted")].valid_to == ts("2024-01-05 00:00:00")
    assert rows[("sr2", "matched")].is_current


def _hot_events(spark):
    return hot_sessions(testdata_sources(spark, SF_SMALL)).raw_events


def test_slices_equal_plain_window_with_hot_and_null_groups(spark):
    ev = _hot_events(spark)
    n = ev.count()
    assert ev.filter("session_id = 'session_hot'").count() > n / 4
    assert ev.filter("session_id is null").count() > n / 20
    look = ev.select("session_id").distinct().filter("session_id is not null").withColumn("x", F.length("session_id"))
    w = Window.partitionBy("session_id")
    o = w.orderBy("event_ts", "event_id")
    b = ev.join(look, "session_id", "left").select(
        *ev.columns, F.row_number().over(o).alias("seq"), F.lag("event_ts").over(o).alias("prev"),
        F.count("*").over(w).alias("n"), F.max("event_id").over(w).alias("m"), "x")
    for slices in (1, 37):
        a = sequence_within_group(ev, "session_id", ["event_ts", "event_id"], "seq", "prev",
                                  {"n": ("sum", F.lit(1)), "m": ("max", F.col("event_id"))}, look, slices)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_no_output_task_holds_a_hot_session_alone(spark):
    raw = hot_sessions(testdata_sources(spark, SF_SMALL))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        out = facts.fct_session_events(raw.raw_events, dims.dim_session(raw.raw_sessions, None), None)
        seen = out.groupBy("session_key", F.spark_partition_id().alias("task")).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    for hot in ("session_hot", None):
        sizes = [r["count"] for r in seen if r.session_key == hot]
        assert len(sizes) > 1 and max(sizes) < 0.8 * sum(sizes)


def test_broadcast_only_under_measured_bound(spark):
    from starweave.operators.joins import materialized_keys, sized_broadcast
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")

    def plan(df):
        j = big.join(df, "k", "left_semi")
        j.collect()
        return j._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(sized_broadcast(small, max_rows=10))
    assert "BroadcastHashJoin" in plan(materialized_keys(small))  # by the bytes of its table
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(materialized_keys(small))  # no hint
        assert "BroadcastHashJoin" not in plan(sized_broadcast(small, max_rows=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_category_replay_inserts_a_member(spark):
    from starweave.plans.incremental import LATE_CATEGORY, SR_CUTOFF, known_at, replay
    from starweave.sources.arrivals import without_category
    raw = testdata_sources(spark, SF_SMALL)
    early = dims.dim_category(known_at(without_category(raw, LATE_CATEGORY), SR_CUTOFF).service_requests, None)
    after = replay(spark, raw, "dim_category")
    assert {r.category for r in after.collect()} - {r.category for r in early.collect()} == {LATE_CATEGORY}
