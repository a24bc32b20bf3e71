"""Merges that move a row to another month; a stream delivery replayed after a failure."""

import pytest
from pyspark.sql import functions as F

from starweave.plans.warehouse import CLUSTER_BY, KEY_OF, MONTH_OF, Warehouse
from starweave.streaming import events as stream

REV = "fct_revenue"


def rows_of(spark, rows):
    cols = dict.fromkeys([KEY_OF[REV], MONTH_OF[REV], *CLUSTER_BY[REV]])
    frame = spark.createDataFrame(rows, "k string, d date")
    return frame.select(*[F.col("k").alias(c) if c == KEY_OF[REV] else F.date_format("d", "yyyyMMdd").cast("int").alias(c) if c.endswith("date_key")
                          else F.col("d").cast("timestamp").alias(c) if c == MONTH_OF[REV] else F.lit("x").alias(c) for c in cols])


def test_a_row_that_moves_month_leaves_no_copy(spark, tmp_path):
    import datetime as dt
    store = Warehouse(spark, str(tmp_path / "w"))
    store.write_full(REV, rows_of(spark, [("p1", dt.date(2024, 1, 15)), ("p2", dt.date(2024, 3, 1))]))
    store.merge_partitions(REV, rows_of(spark, [("p1", dt.date(2024, 2, 1))]), KEY_OF[REV], True)
    got = store.read(REV, keep_month=True).collect()
    assert sorted(r[KEY_OF[REV]] for r in got) == ["p1", "p2"]
    assert len({r["_month"] for r in got}) == 2


def test_stream_replay_after_a_failure_between_the_writes(spark, tmp_path, monkeypatch):
    from starweave.plans import catalog
    from starweave.sources.testdata import raw_events
    sf = "/root/testdata/sf0.001"
    batch = raw_events(spark.read.parquet(f"{sf}/events.parquet"))
    landed, facts = str(tmp_path / "landed"), str(tmp_path / "facts")
    calls = []
    write = stream._overwrite_partitions

    def fail_second(df, path, part, order):
        calls.append(path)
        if path == facts and len(calls) == 2:
            raise RuntimeError("lost between the writes")
        write(df, path, part, order)

    monkeypatch.setattr(stream, "_overwrite_partitions", fail_second)
    sessions = catalog.registry()["dim_session"](spark, sf)
    import datetime as dt
    run = dt.datetime(2024, 1, 31)
    with pytest.raises(RuntimeError):
        stream.merge_events_batch(batch, landed, facts, sessions, run)
    stream.merge_events_batch(batch, landed, facts, sessions, run)
    assert spark.read.parquet(facts).count() == batch.select("event_id").distinct().count()


def test_scoped_keys_without_a_fresh_row_go(spark, tmp_path):
    import datetime as dt
    store = Warehouse(spark, str(tmp_path / "w"))
    store.write_full(REV, rows_of(spark, [("a", dt.date(2024, 1, 15)), ("b", dt.date(2024, 3, 1)), ("c", dt.date(2024, 4, 1))]))
    scope = spark.createDataFrame([("b",), ("c",), ("absent",)], "k string").withColumnRenamed("k", KEY_OF[REV])
    changed = store.merge_partitions(REV, rows_of(spark, [("c", dt.date(2024, 1, 2))]), KEY_OF[REV], True, scope, (KEY_OF[REV],))
    assert sorted(r[0] for r in changed.collect()) == ["b", "c", "c"]
    got = store.read(REV, keep_month=True).collect()
    assert sorted(r[KEY_OF[REV]] for r in got) == ["a", "c"] and len({r["_month"] for r in got}) == 1


def test_an_earlier_booking_that_arrives_late_replaces_the_funnel_row(spark):
    """Session s booked B; an earlier booking A of it arrives eight days later:
    the scope holds both SRs, the funnel then only A."""
    import datetime as dt
    from starweave.plans import facts, incremental as inc
    day = dt.datetime(2024, 1, 10)
    columns = "event_id string, session_id string, event_type string, event_ts timestamp_ntz, properties string"
    book = lambda i, sr, ts: (i, "s", "booking_submitted", ts, '{"sr_id": "%s"}' % sr)
    late, known = book("e1", "A", day), book("e2", "B", day + dt.timedelta(hours=1))
    before = facts.fct_booking_events(spark.createDataFrame([known], columns), day)
    change = inc.step_fct_booking_events(spark.createDataFrame([known, late], columns), dt.date(2024, 1, 18), day)
    gone = before.join(change.fresh.select("session_id"), "session_id", "left_semi")
    assert {r.sr_id for r in change.fresh.union(gone.select(*change.fresh.columns)).collect()} == {"A", "B"}
    assert [r.sr_id for r in change.apply(before).collect()] == ["A"]


def test_events_that_land_late_reach_the_session_fact(spark):
    """nightly_sessions over events that land 8 days late ends as the full build."""
    from starweave.plans import catalog
    sf, queries = "/root/testdata/sf0.001", catalog.registry()
    late = spark.read.parquet(f"{sf}/events.parquet").filter("event_id % 5 = 0").count()
    got, full = queries["nightly_sessions"](spark, sf), queries["fct_session_events"](spark, sf)
    assert late > 0 and got.count() == full.count()
    got = got.select(*full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
