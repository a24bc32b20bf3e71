"""Deliveries that are checked before they land; events without an id or a time in the stream."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starweave.plans import quality
from starweave.plans.build import Models
from starweave.plans.warehouse import MONTH, Warehouse
from starweave.sources import testdata_sources
from starweave.sources.deliveries import held_deliveries, land_delivery, landed_sources
from starweave.streaming import events as stream
from tests.conftest import RUN_TS, SF_SMALL, raw_frames, ts

DAY = "2024-01-0{} 10:00:00"


def event(i, session, day, sr=None, kind="pro_viewed"):
    return (i, session, kind, ts(DAY.format(day)) if day else None, '{"sr_id": "%s"}' % sr if sr else "{}")


def events(spark, *rows):
    return raw_frames(spark, raw_events=list(rows)).raw_events


def failed(report):
    return {r.test_name: r.n_failed for r in report.collect() if r.n_failed}


def test_bad_deliveries_are_held_and_good_ones_land(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    first = events(spark, event("a", "s", 1), event("b", "s", 2))
    assert failed(land_delivery(store, "raw_events", first)) == {}
    bad = [(events(spark, event("c", "s", 3), event(None, "s", 3)), {"raw_events__event_id__not_null": 1}),
           (events(spark, event("c", "s", 3), event("c", "t", 3)), {"raw_events__event_id__unique": 1}),
           (events(spark, event("c", "s", 3), event("a", "other", 1)), {"raw_events__event_id__landed": 1})]
    for i, (batch, want) in enumerate(bad):
        report = land_delivery(store, "raw_events", batch, f"d{i}")
        assert failed(report) == want and all(r.held for r in report.collect())
    assert sorted(r.event_id for r in store.read("raw_events").collect()) == ["a", "b"]
    held = held_deliveries(store, "raw_events")
    assert len(held) == 3 and spark.read.parquet(held[0]).count() == 2
    again = events(spark, event("b", "s", 2), event("c", "s", 3))  # b comes again as it was
    assert failed(land_delivery(store, "raw_events", again)) == {}
    assert sorted(r.event_id for r in landed_sources(store).raw_events.collect()) == ["a", "b", "c"]
    assert landed_sources(store).raw_payments.count() == 0
    assert failed(land_delivery(store, "raw_events", again.limit(0))) == {} and store.read("raw_events").count() == 3


def test_mutable_sources_are_upserted(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    row = lambda i, end, page="home": (i, ts(DAY.format(1)), end, page, ts(DAY.format(2)))
    send = lambda *rows: land_delivery(store, "raw_sessions", raw_frames(spark, raw_sessions=list(rows)).raw_sessions)
    send(row("s", None), row("t", None))
    send(row("s", ts(DAY.format(3))), row("u", None))
    assert {(r.session_id, r.ended_at is None) for r in store.read("raw_sessions").collect()} == {("s", False), ("t", True), ("u", True)}
    assert failed(send((None, None, None, "home", None))) == {"raw_sessions__session_id__not_null": 1, "raw_sessions__started_at__not_null": 1}
    pay = lambda status: raw_frames(spark, raw_payments=[("p", "sr", ts(DAY.format(1)), "ach", status, D(1), D(0), D(0), D(1), ts(DAY.format(1)))])  # noqa: E731,E501
    assert failed(land_delivery(store, "raw_payments", pay("lost").raw_payments)) == {"raw_payments__payment_status__accepted_values": 1}
    assert failed(land_delivery(store, "raw_payments", pay("failed").raw_payments)) == {}


ODD = [event("a", "s", 1), event(None, "s", 1), event(None, "s", 2), event("c", "s", None), event("d", "t", None)]
MORE = [event("e", "s", 3), event(None, "s", 1), event("a", "s", 2)]  # e is new, the id-less row is of another delivery


def same(got, want):
    got, want = got.drop("dw_updated_at"), want.drop("dw_updated_at")
    got = got.select(*want.columns)
    return got.count() == want.count() and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_keeps_rows_without_an_id_or_a_time(spark, tmp_path):
    """Two batches; each may be delivered again after a failure."""
    landed, fct = str(tmp_path / "raw"), str(tmp_path / "fct")
    sessions = raw_frames(spark, raw_sessions=[("s", ts(DAY.format(1)), None, "home", ts(DAY.format(1)))])
    batches = [events(spark, *ODD[:3]), events(spark, *ODD[3:])]
    dim = Models(spark, sessions, RUN_TS)["dim_session"]
    for batch in (batches[0], batches[0], batches[1], batches[1]):
        found = stream.merge_events_batch(batch, landed, fct, dim, RUN_TS)
    assert spark.read.parquet(landed).count() == 5
    full = Models(spark, raw_frames(spark, raw_events=ODD), RUN_TS, {"dim_session": dim})["fct_session_events"]
    assert full.count() == 5 and same(spark.read.parquet(fct).drop(MONTH), full)
    names = failed(found)
    assert names["fct_session_events__event_id__not_null"] == 2 and names["fct_session_events__event_ts__not_null"] == 2


def test_stream_drops_ids_that_came_before_by_its_state(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "base")
    dim = Models(spark, raw_frames(spark), RUN_TS)["dim_session"]

    def drain():
        q, landed, fct = stream.session_events_stream(spark, src, dim, lambda df: df, RUN_TS, base=base, source_schema=batch.schema)
        q.awaitTermination()
        assert q.exception() is None
        return spark.read.parquet(landed), spark.read.parquet(fct)

    batch = events(spark, *ODD)
    batch.coalesce(1).write.parquet(f"{src}/1")
    landed, _ = drain()
    assert landed.count() == 5
    events(spark, *MORE).coalesce(1).write.parquet(f"{src}/2")
    landed, fct = drain()
    # the event a came again under another day and is dropped; the id-less row equals one that landed that day
    assert sorted(str(r.event_id) for r in landed.collect()) == ["None", "None", "a", "c", "d", "e"]
    full = Models(spark, raw_frames(spark, raw_events=[*ODD, MORE[0]]), RUN_TS, {"dim_session": dim})["fct_session_events"]
    assert same(fct.drop(MONTH), full)
    names = {r.test_name for r in stream.found_by_checks(spark, base).collect()}
    assert {"fct_session_events__event_id__not_null", "fct_session_events__event_ts__not_null"} <= names


def test_freshness_has_an_age_and_a_status(spark):
    raw = testdata_sources(spark, SF_SMALL)
    old = raw.raw_events.agg(F.max("_loaded_at")).first()[0]
    at = lambda hours: old + dt.timedelta(hours=hours, minutes=30)
    sources = {"raw_events": raw.raw_events, "none": raw.raw_events.limit(0)}
    for hours, want in ((1, "pass"), (12, "warn"), (48, "error")):
        got = {r.source_name: r for r in quality.freshness_age(sources, at(hours), 12, 48).collect()}
        assert (got["raw_events"].age_hours, got["raw_events"].status) == (hours, want)
        assert (got["none"].age_hours, got["none"].status) == (None, "error")


def test_every_declared_check_is_in_the_oracle():
    from starweave import oracle
    written = {f"{m}__{c}__{kind}" for kind, text in oracle.CHECKS.items() for line in text.split("\n") if line.strip()
               for _, m, *cols in [line.split()] for c in cols}
    assert written == {c.name for c in quality.ALL_CHECKS} and len(written) == 49


@pytest.mark.parametrize("key", ["landed_events", "metric_dimensions"])
def test_new_queries_return_rows(spark, key):
    from starweave.plans import catalog
    assert catalog.registry()[key](spark, SF_SMALL).count() > 0
