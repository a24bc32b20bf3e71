"""Events without a session, and a hot session, through the nightly run, its replay and the stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starweave.plans import incremental as inc
from starweave.plans.build import Models
from starweave.plans.run import NEEDED, build_full_to_warehouse, build_incremental
from starweave.plans.warehouse import MONTH, Warehouse
from starweave.sources import testdata_sources
from starweave.sources.arrivals import hot_sessions
from starweave.streaming.events import merge_events_batch
from tests.conftest import RUN_TS, SF_SMALL

FACT = "fct_session_events"


@pytest.fixture(scope="module")
def hot(spark):
    return hot_sessions(testdata_sources(spark, SF_SMALL))


@pytest.fixture(scope="module")
def full(spark, hot):
    return Models(spark, hot, RUN_TS)[FACT].drop("dw_updated_at")


def assert_same(got, full):
    nulls = lambda df: df.filter("session_key is null").count()
    assert (got.count(), nulls(got)) == (full.count(), nulls(full))
    got = got.select(*full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_nights_keep_events_without_a_session(spark, hot, full, tmp_path):
    wh, day = Warehouse(spark, str(tmp_path / "w")), inc.EVENTS_CUTOFF
    build_full_to_warehouse(spark, inc.known_at(hot, day), wh, RUN_TS, NEEDED[FACT])
    nxt = day + dt.timedelta(days=1)
    build_incremental(spark, inc.known_at(hot, nxt), wh, nxt, RUN_TS, NEEDED[FACT])
    build_incremental(spark, hot, wh, nxt, RUN_TS, NEEDED[FACT])
    assert_same(wh.read(FACT), full)


def test_replay_keeps_events_without_a_session(spark, hot, full):
    assert_same(inc.replay(spark, hot, FACT, run_ts=RUN_TS), full)


def test_stream_keeps_events_without_a_session(spark, hot, full, tmp_path):
    sessions = Models(spark, hot, RUN_TS)["dim_session"]
    turn = F.regexp_extract("event_id", r"(\d+)", 1).cast("long") % 2
    for part in (0, 1, 1):  # the last delivery comes twice
        merge_events_batch(hot.raw_events.filter(turn == part), str(tmp_path / "raw"), str(tmp_path / "fct"), sessions, RUN_TS)
    assert_same(spark.read.parquet(str(tmp_path / "fct")).drop(MONTH), full)
