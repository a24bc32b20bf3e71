"""Plan shape assertions and a DuckDB oracle check of representative queries."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from starweave.plans.build import Models
from starweave.plans.catalog import FIXED_RUN_TS
from starweave.sources import testdata_sources
from tests.conftest import SF_SMALL

from tools.check_oracle import TABLES, digest


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_booking_filter_pushed_and_columns_pruned(spark, tmp_path):
    """On landed raw tables (declared schema) the model's predicates reach the
    Parquet scan and only the needed columns are read."""
    from starweave.sources.raw import SOURCE_NAMES, RawSources
    raw = testdata_sources(spark, SF_SMALL)
    for n in SOURCE_NAMES:
        raw.table(n).write.parquet(str(tmp_path / n))
    landed = RawSources.from_landing(spark, str(tmp_path))
    df = Models(spark, landed, FIXED_RUN_TS)["fct_booking_events"]
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,booking_submitted)]" in p
    assert "ReadSchema: struct<event_id:string,session_id:string,event_type:string,event_ts:timestamp_ntz,properties:string>" in p


def test_calendar_join_is_broadcast(spark):
    df = E.queries()["conversion_by_month"](spark, SF_SMALL)
    p = _plan(df)
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and set(df.columns) == {"category_key", "converted_bookings",
                                                  "total_bookings", "booking_conversion_rate"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", ["fct_session_events", "fct_session_events_hot",
                                  "fct_booking_funnel", "fct_revenue",
                                  "dim_pro", "dim_service_request", "scd2_service_request",
                                  "booking_conversion_rate", "revenue_by_month", "dq_unique",
                                  "session_funnel_naive"])
def test_oracle_agrees(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_an_oracle():
    from starweave.plans.catalog import registry
    assert set(registry()) <= set(E.oracle_sql()) <= set(E.queries())
