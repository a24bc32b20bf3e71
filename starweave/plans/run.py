"""Entry points of a scheduled run: full build and nightly incremental run."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import assert_unique_keys
from ..operators.spans import key_spans
from ..session import released_cuts
from ..sources.raw import RawSources
from . import incremental as inc
from .build import BUILD_ORDER, Models, default_run_ts
from .quality import check_table
from .warehouse import Warehouse

# Tables a single fact needs below it, in build order.
SR_DIMS = ["dim_category", "dim_geography", "dim_pro", "dim_service_request"]
NEEDED = {
    "fct_session_events": ["dim_session", "fct_session_events"],
    "fct_booking_funnel": [*SR_DIMS, "dim_session", "fct_booking_events", "fct_booking_funnel"],
    "fct_revenue": [*SR_DIMS, "fct_revenue"],
}


# The keys that later steps look tables up by, among the current rows.
LOOKUP_KEYS = {
    "dim_category": ["category"], "dim_geography": ["geography"], "dim_session": ["session_id"],
    "dim_service_request": ["sr_id"], "dim_pro": ["sp_id", "category_key"],
}


# Span indexes: the source, its key and time, and the facts whose nights read by them.
INDEXES = {
    "idx_session_days": ("raw_events", "session_id", "event_ts", ["fct_booking_events", "fct_session_events"]),
    "idx_payment_days": ("raw_payments", "sr_id", "updated_at", ["fct_revenue"]),
}


def audit(name: str, table: DataFrame, dim_date: DataFrame, touched: DataFrame | None = None) -> None:
    """What a staged table must pass before it is read or published: its lookup
    key occurs once among the current rows (G7), and its declared checks (DQ1 to
    DQ5). After a merge, only the keys of its changed rows (``touched``) can have
    come to repeat."""
    if name in LOOKUP_KEYS:
        current = table.filter("is_current") if "is_current" in table.columns else table
        if touched is not None and set(LOOKUP_KEYS[name]) <= set(touched.columns):
            current = current.join(touched.select(*LOOKUP_KEYS[name]).distinct(), LOOKUP_KEYS[name], "left_semi")
        assert_unique_keys(current, LOOKUP_KEYS[name], name)
    check_table(name, table, dim_date)


def build_full_to_warehouse(spark: SparkSession, raw: RawSources, wh: Warehouse,
                            run_ts=None, tables=BUILD_ORDER, check: bool = True) -> None:
    """Build every model and write it; downstream models read the written
    upstream tables (materialised inputs, short lineage). Each table is audited
    before the next is built; all are published together, or none if one fails."""
    with released_cuts(spark), wh.transaction():
        m = Models(spark, raw, run_ts or default_run_ts())
        for name in tables:
            wh.write_full(name, *m.stored(name))
            m._cache[name] = wh.read(name)
            if check:
                audit(name, m[name], m["dim_date"])
        for name in indexes_for(tables):
            wh.write_full(name, index_of(name, raw))


def indexes_for(tables) -> list[str]:
    return [i for i, (_, _, _, facts) in INDEXES.items() if set(facts) & set(tables)]


def index_of(name: str, raw: RawSources) -> DataFrame:
    source, key, time, _ = INDEXES[name]
    return key_spans(raw.table(source), key, time)


def build_incremental(spark: SparkSession, raw: RawSources, wh: Warehouse, as_of: _dt.date,
                      run_ts=None, tables=BUILD_ORDER, check: bool = True) -> None:
    """One nightly run at ``as_of``: dimensions first (upsert / insert-only /
    type-2), then facts from the refreshed dimensions, each step rewriting only
    the files its change set touches. What a step replaced and wrote scopes the
    funnel step after it. Tables are audited and published as in a full build."""
    ts = run_ts or default_run_ts()
    sr = raw.service_requests
    now = Models(spark, raw, ts)
    changed: dict[str, DataFrame] = {}

    def run(name, step) -> None:
        if name in tables:
            changed[name] = wh.apply(name, step(wh.read(name)))
            now._cache[name] = wh.read(name)
            if check:
                audit(name, now[name], now["dim_date"], changed[name])

    with released_cuts(spark), wh.transaction():
        run("dim_category", lambda prev: inc.step_dim_category(prev, sr, ts))
        run("dim_geography", lambda prev: inc.step_dim_geography(prev, sr, ts))
        run("dim_session", lambda prev: inc.step_dim_session(raw.raw_sessions, as_of, ts))
        run("dim_pro", lambda prev: inc.step_dim_pro(
            prev, raw.raw_pro_profiles, as_of, ts, wh.read("dim_pro", current=True)))
        run("dim_service_request", lambda prev: inc.step_dim_service_request(
            prev, sr, now["dim_category"], now["dim_geography"], as_of, ts,
            wh.read("dim_service_request", current=True)))
        steps = {"idx_session_days": lambda prev: inc.step_idx_session_days(prev, raw.raw_events, as_of),
                 "idx_payment_days": lambda prev: inc.step_idx_payment_days(prev, raw.raw_payments, as_of)}
        days = {}
        for name in indexes_for(tables):
            if wh.exists(name):
                wh.apply(name, steps[name](wh.read(name)))
            else:  # a warehouse from before the index
                wh.write_full(name, index_of(name, raw))
            days[name] = wh.read(name)
        run("fct_booking_events", lambda prev: inc.step_fct_booking_events(
            raw.raw_events, as_of, ts, days["idx_session_days"]))
        run("fct_session_events", lambda prev: inc.step_fct_session_events(
            raw.raw_events, raw.raw_sessions, now["dim_session"], as_of, ts, days["idx_session_days"]))
        run("fct_booking_funnel", lambda prev: inc.step_fct_booking_funnel(
            inc.booked_requests(sr, now["fct_booking_events"], changed["fct_booking_events"]), now, changed["fct_booking_events"], changed["dim_service_request"],
            changed["dim_session"], as_of, ts))
        run("fct_revenue", lambda prev: inc.step_fct_revenue(
            raw.raw_payments, sr, now, as_of, ts, days["idx_payment_days"]))
