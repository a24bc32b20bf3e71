"""Registry of named queries over the driver's test tables.

Every query derives the raw sources from ``<sf_dir>`` with the adapter and
runs the engine's plans over the whole tables; the audit column
``dw_updated_at`` (run timestamp) is dropped from outputs.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir, released_cuts
from ..sources.raw import landed
from ..sources.testdata import testdata_sources
from . import metrics, quality
from .incremental import written
from .build import BUILD_ORDER, Models
from .warehouse import Warehouse

FIXED_RUN_TS = _dt.datetime(2024, 1, 31, 6, 0, 0)
SOURCE_KEYS = ["raw_events", "raw_sessions", "service_requests", "raw_pro_profiles",
               "raw_payments"]

METRIC_OF = {"booking_funnel": ("fct_booking_funnel", metrics.booking_conversion_rate),
             "revenue": ("fct_revenue", metrics.revenue_metrics)}
FRESH_WARN_HOURS, FRESH_ERROR_HOURS = 12, 24 * 365
# Derived sources that the builds of a fact and its dimensions read again and again; events
# are a projection of their table.
LANDED = {"fct_session_events": ["raw_sessions"],
          "fct_booking_funnel": ["raw_sessions", "service_requests", "raw_pro_profiles"],
          "fct_revenue": ["service_requests", "raw_pro_profiles", "raw_payments"]}
DELIVERY_DAYS = [_dt.date(2024, 1, 11), _dt.date(2024, 1, 21)]
WINDOW = (_dt.date(2020, 6, 1), _dt.date(2020, 6, 14))  # a fortnight within the given orders

Query = Callable[[SparkSession, str], DataFrame]


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(spark, testdata_sources(spark, sf_dir), run_ts=FIXED_RUN_TS)


def _audit_free(df: DataFrame) -> DataFrame:
    return df.drop("dw_updated_at")


def _source(name: str) -> Query:
    return lambda spark, d: testdata_sources(spark, d).table(name)


def _model(name: str) -> Query:
    return lambda spark, d: _audit_free(models(spark, d)[name])


def _on(model: str, fn, *args, **kw) -> Query:
    def run(spark, d):
        m = models(spark, d)
        return fn(m[model], *args, **kw)
    return run


def _conv(dims=(), calendar=False) -> Query:
    def run(spark, d):
        m = models(spark, d)
        return metrics.booking_conversion_rate(m["fct_booking_funnel"], list(dims),
                                               m["dim_date"] if calendar else None)
    return run


def _rev(dims=(), calendar=False, cols=None) -> Query:
    def run(spark, d):
        m = models(spark, d)
        out = metrics.revenue_metrics(m["fct_revenue"], list(dims),
                                      m["dim_date"] if calendar else None)
        return out.select(*cols) if cols else out
    return run


def _tables_for_checks(m: Models, raw) -> dict[str, DataFrame]:
    t = {n: raw.table(n) for n in SOURCE_KEYS}
    for n in ["fct_booking_events", "fct_session_events", "fct_booking_funnel", "fct_revenue",
              "dim_date"]:
        t[n] = m[n]
    return t


def _dq(kind: str) -> Query:
    def run(spark, d):
        raw = testdata_sources(spark, d)
        m = Models(spark, raw, run_ts=FIXED_RUN_TS)
        return quality.run_checks(_tables_for_checks(m, raw), kinds=(kind,))
    return run


def _freshness(spark, d):
    raw = testdata_sources(spark, d)
    return quality.freshness({n: raw.table(n) for n in SOURCE_KEYS})


def _guardrails(spark, d):
    m = models(spark, d)
    return quality.guardrails(m["fct_booking_funnel"], m["fct_revenue"], m["fct_booking_events"])


def _fan_out(spark, d):
    raw = testdata_sources(spark, d)
    m = Models(spark, raw, run_ts=FIXED_RUN_TS)
    cur_dsr = m["dim_service_request"].filter(F.col("is_current"))
    cur_pro = m["dim_pro"].filter(F.col("is_current"))
    return quality.fan_out_report({
        "dim_category.category": (m["dim_category"], ["category"]),
        "dim_geography.geography": (m["dim_geography"], ["geography"]),
        "dim_service_request.current.sr_id": (cur_dsr, ["sr_id"]),
        "dim_pro.current.sp_id_category_key": (cur_pro, ["sp_id", "category_key"]),
        "dim_session.session_id": (m["dim_session"], ["session_id"]),
        "fct_booking_events.sr_id": (m["fct_booking_events"], ["sr_id"]),
        "raw_pro_profiles.sp_id": (raw.raw_pro_profiles, ["sp_id"]),
    })


REPLAYS = {
    "upsert_sessions": "dim_session",
    "insert_new_categories": "dim_category",
    "scd2_service_request": "dim_service_request",
    "scd2_pro": "dim_pro",
    "lookback_bookings": "fct_booking_events",
    "incremental_session_events": "fct_session_events",
    "incremental_funnel": "fct_booking_funnel",
    "incremental_revenue": "fct_revenue",
}


def _replay(model: str) -> Query:
    from . import incremental

    def run(spark, d):
        raw = landed(testdata_sources(spark, d), LANDED.get(model, ()))
        out = incremental.replay(spark, raw, model, run_ts=FIXED_RUN_TS)
        return _audit_free(out)
    return run


def _nightly(fact: str, nights: str) -> Query:
    """A full build and the nights after it, in a warehouse of its own, over
    rows that arrive late or are corrected; ends as the full build does."""
    def run(spark, d):
        from ..sources import arrivals
        from .run import NEEDED, build_full_to_warehouse, build_incremental
        wh, days = _new_warehouse(spark, "nightly"), getattr(arrivals, nights)
        with released_cuts(spark):
            raw = landed(testdata_sources(spark, d), LANDED[fact])
            views = [arrivals.late_arrivals(raw, day) for day in [*days, None]]
            build_full_to_warehouse(spark, views[0], wh, FIXED_RUN_TS, NEEDED[fact])
            for as_of, view in zip(days, views[1:], strict=True):
                build_incremental(spark, view, wh, as_of, FIXED_RUN_TS, NEEDED[fact])
        return _audit_free(wh.read(fact))
    return run


def _freshness_age(spark, d):
    raw = testdata_sources(spark, d)
    return quality.freshness_age({n: raw.table(n) for n in SOURCE_KEYS}, FIXED_RUN_TS, FRESH_WARN_HOURS, FRESH_ERROR_HOURS)


def _deliveries(report: bool) -> Query:
    """All events in three deliveries, then two that must be held back: bookings
    without an id, and events that come again as another type. The landed events,
    or the report of all five."""
    def run(spark, d):
        from ..sources import deliveries
        store, events = _new_warehouse(spark, "landed"), testdata_sources(spark, d).raw_events
        sent = deliveries.deliveries_of(events, "event_ts", DELIVERY_DAYS)
        booked = events.filter("event_type = 'booking_submitted'")
        sent += [booked.withColumn("event_id", F.lit(None).cast("string")), booked.withColumn("event_type", F.lit("pro_viewed"))]
        reports = [deliveries.land_delivery(store, "raw_events", batch, f"delivery {i}") for i, batch in enumerate(sent)]
        return reduce(DataFrame.unionByName, reports) if report else store.read("raw_events")
    return run


def _rebuilt(spark, d):
    """Two full builds at two run times, fact by fact: rows, rows in which they
    differ, and whether every audit time is its run's (K6, F23)."""
    from .run import build_full_to_warehouse
    wh = _new_warehouse(spark, "rebuilt")
    times, seen = [FIXED_RUN_TS, FIXED_RUN_TS + _dt.timedelta(days=1)], []
    with released_cuts(spark):
        raw = landed(testdata_sources(spark, d), dict.fromkeys(n for names in LANDED.values() for n in names))
        for ts in times:
            build_full_to_warehouse(spark, raw, wh, ts)
            seen.append({n: wh.read(n) for n in BUILD_ORDER if n.startswith("fct_")})  # of this version
    return reduce(DataFrame.unionByName, [
        _builds_compared(*(s[n] for s in seen), *times).select(F.lit(n).alias("model"), "n_rows", "rows_differing", "audit_time_moved")
        for n in seen[0]])


DIGEST_BUCKETS, WORDS = 1024, 8  # a SHA-256 is eight words of 32 bits


def _builds_compared(one: DataFrame, two: DataFrame, first: _dt.datetime, second: _dt.datetime) -> DataFrame:
    """Rows of the second build, rows that only one of them has (as often as it has
    them more), and whether their audit times are ``first`` and ``second``.

    A row stands for its content's SHA-256. The rows of both builds are dealt into
    buckets by it, and a bucket's digest is the sum of each word of its rows' hashes,
    so equal bags of rows have equal digests, whatever the order of the rows. Only rows
    of buckets whose digests differ meet one by one: 32 bytes of each are shuffled, once."""
    def side(df, build, ts):
        content = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in _audit_free(one).columns]))
        return df.select(F.sha2(content, 256).alias("row"), F.lit(build).alias("build"),
                         (F.col("dw_updated_at") == F.lit(ts).cast("timestamp_ntz")).alias("stamped"))

    def word(i):
        return F.conv(F.substring("row", 8 * i + 1, 8), 16, 10).cast("long")

    rows = side(one, -1, first).unionByName(side(two, 1, second)).withColumn("bucket", word(0) % DIGEST_BUCKETS)
    buckets = rows.groupBy("bucket").agg(
        F.count_if(F.col("build") == 1).alias("n"), F.sum("build").alias("surplus"), F.bool_and("stamped").alias("stamped"),
        *[F.sum(F.col("build") * word(i)).alias(f"word{i}") for i in range(WORDS)])
    buckets = cut_lineage(buckets, DIGEST_BUCKETS)
    differing = buckets.filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in ("surplus", *(f"word{i}" for i in range(WORDS)))]))
    odd = rows.join(F.broadcast(differing.select("bucket")), "bucket", "left_semi").groupBy(F.unhex("row").alias("row")).agg(
        F.sum("build").alias("surplus")).select(F.lit(0).alias("n"), F.abs("surplus").alias("odd"), F.lit(True).alias("stamped"))
    found = buckets.select("n", F.lit(0).alias("odd"), "stamped").unionByName(odd)
    none = F.lit(0).cast("long")
    return found.agg(F.coalesce(F.sum("n"), none).alias("n_rows"), F.coalesce(F.sum("odd"), none).alias("rows_differing"),
                     F.coalesce(F.bool_and("stamped"), F.lit(True)).alias("audit_time_moved"))


def _metric_dimensions(spark, d):
    """Every column of every fact as a grouping dimension of its metrics: refused,
    or the number of its groups (G5, G6)."""
    m = models(spark, d)
    parts = []
    for family, (model, metric) in METRIC_OF.items():
        whole, read = _audit_free(m[model]), {*metrics.SAFE_DIMS[family], *metrics.MEASURES[family]}
        fact = cut_lineage(whole.select(*[c for c in whole.columns if c in read]))  # read once per column
        for column in whole.columns:  # by name; a refused one is never read
            try:
                n = metric(fact, [column]).agg(F.count(F.lit(1)).alias("n_groups"))
            except metrics.UnsafeDimensionError:
                n = fact.agg(F.lit(None).cast("long").alias("n_groups"))
            parts.append(n.select(F.lit(family).alias("metric_family"), F.lit(column).alias("dimension"),
                                  F.col("n_groups").isNull().alias("refused"), "n_groups"))
    return reduce(DataFrame.unionByName, parts)


class Killed(RuntimeError):
    """Stands for a run that dies."""


def _new_warehouse(spark, kind: str) -> Warehouse:
    return Warehouse(spark, os.path.join(ensure_checkpoint_dir(spark), kind, uuid.uuid4().hex))


def _readers_keep_published(spark, d):
    """The revenue fact as another reader finds it after a published build, a
    nightly run that dies when all its tables are written, and one whose payments
    fail their checks: still the published rows."""
    from ..sources import arrivals
    from .run import NEEDED, build_full_to_warehouse, build_incremental
    tables, night = NEEDED["fct_revenue"], arrivals.PAYMENT_NIGHTS[-1]
    wh = _new_warehouse(spark, "published")
    with released_cuts(spark):
        raw = landed(testdata_sources(spark, d), LANDED["fct_revenue"])
        build_full_to_warehouse(spark, raw, wh, FIXED_RUN_TS, tables)
        nights = {Killed: arrivals.late_arrivals(raw, night), AssertionError: arrivals.bad_payments(raw, night)}
        for failure, view in nights.items():
            try:
                with wh.transaction():
                    build_incremental(spark, view, wh, night, FIXED_RUN_TS, tables)
                    raise Killed("all tables written, none published")
            except failure:
                continue
            raise RuntimeError(f"the run should have ended by {failure}")
    return _audit_free(Warehouse(spark, wh.root).read("fct_revenue"))


def _windowed(fact: str, metric, since: _dt.date, until: _dt.date, dims) -> Query:
    """A metric over some days, from the files of a written fact that hold them."""
    def run(spark, d):
        wh = _new_warehouse(spark, "windowed")
        with released_cuts(spark):  # requests, which five steps read, and the small lookups written once
            m = Models(spark, landed(testdata_sources(spark, d), ["service_requests"]), run_ts=FIXED_RUN_TS)
            written(m, "dim_category", "dim_geography")
            wh.write_full(fact, *m.stored(fact))
        return metric(wh.read(fact, since=since, until=until), list(dims))
    return run


def _hot_session_events(spark, d):
    from ..sources.arrivals import hot_sessions
    raw = hot_sessions(testdata_sources(spark, d))
    return _audit_free(Models(spark, raw, run_ts=FIXED_RUN_TS)["fct_session_events"])


def _parsed_sources(spark, d):
    """Sources whose events, of mixed properties, have landed parsed."""
    from ..sources.arrivals import mixed_properties
    from ..sources.properties import parsed_events
    from ..sources.raw import RawSources
    raw = mixed_properties(testdata_sources(spark, d))
    events = cut_lineage(parsed_events(raw.raw_events))
    return RawSources(lambda name: events if name == "raw_events" else raw.table(name))


def _parsed_properties(spark, d):
    return _parsed_sources(spark, d).raw_events.select(
        "event_id", "properties_sr_id", "properties_malformed", F.col("properties").isNotNull().alias("is_json"))


def _properties_report(spark, d):
    from ..sources.properties import properties_report
    return properties_report(_parsed_sources(spark, d).raw_events)


def _parsed_model(name: str) -> Query:
    return lambda spark, d: _audit_free(Models(spark, _parsed_sources(spark, d), run_ts=FIXED_RUN_TS)[name])


def _stream_session_events(spark, d):
    from ..streaming.events import run_to_completion
    m = models(spark, d)
    return _audit_free(run_to_completion(spark, d, m["dim_session"], FIXED_RUN_TS))


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for n in SOURCE_KEYS:
        q[n] = _source(n)
    for n in BUILD_ORDER:
        q[n] = _model(n)
    q["session_funnel_naive"] = lambda spark, d: models(spark, d)["session_funnel"]
    q["booking_conversion_rate"] = _conv()
    q["conversion_by_category"] = _conv(["category_key"])
    q["conversion_by_geography"] = _conv(["geography_key"])
    q["conversion_by_month"] = _conv(["year", "month"], calendar=True)
    q["conversion_by_weekend"] = _conv(["is_weekend"], calendar=True)
    q["conversion_by_week"] = _conv(["week_start"], calendar=True)
    q["conversion_by_calendar"] = _conv(["quarter", "month_name", "week", "day_of_week",
                                         "day_of_week_num"], calendar=True)
    q["conversion_among_matched"] = _conv(["is_matched"])
    q["cancellation_rate"] = _on("fct_booking_funnel", metrics.cancellation_rate)
    q["session_to_booking_rate"] = _on("fct_session_events", metrics.session_to_booking_rate)
    q["revenue_summary"] = _rev()
    q["gross_revenue"] = _rev(cols=["gross_revenue"])
    q["net_platform_revenue"] = _rev(cols=["net_platform_revenue"])
    q["net_pro_payout"] = _rev(cols=["net_pro_payout"])
    q["effective_take_rate"] = _rev(cols=["effective_take_rate"])
    q["refund_rate"] = _rev(cols=["refunded_payments", "settled_or_refunded_payments",
                                  "refund_rate"])
    q["revenue_by_category"] = _rev(["category_key"])
    q["revenue_by_month"] = _rev(["year", "month"], calendar=True)
    q["revenue_by_method"] = _rev(["payment_method"])
    q["revenue_by_sr_status"] = _rev(["sr_status"])
    q["revenue_by_geography"] = _rev(["geography_key"])
    q["revenue_by_status"] = _rev(["payment_status"])
    for name in ["bounce_rate", "avg_session_depth", "avg_session_duration",
                 "events_by_entry_page", "booking_rate_by_entry_page",
                 "avg_seconds_between_events", "funnel_drop_off", "sessions_with_conversion"]:
        q[name] = _on("fct_session_events", getattr(metrics, name))
    for kind in ["unique", "not_null", "accepted_values", "relationships"]:
        q[f"dq_{kind}"] = _dq(kind)
    q["dq_freshness"] = _freshness
    q["dq_freshness_age"] = _freshness_age
    q["landed_events"] = _deliveries(report=False)
    q["delivery_report"] = _deliveries(report=True)
    q["rebuilt_facts"] = _rebuilt
    q["metric_dimensions"] = _metric_dimensions
    q["guardrail_report"] = _guardrails
    q["fan_out_report"] = _fan_out
    for key, model in REPLAYS.items():
        q[key] = _replay(model)
    q["readers_keep_published"] = _readers_keep_published
    q["conversion_in_window"] = _windowed("fct_booking_funnel", metrics.booking_conversion_rate, *WINDOW, ["category_key"])
    q["revenue_in_window"] = _windowed("fct_revenue", metrics.revenue_metrics, *WINDOW, ["payment_method"])
    q["fct_session_events_hot"] = _hot_session_events
    q["parsed_properties"] = _parsed_properties
    q["properties_report"] = _properties_report
    q["fct_session_events_parsed"] = _parsed_model("fct_session_events")
    q["fct_booking_events_parsed"] = _parsed_model("fct_booking_events")
    q["stream_session_events"] = _stream_session_events
    q["nightly_funnel"] = _nightly("fct_booking_funnel", "EVENT_NIGHTS")
    q["nightly_sessions"] = _nightly("fct_session_events", "EVENT_NIGHTS")
    q["nightly_revenue"] = _nightly("fct_revenue", "PAYMENT_NIGHTS")
    return q
