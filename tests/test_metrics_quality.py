from decimal import Decimal as D

import pytest

from starweave.plans import metrics, quality
from starweave.plans.build import Models
from starweave.plans.catalog import FIXED_RUN_TS
from starweave.sources import testdata_sources
from tests.conftest import SF_SMALL, raw_frames, ts


@pytest.fixture(scope="module")
def small(spark):
    return Models(spark, testdata_sources(spark, SF_SMALL), FIXED_RUN_TS)


def test_conversion_rate_matches_expected_numbers(small):
    r = metrics.booking_conversion_rate(small["fct_booking_funnel"]).first()
    assert (r.converted_bookings, r.total_bookings) == (49, 144)
    assert abs(r.booking_conversion_rate - 0.340278) < 1e-6


def test_revenue_matches_expected_numbers(small):
    r = metrics.revenue_metrics(small["fct_revenue"]).first()
    assert r.gross_revenue == D("148438949.37")
    assert r.net_platform_revenue == D("17997742.69") and r.net_pro_payout == D("69109876.05")
    assert (r.refunded_payments, r.settled_or_refunded_payments) == (523, 2769)


def test_session_metrics(small):
    se = small["fct_session_events"]
    b = metrics.bounce_rate(se).first()
    assert (b.bounce_sessions, b.total_sessions) == (99, 397)  # over all events, errors too (FIXTURES)
    assert metrics.sessions_with_conversion(se).first()[0] <= 397


def test_unsafe_dimensions_raise(small):
    with pytest.raises(metrics.UnsafeDimensionError):
        metrics.booking_conversion_rate(small["fct_booking_funnel"], ["pro_key"])
    with pytest.raises(metrics.UnsafeDimensionError):
        metrics.revenue_metrics(small["fct_revenue"], ["market"])
    with pytest.raises(metrics.UnsafeDimensionError):
        metrics.booking_conversion_rate(small["fct_booking_funnel"], ["session_key"])


def test_dq_breaks_one_failure_per_kind_and_severity(spark):
    raw = raw_frames(spark,
                     raw_events=[("e1", "s1", "pro_viewed", ts("2024-01-10 10:00:00"), "{}"),
                                 ("e1", "s1", "bogus", None, "{}")],
                     raw_payments=[("p1", "sr_1", ts("2024-01-10 10:00:00"), "ach", "lost",
                                    D("1.00"), D("0.2000"), D("0.20"), D("0.80"), None)],
                     service_requests=[("sr_1", ts("2040-01-10 10:00:00"), "completed", "hvac",
                                        "boston", "sp_1", ts("2040-01-10 10:00:00"))])
    m = Models(spark, raw, FIXED_RUN_TS)
    tables = {n: raw.table(n) for n in ["raw_events", "raw_payments"]}
    for n in ["fct_session_events", "fct_revenue", "dim_date"]:
        tables[n] = m[n]
    res = {r.test_name: r for r in quality.run_checks(tables).collect()}
    assert res["raw_events__event_id__unique"].n_failed == 1
    assert res["raw_events__event_ts__not_null"].n_failed == 1
    assert res["raw_payments__payment_status__accepted_values"].n_failed == 1
    assert res["fct_session_events__event_type__accepted_values"].severity == "warn"
    assert res["fct_session_events__event_type__accepted_values"].n_failed == 1
    assert res["fct_revenue__payment_date_key__relationships"].n_failed == 0
    with pytest.raises(AssertionError, match="raw_events__event_id__unique"):
        quality.raise_on_errors(quality.run_checks(tables))


def test_relationship_outside_calendar_fails(spark):
    raw = raw_frames(spark, raw_payments=[("p1", "sr_1", ts("2040-01-10 10:00:00"), "ach",
                                           "completed", D("1.00"), D("0.2000"), D("0.20"),
                                           D("0.80"), None)],
                     service_requests=[("sr_1", ts("2024-01-10 10:00:00"), "completed", "hvac",
                                        "boston", "sp_1", ts("2024-01-10 10:00:00"))])
    m = Models(spark, raw, FIXED_RUN_TS)
    res = {r.test_name: r.n_failed for r in quality.run_checks(
        {"fct_revenue": m["fct_revenue"], "dim_date": m["dim_date"]},
        kinds=("relationships",)).collect()}
    assert res == {"fct_revenue__payment_date_key__relationships": 1}


def test_guardrails_hold_on_test_data(small):
    g = {r.guardrail: r.n_rows for r in
         quality.guardrails(small["fct_booking_funnel"], small["fct_revenue"], small["fct_booking_events"]).collect()}
    assert g["funnel_booking_key_unique"] == 0 and g["revenue_key_unique"] == 0
    assert g["completed_net_split_equals_gross"] == 0


def test_converted_row_without_booking_event_is_reported(small):
    none = small["fct_booking_events"].limit(0)
    g = {r.guardrail: r.n_rows for r in
         quality.guardrails(small["fct_booking_funnel"], small["fct_revenue"], none).collect()}
    assert g["converted_subset_of_bookings"] == small["fct_booking_funnel"].filter("is_converted = 1").count() > 0


def test_failed_error_check_ends_a_run_and_warnings_do_not(small):
    revenue = small["fct_revenue"]
    quality.check_table("fct_revenue", revenue, small["dim_date"])
    with pytest.raises(AssertionError, match="revenue_key"):
        quality.check_table("fct_revenue", revenue.unionByName(revenue), small["dim_date"])
    events = small["fct_session_events"]
    assert events.filter("event_type = 'error'").count() > 0  # outside the accepted values: a warning
    quality.check_table("fct_session_events", events, small["dim_date"])


def test_naive_session_funnel_reports_reference_fan_out(small):
    from pyspark.sql import functions as F
    naive = small["session_funnel"]
    assert naive.count() == 345  # one row per session
    assert naive.agg(F.sum("naive_row_multiplicity")).first()[0] == 39575
    funnel = small["fct_booking_funnel"]
    assert funnel.filter("session_key = 'unknown'").count() == 16
    assert funnel.filter("pro_key is not null").count() == 143
