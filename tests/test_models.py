"""Hand-made edge fixtures (FIXTURES.md part 3) through the model plans."""

from decimal import Decimal as D

from starweave.plans.build import Models
from tests.conftest import RUN_TS, raw_frames, ts

T0 = "2024-01-10 10:00:00"


def _models(spark, **t):
    return Models(spark, raw_frames(spark, **t), RUN_TS)


def test_tied_events_sequence_by_event_id_and_both_flagged(spark):
    m = _models(spark, raw_events=[
        ("e2", "s1", "pro_viewed", ts(T0), "{}"), ("e1", "s1", "booking_started", ts(T0), "{}"),
        ("e3", "s1", "booking_submitted", ts("2024-01-10 10:00:00.900"), '{"sr_id": "sr_9"}')],
        raw_sessions=[("s1", ts("2024-01-10 09:59:59.500"), None, "home", ts(T0))])
    rows = {r.event_id: r for r in m["fct_session_events"].collect()}
    assert [rows[e].event_sequence_number for e in ("e1", "e2", "e3")] == [1, 2, 3]
    assert rows["e1"].is_first_event_in_session == rows["e2"].is_first_event_in_session == 1
    assert rows["e2"].seconds_since_prev_event == 0 and rows["e1"].seconds_since_prev_event is None
    assert rows["e3"].session_event_count == 3 and rows["e3"].session_has_booking_submitted == 1
    assert rows["e1"].seconds_since_session_start == 1  # 09:59:59.5 -> 10:00:00
    # open_session: no ended_at -> duration null, not a clean end
    assert rows["e1"].session_duration_sec is None and rows["e1"].is_clean_end is False
    assert rows["e1"].is_home_page == 1 and rows["e3"].has_sr_id == 1


def test_orphan_event_keeps_raw_session_id(spark):
    m = _models(spark, raw_events=[("e1", "ghost", "pro_viewed", ts(T0), "{}")])
    r = m["fct_session_events"].first()
    assert r.session_key == "ghost" and r.page_type is None and r.is_home_page == 0


def test_two_bookings_one_session_keeps_chronological_first(spark):
    m = _models(spark, raw_events=[
        ("e1", "s1", "booking_submitted", ts("2024-01-10 10:05:00"), '{"sr_id": "sr_a"}'),
        ("e2", "s1", "booking_submitted", ts("2024-01-10 10:01:00"), '{"sr_id": "sr_z"}'),
        ("e3", "s1", "booking_submitted", ts("2024-01-10 10:00:00"), '{"sr_id": null}')])
    rows = m["fct_booking_events"].collect()
    assert [(r.session_id, r.sr_id, r.event_date) for r in rows] == [("s1", "sr_z", "20240110")]


def test_one_sr_two_sessions_one_funnel_row_and_unknown_session(spark):
    m = _models(spark, raw_events=[
        ("e1", "s1", "booking_submitted", ts("2024-01-10 10:00:00"), '{"sr_id": "sr_1"}'),
        ("e2", "s2", "booking_submitted", ts("2024-01-11 10:00:00"), '{"sr_id": "sr_1"}')],
        service_requests=[("sr_1", ts("2024-01-10 10:00:00"), "completed", "plumbing", "boston",
                           "sp_1", ts("2024-01-12 00:00:00"))])
    rows = m["fct_booking_funnel"].collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.first_booking_ts == ts("2024-01-10 10:00:00") and r.session_key == "unknown"
    assert (r.is_converted, r.is_cancelled, r.is_matched) == (1, 0, 1)


def test_pro_two_categories_no_fan_out_and_multi_profile_latest(spark):
    profiles = [("sp_1", "boston", "plumbing", True, ts("2024-01-01 00:00:00")),
                ("sp_1", "boston", "plumbing", False, ts("2024-01-05 00:00:00")),
                ("sp_1", "boston", "hvac", True, ts("2023-12-01 00:00:00"))]
    m = _models(spark, raw_pro_profiles=profiles, raw_events=[
        ("e1", "s1", "booking_submitted", ts(T0), '{"sr_id": "sr_1"}')],
        service_requests=[("sr_1", ts(T0), "matched", "plumbing", "boston", "sp_1", ts(T0))])
    pros = {r.category_key[:6]: r for r in m["dim_pro"].collect()}
    assert len(pros) == 2
    for r in pros.values():  # activity spans all profiles of the pro
        assert r.first_active_at == ts("2023-12-01 00:00:00")
        assert r.last_active_at == ts("2024-01-05 00:00:00")
    funnel = m["fct_booking_funnel"].collect()
    assert len(funnel) == 1 and funnel[0].pro_is_active is False
    naive = m["session_funnel"].collect()
    assert naive == [] or all(r.pro_profile_rows in (0, 3) for r in naive)


def test_null_category_excluded_from_dimension(spark):
    m = _models(spark, service_requests=[
        ("sr_1", ts(T0), "submitted", None, "boston", None, ts(T0)),
        ("sr_2", ts(T0), "submitted", "hvac", None, None, ts(T0))])
    assert [r.category for r in m["dim_category"].collect()] == ["hvac"]
    rows = {r.sr_id: r for r in m["dim_service_request"].collect()}
    assert rows["sr_1"].category_key is None and rows["sr_2"].geography_key is None


def test_payment_signs_and_decimal_cents(spark):
    sr = [("sr_1", ts(T0), "completed", "hvac", "boston", "sp_1", ts(T0))]

    def pay(pid, status):
        return (pid, "sr_1", ts(T0), "ach", status, D("100.00"), D("0.2000"), D("20.00"),
                D("80.00"), ts(T0))

    m = _models(spark, service_requests=sr, raw_payments=[
        pay("p1", "completed"), pay("p2", "refunded"), pay("p3", "pending"),
        pay("p4", "chargeback"), pay("p5", "failed")])
    rows = {r.payment_id: r for r in m["fct_revenue"].collect()}
    assert rows["p1"].net_platform_revenue == D("20.00") and rows["p1"].net_pro_payout == D("80.00")
    assert rows["p2"].net_platform_revenue == D("-20.00")
    assert rows["p4"].net_pro_payout == D("-80.00")
    assert rows["p3"].net_platform_revenue == 0 and rows["p5"].net_pro_payout == 0
    assert rows["p1"].sr_is_completed is True and rows["p1"].payment_date_key == "20240110"


def test_calendar_edges(spark):
    m = _models(spark)
    cal = {r.date_key: r for r in m["dim_date"].collect()}
    assert len(cal) == 5843 and "20351231" not in cal
    assert cal["20200229"].month_name == "Feb" and cal["20210103"].week == 53
    assert cal["20240107"].day_of_week == "Sun" and cal["20240107"].day_of_week_num == 7
    assert cal["20240107"].is_weekend and not cal["20240108"].is_weekend
