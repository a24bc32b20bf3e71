"""Named metrics (Q1-Q19) with guarded grouping dimensions.

Each metric reads exactly one fact (numerator and denominator from the same
rows) and groups only by dimensions that cannot fan out its grain. Ratios
divide with ``try_divide`` so an empty group gives null, and are rounded to
9 decimals.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .dims import CALENDAR_ROWS

RATIO_DIGITS = 9
DATE_ATTRS = ["full_date", "year", "quarter", "month", "month_name", "week", "day_of_week",
              "day_of_week_num", "is_weekend", "is_holiday"]
WEEK_START = "week_start"  # Monday of the ISO week; (year, week) is ambiguous at year ends

# Grouping dimensions documented as safe for each metric family.
SAFE_DIMS = {
    "booking_funnel": ["category_key", "geography_key", "created_at_date_key", "is_matched"],
    "revenue": ["category_key", "geography_key", "payment_date_key", "payment_method",
                "payment_status", "sr_status"],
    "session_events": ["page_type", "event_date_key", "event_type", "is_home_page",
                       "is_search_page", "is_booking_form_page", "is_confirmation_page"],
}
# The columns whose values the metrics over every dimension (``METRIC_OF``) reckon with.
MEASURES = {
    "booking_funnel": ["booking_key", "is_converted"],
    "revenue": ["payment_status", "gross_amount", "net_platform_revenue", "net_pro_payout", "is_settled", "is_refunded"],
}
DATE_KEY_OF = {"booking_funnel": "created_at_date_key", "revenue": "payment_date_key"}


class UnsafeDimensionError(ValueError):
    pass


def ratio(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), RATIO_DIGITS)


def _grouped(fact: DataFrame, family: str, dims: Sequence[str], dim_date: DataFrame | None):
    dims = list(dims)
    allowed = set(SAFE_DIMS[family]) | ({*DATE_ATTRS, WEEK_START} if family in DATE_KEY_OF else set())
    bad = [d for d in dims if d not in allowed]
    if bad:
        raise UnsafeDimensionError(f"{family}: grouping by {bad} can fan out the metric grain; "
                                   f"safe dimensions are {sorted(allowed)}")
    if any(d in (*DATE_ATTRS, WEEK_START) for d in dims):
        if dim_date is None:
            raise ValueError("calendar attributes need dim_date")
        cal = dim_date.select(F.col("date_key").alias(DATE_KEY_OF[family]), *DATE_ATTRS,
                              F.trunc("full_date", "week").alias(WEEK_START))
        # the calendar has a fixed row count, so broadcasting it is bounded
        fact = lookup_join(fact, cal, DATE_KEY_OF[family], "left", broadcast_rows=CALENDAR_ROWS)
    return fact.groupBy(*dims) if dims else fact.groupBy()


def booking_conversion_rate(funnel: DataFrame, dims: Sequence[str] = (),
                            dim_date: DataFrame | None = None) -> DataFrame:
    """COUNT(DISTINCT booking_key WHERE is_converted = 1) / COUNT(DISTINCT booking_key)."""
    g = _grouped(funnel, "booking_funnel", dims, dim_date)
    conv = F.count_distinct(F.when(F.col("is_converted") == 1, F.col("booking_key")))
    tot = F.count_distinct("booking_key")
    return g.agg(conv.alias("converted_bookings"), tot.alias("total_bookings"),
                 ratio(conv, tot).alias("booking_conversion_rate"))


def cancellation_rate(funnel: DataFrame, dims: Sequence[str] = (),
                      dim_date: DataFrame | None = None) -> DataFrame:
    """SUM(is_cancelled) / COUNT(DISTINCT booking_key); not 1 - conversion."""
    g = _grouped(funnel, "booking_funnel", dims, dim_date)
    canc = F.sum("is_cancelled").cast("bigint")
    tot = F.count_distinct("booking_key")
    return g.agg(canc.alias("cancelled_bookings"), tot.alias("total_bookings"),
                 ratio(canc, tot).alias("cancellation_rate"))


def session_to_booking_rate(session_events: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Sessions with a submitted booking / all sessions (fct_session_events)."""
    g = _grouped(session_events, "session_events", dims, None)
    num = F.count_distinct(F.when(F.col("session_has_booking_submitted") == 1,
                                  F.col("session_key")))
    den = F.count_distinct("session_key")
    return g.agg(num.alias("sessions_with_booking"), den.alias("total_sessions"),
                 ratio(num, den).alias("session_to_booking_rate"))


def revenue_metrics(revenue: DataFrame, dims: Sequence[str] = (),
                    dim_date: DataFrame | None = None) -> DataFrame:
    """gross_revenue, net_platform_revenue, net_pro_payout, effective_take_rate,
    refund_rate over fct_revenue."""
    g = _grouped(revenue, "revenue", dims, dim_date)
    st = F.col("payment_status")
    gross = F.sum(F.when(st == "completed", F.col("gross_amount")))
    net = F.sum("net_platform_revenue")
    refunded = F.count_if(F.col("is_refunded") == 1)
    settled_or_ref = F.count_if((F.col("is_settled") == 1) | (F.col("is_refunded") == 1))
    return g.agg(
        gross.cast("decimal(24,2)").alias("gross_revenue"),
        net.cast("decimal(24,2)").alias("net_platform_revenue"),
        F.sum("net_pro_payout").cast("decimal(24,2)").alias("net_pro_payout"),
        ratio(net, gross).alias("effective_take_rate"),
        refunded.alias("refunded_payments"),
        settled_or_ref.alias("settled_or_refunded_payments"),
        ratio(refunded, settled_or_ref).alias("refund_rate"),
    )


def _first_events(se: DataFrame) -> Column:
    return F.col("is_first_event_in_session") == 1


def bounce_rate(se: DataFrame) -> DataFrame:
    num = F.sum(F.col("is_bounce_session") * F.col("is_first_event_in_session")).cast("bigint")
    den = F.count_distinct("session_key")
    return se.agg(num.alias("bounce_sessions"), den.alias("total_sessions"),
                  ratio(num, den).alias("bounce_rate"))


def avg_session_depth(se: DataFrame) -> DataFrame:
    v = F.avg(F.when(_first_events(se), F.col("session_event_count")))
    return se.agg(F.round(v, RATIO_DIGITS).alias("avg_session_depth"))


def avg_session_duration(se: DataFrame) -> DataFrame:
    v = F.avg(F.when(_first_events(se), F.col("session_duration_sec")))
    return se.agg(F.round(v, RATIO_DIGITS).alias("avg_session_duration_sec"))


def events_by_entry_page(se: DataFrame) -> DataFrame:
    return se.groupBy("page_type").agg(F.count(F.lit(1)).alias("n_events"))


def booking_rate_by_entry_page(se: DataFrame) -> DataFrame:
    num = F.sum("is_booking_submitted").cast("bigint")
    den = F.count_distinct("session_key")
    return se.groupBy("page_type").agg(num.alias("booking_submitted_events"),
                                       den.alias("sessions"),
                                       ratio(num, den).alias("booking_rate"))


def avg_seconds_between_events(se: DataFrame) -> DataFrame:
    v = F.avg(F.when(F.col("event_sequence_number") > 1, F.col("seconds_since_prev_event")))
    return se.agg(F.round(v, RATIO_DIGITS).alias("avg_seconds_between_events"))


def funnel_drop_off(se: DataFrame) -> DataFrame:
    started = F.sum("is_booking_started").cast("bigint")
    submitted = F.sum("is_booking_submitted").cast("bigint")
    return se.agg(started.alias("booking_started"), submitted.alias("booking_submitted"),
                  (started - submitted).alias("drop_off"),
                  ratio(submitted, started).alias("submit_per_start"))


def sessions_with_conversion(se: DataFrame) -> DataFrame:
    v = F.count_distinct(F.when(F.col("session_has_booking_submitted") == 1,
                                F.col("session_key")))
    return se.agg(v.alias("sessions_with_conversion"))
