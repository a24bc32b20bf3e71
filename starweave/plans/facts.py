"""Fact jobs M7-M11 (full-build form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (date_key, flag, is_in_flag, field_text, notnull_flag, seconds_between,
                         surrogate_key, hash_key, ts_text)
from ..operators import first_per_group, lookup_join, sequence_within_group
from ..schemas import assert_columns

# Event types and page types named by the models.
EVENT_TYPES = ["booking_started", "booking_submitted", "pro_viewed"]
PAGE_FLAGS = {"home": "is_home_page", "search": "is_search_page",
              "booking_form": "is_booking_form_page", "confirmation": "is_confirmation_page"}


def booking_submissions(raw_events: DataFrame) -> DataFrame:
    """booking_submitted events carrying an sr_id (filter reaches the scan)."""
    sr_id = field_text(raw_events, "properties", "sr_id")
    return (raw_events.filter(F.col("event_type") == "booking_submitted")
            .select("event_id", "session_id", "event_ts", sr_id.alias("sr_id"))
            .filter(F.col("sr_id").isNotNull()))


def booking_event_rows(first: DataFrame, run_ts) -> DataFrame:
    out = first.select(
        surrogate_key("session_id", "sr_id").alias("booking_event_key"),
        "session_id", "sr_id",
        F.col("event_ts").alias("first_booking_ts"),
        date_key("event_ts").alias("event_date"),
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "fct_booking_events")


def fct_booking_events(raw_events: DataFrame, run_ts) -> DataFrame:
    """First booking_submitted per session, ties broken by event_id.

    A min-aggregate per session (map-side partial), so a hot session is
    reduced before the shuffle."""
    first = first_per_group(booking_submissions(raw_events), ["session_id"],
                            ["event_ts", "event_id"])
    return booking_event_rows(first, run_ts)


def session_event_source(raw_events: DataFrame) -> DataFrame:
    return raw_events.select("event_id", "session_id", "event_type", "event_ts",
                             field_text(raw_events, "properties", "sr_id").alias("properties_sr_id"))


def session_totals() -> dict:
    """Counts and first/last timestamps of a session."""
    et = F.col("event_type")
    return {
        "session_event_count": ("sum", F.lit(1)),
        "session_booking_started_count": ("sum", flag(et == "booking_started")),
        "session_booking_submitted_count": ("sum", flag(et == "booking_submitted")),
        "session_pro_viewed_count": ("sum", flag(et == "pro_viewed")),
        "session_has_booking_submitted": ("max", flag(et == "booking_submitted")),
        "_first_ts": ("min", F.col("event_ts")),
        "_last_ts": ("max", F.col("event_ts")),
    }


SESSION_COUNTS = ["session_event_count", "session_booking_started_count",
                  "session_booking_submitted_count", "session_pro_viewed_count",
                  "session_has_booking_submitted"]


def fct_session_events(raw_events: DataFrame, dim_session: DataFrame, run_ts) -> DataFrame:
    """Every event with session context, ordinal, gap to the previous event and
    session counts. Counts and the session row are attached per slice of a
    session, so a hot session stays spread. Events without a session are
    numbered as one group and have no counts."""
    sess = dim_session.select(
        "session_id", "session_key",
        F.col("started_at").alias("session_started_at"),
        F.col("ended_at").alias("session_ended_at"),
        "session_duration_sec", "page_type", "is_clean_end")
    j = sequence_within_group(session_event_source(raw_events), "session_id",
                              ["event_ts", "event_id"], "event_sequence_number", "_prev_ts",
                              session_totals(), sess)
    j = j.withColumns({c: F.when(F.col("session_id").isNotNull(), F.col(c)) for c in SESSION_COUNTS})
    et, pt = F.col("event_type"), F.col("page_type")
    out = j.select(
        surrogate_key("event_id", "session_id", ts_text("event_ts")).alias("event_key"),
        "event_id",
        F.coalesce(F.col("session_key"), F.col("session_id")).alias("session_key"),
        "event_type", "event_ts",
        F.to_date("event_ts").alias("event_date_key"),
        "properties_sr_id",
        "session_started_at", "session_ended_at", "session_duration_sec", "is_clean_end",
        "session_event_count",
        flag(F.col("session_event_count") == 1).alias("is_bounce_session"),
        seconds_between("session_started_at", "event_ts").alias("seconds_since_session_start"),
        "page_type",
        *[flag(pt == v).alias(name) for v, name in PAGE_FLAGS.items()],
        "event_sequence_number",
        flag(F.col("event_ts") == F.col("_first_ts")).alias("is_first_event_in_session"),
        flag(F.col("event_ts") == F.col("_last_ts")).alias("is_last_event_in_session"),
        seconds_between("_prev_ts", "event_ts").alias("seconds_since_prev_event"),
        notnull_flag("properties_sr_id").alias("has_sr_id"),
        flag(et == "booking_started").alias("is_booking_started"),
        flag(et == "booking_submitted").alias("is_booking_submitted"),
        flag(et == "pro_viewed").alias("is_pro_viewed"),
        "session_booking_started_count", "session_booking_submitted_count",
        "session_pro_viewed_count", "session_has_booking_submitted",
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "fct_session_events")


def sr_flags(service_requests: DataFrame, dim_category: DataFrame,
             dim_geography: DataFrame) -> DataFrame:
    """Service requests with dimension keys resolved."""
    sr = lookup_join(service_requests, dim_category.select("category", "category_key"), "category")
    return lookup_join(sr, dim_geography.select("geography", "geography_key"), "geography")


def current_pros(dim_pro: DataFrame) -> DataFrame:
    return (dim_pro.filter(F.col("is_current"))
            .select("sp_id", "category_key", "pro_key", "market", "is_active"))


def pro_versions_now(dim_pro: DataFrame) -> DataFrame:
    """Current pros by the time their version began, which their key is a hash of."""
    return dim_pro.filter(F.col("is_current")).select(
        "sp_id", "category_key", F.col("valid_from").alias("pro_version"), F.lit(True).alias("has_pro"), "market", "is_active")


def first_booking_per_sr(fct_booking_events: DataFrame) -> DataFrame:
    """One booking event per SR: the earliest (then smallest session_id)."""
    return first_per_group(fct_booking_events.select("sr_id", "first_booking_ts", "session_id"),
                           ["sr_id"], ["first_booking_ts", "session_id"])


def funnel_rows(sr: DataFrame, dsr_current: DataFrame, bookings: DataFrame,
                dim_session: DataFrame, pros: DataFrame, run_ts) -> DataFrame:
    j = (sr.join(bookings, "sr_id", "inner")
         .join(dsr_current.select("sr_id", "service_request_key"), "sr_id", "left")
         .join(dim_session.select("session_id", "session_key",
                                  F.col("started_at").alias("session_started_at")),
               "session_id", "left")
         .join(pros, ["sp_id", "category_key"], "left"))
    st = F.col("status")
    out = j.select(
        F.col("sr_id").alias("booking_key"), "sr_id",
        F.coalesce(F.col("session_key"), F.lit("unknown")).alias("session_key"),
        "service_request_key", "sp_id", "pro_key",
        date_key("created_at").alias("created_at_date_key"),
        "geography_key", "category_key", "session_started_at", "first_booking_ts",
        flag(st == "completed").alias("is_converted"),
        flag(st == "cancelled").alias("is_cancelled"),
        is_in_flag(st, ["matched", "completed"]).alias("is_matched"),
        "market", F.col("is_active").alias("pro_is_active"),
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "fct_booking_funnel")


def fct_booking_funnel(service_requests: DataFrame, dim_category: DataFrame,
                       dim_geography: DataFrame, dim_service_request: DataFrame,
                       fct_booking_events: DataFrame, dim_session: DataFrame,
                       dim_pro: DataFrame, run_ts) -> DataFrame:
    """One row per SR that has a booking event; current SR version and pro."""
    sr = sr_flags(service_requests.select("sr_id", "created_at", "status", "sp_id", "category",
                                          "geography"), dim_category, dim_geography)
    return funnel_rows(sr, dim_service_request.filter(F.col("is_current")),
                       first_booking_per_sr(fct_booking_events), dim_session,
                       current_pros(dim_pro), run_ts)


def _signed(amount: str):
    st = F.col("payment_status")
    return (F.when(st == "completed", F.col(amount))
            .when(st.isin("refunded", "chargeback"), -1 * F.col(amount))
            .otherwise(F.lit(0))).cast("decimal(14,2)")


def sr_context(service_requests: DataFrame, dim_category: DataFrame, dim_geography: DataFrame,
               pros: DataFrame) -> DataFrame:
    """SR-grain attributes a payment needs: dimension keys and current pro. Resolved
    once per SR, so the large payment table is shuffled only once (by sr_id) instead
    of again by (sp_id, category_key)."""
    sr = sr_flags(service_requests.select("sr_id", "sp_id", "category", "geography"),
                  dim_category, dim_geography)
    return sr.join(pros, ["sp_id", "category_key"], "left").drop("geography")


def revenue_rows(pay: DataFrame, ctx: DataFrame, dsr_current: DataFrame, run_ts) -> DataFrame:
    """Payments with their SR's context and current version, in the form in which the
    fact is shuffled and stored: of each version the time it began, and what the
    fact's other columns are made of. A version's key is a hash of that time and its
    natural key: 64 characters that don't compress, made last (``revenue_fact``)."""
    srd = dsr_current.select("sr_id", F.col("valid_from").alias("sr_version"), F.lit(True).alias("has_sr_version"),
                             F.col("status").alias("sr_status"), F.col("is_completed").alias("_sr_completed"))
    j = pay.join(ctx, "sr_id", "inner").join(srd, "sr_id", "left")
    return j.select(
        "payment_id", "sr_id", "sr_version", "has_sr_version", "sp_id", "pro_version", "has_pro",
        date_key("payment_ts").alias("payment_date_key"),
        "category", "category_key", "geography_key", "payment_ts", "payment_method", "payment_status",
        "gross_amount", "commission_rate", "commission_amount", "pro_payout_amount",
        "sr_status", F.coalesce(F.col("_sr_completed"), F.lit(False)).alias("sr_is_completed"),
        "market", F.col("is_active").alias("pro_is_active"),
        F.lit(run_ts).alias("dw_updated_at"),
    )


def revenue_fact(rows: DataFrame) -> DataFrame:
    """The fact, of the rows that ``revenue_rows`` makes: keys hashed, flags and net
    amounts told from the status."""
    st = F.col("payment_status")
    out = rows.select(
        hash_key("payment_id").alias("revenue_key"),
        "payment_id", "sr_id",
        F.when(F.col("has_sr_version"), surrogate_key("sr_id", ts_text("sr_version"))).alias("service_request_key"),
        "sp_id",
        F.when(F.col("has_pro"), surrogate_key("sp_id", "category", ts_text("pro_version"))).alias("pro_key"),
        "payment_date_key", "category_key", "geography_key", "payment_ts", "payment_method", "payment_status",
        "gross_amount", "commission_rate",
        F.col("commission_amount").alias("platform_commission"),
        "pro_payout_amount",
        flag(st == "completed").alias("is_settled"),
        flag(st == "refunded").alias("is_refunded"),
        flag(st == "chargeback").alias("is_chargeback"),
        flag(st == "pending").alias("is_pending"),
        _signed("commission_amount").alias("net_platform_revenue"),
        _signed("pro_payout_amount").alias("net_pro_payout"),
        "sr_status", "sr_is_completed", "market", "pro_is_active", "dw_updated_at",
    )
    return assert_columns(out, "fct_revenue")


def stored_revenue(raw_payments: DataFrame, service_requests: DataFrame, dim_category: DataFrame,
                   dim_geography: DataFrame, dim_service_request: DataFrame, dim_pro: DataFrame,
                   run_ts) -> DataFrame:
    """One row per payment: payment inner SR, SR-grain lookups resolved first; in the
    form that ``revenue_fact`` finishes."""
    pay = raw_payments.select("payment_id", "sr_id", "payment_ts", "payment_method",
                              "payment_status", "gross_amount", "commission_rate",
                              "commission_amount", "pro_payout_amount")
    ctx = sr_context(service_requests, dim_category, dim_geography, pro_versions_now(dim_pro))
    return revenue_rows(pay, ctx, dim_service_request.filter(F.col("is_current")), run_ts)


def fct_revenue(*sources) -> DataFrame:
    return revenue_fact(stored_revenue(*sources))


def session_funnel(raw_events: DataFrame, raw_sessions: DataFrame,
                   service_requests: DataFrame, raw_pro_profiles: DataFrame) -> DataFrame:
    """Session-grain funnel of the ad-hoc query (M11), without materialising
    its fan-out.

    The ad-hoc query joins pro profiles on sp_id alone and so repeats each
    session once per profile row of its pro. Emitting those pairs is
    exactly the defect the query exposes; here the multiplicity is reported
    as ``pro_profile_rows`` (rows the naive join would emit for the session)
    from a per-sp_id count, so the result stays at session grain.
    """
    sub = raw_events.filter(F.col("event_type") == "booking_submitted")
    be = sub.groupBy("session_id").agg(
        F.min("event_ts").alias("first_booking_ts"),
        F.min(field_text(raw_events, "properties", "sr_id")).alias("sr_id"))
    sr = service_requests.select("sr_id", "status", "category", "geography", "sp_id")
    per_sp = raw_pro_profiles.groupBy("sp_id").agg(F.count(F.lit(1)).alias("_n_profiles"))
    j = (raw_sessions.select("session_id", "started_at")
         .join(be, "session_id", "left")
         .join(sr, "sr_id", "left")
         .join(per_sp, "sp_id", "left"))
    return j.select(
        "session_id", "sr_id", "started_at", "first_booking_ts", "status", "category",
        "geography",
        F.when(F.col("status") == "completed", 1).otherwise(0).alias("is_converted"),
        F.coalesce(F.col("_n_profiles"), F.lit(0)).alias("pro_profile_rows"),
        F.greatest(F.coalesce(F.col("_n_profiles"), F.lit(0)), F.lit(1)).cast("bigint")
        .alias("naive_row_multiplicity"),
    )
