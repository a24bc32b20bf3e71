"""Declared schemas of the raw sources (the landing contract).

Model outputs are asserted against the column lists in ``MODEL_COLUMNS``.
"""

from pyspark.sql.types import (BooleanType, DecimalType, StringType, StructField,
                               StructType, TimestampNTZType)

S, TS, B = StringType(), TimestampNTZType(), BooleanType()
MONEY = DecimalType(14, 2)
RATE = DecimalType(6, 4)


def _struct(*cols):
    return StructType([StructField(n, t, True) for n, t in cols]
                      + [StructField("_loaded_at", TS, True), StructField("_source_file", S, True)])


RAW_SCHEMAS = {
    "raw_events": _struct(("event_id", S), ("session_id", S), ("event_type", S),
                          ("event_ts", TS), ("properties", S)),
    "raw_sessions": _struct(("session_id", S), ("started_at", TS), ("ended_at", TS),
                            ("page_type", S), ("updated_at", TS)),
    "service_requests": _struct(("sr_id", S), ("created_at", TS), ("status", S), ("category", S),
                                ("geography", S), ("sp_id", S), ("updated_at", TS)),
    "raw_pro_profiles": _struct(("sp_id", S), ("market", S), ("category", S), ("is_active", B),
                                ("updated_at", TS)),
    "raw_payments": _struct(("payment_id", S), ("sr_id", S), ("payment_ts", TS),
                            ("payment_method", S), ("payment_status", S),
                            ("gross_amount", MONEY), ("commission_rate", RATE),
                            ("commission_amount", MONEY), ("pro_payout_amount", MONEY),
                            ("updated_at", TS)),
}

# Output column order of every model (dw_updated_at last).
MODEL_COLUMNS = {
    "dim_date": ["date_key", "full_date", "year", "quarter", "month", "month_name", "week",
                 "day_of_week", "day_of_week_num", "is_weekend", "is_holiday", "fiscal_year",
                 "fiscal_quarter", "fiscal_period", "dw_updated_at"],
    "dim_category": ["category_key", "category", "vertical", "is_seasonal", "avg_ticket_usd",
                     "license_required", "dw_updated_at"],
    "dim_geography": ["geography_key", "geography", "city", "state", "state_code", "region",
                      "market_tier", "dma_code", "dma_name", "latitude", "longitude",
                      "dw_updated_at"],
    "dim_session": ["session_key", "session_id", "started_at", "ended_at",
                    "session_duration_sec", "page_type", "is_clean_end", "dw_updated_at"],
    "dim_pro": ["pro_key", "sp_id", "category_key", "market", "is_active", "first_active_at",
                "last_active_at", "tier", "rating", "review_count", "valid_from", "valid_to",
                "is_current", "dw_updated_at"],
    "dim_service_request": ["service_request_key", "sr_id", "created_at", "status", "sp_id",
                            "category_key", "geography_key", "is_completed", "is_cancelled",
                            "homeowner_key", "valid_from", "valid_to", "is_current",
                            "dw_updated_at"],
    "fct_booking_events": ["booking_event_key", "session_id", "sr_id", "first_booking_ts",
                           "event_date", "dw_updated_at"],
    "fct_session_events": [
        "event_key", "event_id", "session_key", "event_type", "event_ts", "event_date_key",
        "properties_sr_id", "session_started_at", "session_ended_at", "session_duration_sec",
        "is_clean_end", "session_event_count", "is_bounce_session",
        "seconds_since_session_start", "page_type", "is_home_page", "is_search_page",
        "is_booking_form_page", "is_confirmation_page", "event_sequence_number",
        "is_first_event_in_session", "is_last_event_in_session", "seconds_since_prev_event",
        "has_sr_id", "is_booking_started", "is_booking_submitted", "is_pro_viewed",
        "session_booking_started_count", "session_booking_submitted_count",
        "session_pro_viewed_count", "session_has_booking_submitted", "dw_updated_at"],
    "fct_booking_funnel": ["booking_key", "sr_id", "session_key", "service_request_key", "sp_id",
                           "pro_key", "created_at_date_key", "geography_key", "category_key",
                           "session_started_at", "first_booking_ts", "is_converted",
                           "is_cancelled", "is_matched", "market", "pro_is_active",
                           "dw_updated_at"],
    "fct_revenue": ["revenue_key", "payment_id", "sr_id", "service_request_key", "sp_id",
                    "pro_key", "payment_date_key", "category_key", "geography_key", "payment_ts",
                    "payment_method", "payment_status", "gross_amount", "commission_rate",
                    "platform_commission", "pro_payout_amount", "is_settled", "is_refunded",
                    "is_chargeback", "is_pending", "net_platform_revenue", "net_pro_payout",
                    "sr_status", "sr_is_completed", "market", "pro_is_active", "dw_updated_at"],
}


def assert_columns(df, model: str):
    want = MODEL_COLUMNS[model]
    got = df.columns
    if got != want:
        raise AssertionError(f"{model}: columns {got} != declared {want}")
    return df
