"""Dimension jobs M1-M6 (full-build form).

Each function takes already-scanned inputs and returns a lazy DataFrame with
the declared column order (``schemas.MODEL_COLUMNS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bool_flag, hash_key, seconds_between, surrogate_key, ts_text
from ..operators import latest_per_key, lookup_join
from ..schemas import assert_columns
from ..sources.calendar import CALENDAR_END, CALENDAR_START, date_spine

CALENDAR_ROWS = (CALENDAR_END - CALENDAR_START).days  # proven bound for broadcasts


def _null(t: str):
    return F.lit(None).cast(t)


def dim_date(spark: SparkSession, run_ts) -> DataFrame:
    d = F.col("date_day")
    dow_iso = F.weekday(d) + 1  # Monday=1 .. Sunday=7
    out = date_spine(spark).select(
        F.date_format(d, "yyyyMMdd").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayname(d).alias("day_of_week"),
        dow_iso.alias("day_of_week_num"),
        bool_flag(dow_iso.isin(6, 7)).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        _null("smallint").alias("fiscal_year"),
        _null("smallint").alias("fiscal_quarter"),
        _null("string").alias("fiscal_period"),
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "dim_date")


def category_members(service_requests: DataFrame) -> DataFrame:
    return service_requests.filter(F.col("category").isNotNull()).select("category").distinct()


def geography_members(service_requests: DataFrame) -> DataFrame:
    return service_requests.filter(F.col("geography").isNotNull()).select("geography").distinct()


def dim_category_rows(members: DataFrame, run_ts) -> DataFrame:
    out = members.select(
        hash_key("category").alias("category_key"),
        "category",
        _null("string").alias("vertical"),
        F.lit(False).alias("is_seasonal"),
        _null("decimal(12,2)").alias("avg_ticket_usd"),
        _null("boolean").alias("license_required"),
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "dim_category")


def dim_geography_rows(members: DataFrame, run_ts) -> DataFrame:
    s = "string"
    out = members.select(
        hash_key("geography").alias("geography_key"),
        "geography",
        _null(s).alias("city"), _null(s).alias("state"), _null(s).alias("state_code"),
        _null(s).alias("region"), _null(s).alias("market_tier"), _null(s).alias("dma_code"),
        _null(s).alias("dma_name"),
        _null("decimal(9,6)").alias("latitude"), _null("decimal(9,6)").alias("longitude"),
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "dim_geography")


def dim_category(service_requests: DataFrame, run_ts) -> DataFrame:
    return dim_category_rows(category_members(service_requests), run_ts)


def dim_geography(service_requests: DataFrame, run_ts) -> DataFrame:
    return dim_geography_rows(geography_members(service_requests), run_ts)


def dim_session(raw_sessions: DataFrame, run_ts) -> DataFrame:
    out = raw_sessions.select(
        F.col("session_id").alias("session_key"),
        "session_id", "started_at", "ended_at",
        seconds_between("started_at", "ended_at").alias("session_duration_sec"),
        "page_type",
        F.col("ended_at").isNotNull().alias("is_clean_end"),
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "dim_session")


def pro_versions(profiles: DataFrame) -> DataFrame:
    """Latest profile per (sp_id, category) with first/last activity over all
    profiles of the sp_id.

    Both steps are aggregations: (sp_id, category) is reduced map-side first,
    then a window over sp_id only sees one row per category of that pro.
    """
    latest = profiles.groupBy("sp_id", "category").agg(
        F.max(F.struct("updated_at", "market", "is_active")).alias("_v"),
        F.min("updated_at").alias("_min_ts"), F.max("updated_at").alias("_max_ts"))
    from pyspark.sql import Window
    w = Window.partitionBy("sp_id")
    return latest.select(
        "sp_id", "category",
        F.col("_v.updated_at").alias("updated_at"),
        F.col("_v.market").alias("market"),
        F.col("_v.is_active").alias("is_active"),
        F.min("_min_ts").over(w).alias("first_active_at"),
        F.max("_max_ts").over(w).alias("last_active_at"))


def pro_rows(v: DataFrame, run_ts) -> DataFrame:
    out = v.select(
        surrogate_key("sp_id", "category", ts_text("updated_at")).alias("pro_key"),
        "sp_id",
        hash_key("category").alias("category_key"),
        "market", "is_active", "first_active_at", "last_active_at",
        _null("string").alias("tier"),
        _null("decimal(3,2)").alias("rating"),
        _null("int").alias("review_count"),
        F.col("updated_at").alias("valid_from"),
        _null("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "dim_pro")


def dim_pro(profiles: DataFrame, run_ts) -> DataFrame:
    return pro_rows(pro_versions(profiles), run_ts)


def service_request_rows(service_requests: DataFrame, dim_category: DataFrame,
                         dim_geography: DataFrame, run_ts) -> DataFrame:
    sr = lookup_join(service_requests, dim_category.select("category", "category_key"), "category")
    sr = lookup_join(sr, dim_geography.select("geography", "geography_key"), "geography")
    out = sr.select(
        surrogate_key("sr_id", ts_text("updated_at")).alias("service_request_key"),
        "sr_id", "created_at", "status", "sp_id", "category_key", "geography_key",
        bool_flag(F.col("status") == "completed").alias("is_completed"),
        bool_flag(F.col("status") == "cancelled").alias("is_cancelled"),
        _null("string").alias("homeowner_key"),
        F.col("updated_at").alias("valid_from"),
        _null("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(run_ts).alias("dw_updated_at"),
    )
    return assert_columns(out, "dim_service_request")


def dim_service_request(service_requests: DataFrame, dim_category: DataFrame,
                        dim_geography: DataFrame, run_ts) -> DataFrame:
    return service_request_rows(service_requests, dim_category, dim_geography, run_ts)
