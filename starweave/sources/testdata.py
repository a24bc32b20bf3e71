"""Adapter from the driver's TPC-H-like tables to the five raw sources.

Deterministic rules (see FIXTURES.md part 2); every rule is a column
expression, so the adapter is itself a distributed plan: filters and
projections fuse into the scans, the session build is one aggregation on
the session id, and the SR/payment/profile derivations are joins and
partial aggregations on order and supplier keys.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .raw import RawSources

# Fixed values of the derivation rules.
YEARS_SHIFT = 25  # moves 1992-1998 order dates into the calendar range
EVENT_TYPE_MAP = {"signup": "booking_started", "purchase": "booking_submitted",
                  "view": "pro_viewed", "click": "pro_viewed", "error": "error"}
PAGE_TYPES = ["home", "search", "booking_form", "confirmation"]          # by min(event_id) % 4
PAYMENT_METHODS = ["credit_card", "debit_card", "ach", "digital_wallet"]  # by l_linenumber % 4


def _shift_years(c):
    return c + F.expr(f"INTERVAL {YEARS_SHIFT} YEARS")


def _plus_days(c, n):
    return c + F.make_dt_interval(n.cast("int"))


def _pick(index_col, values):
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(index_col == i, F.lit(v)) if expr is None
                else expr.when(index_col == i, F.lit(v)))
    return expr


def raw_events(events: DataFrame) -> DataFrame:
    mapped = None
    for src, dst in EVENT_TYPE_MAP.items():
        mapped = (F.when(F.col("event_type") == src, F.lit(dst)) if mapped is None
                  else mapped.when(F.col("event_type") == src, F.lit(dst)))
    has_sr = (F.col("event_type") == "purchase") & (F.col("event_id") % 10 != 0)
    return events.select(
        F.concat(F.lit("evt_"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat(F.lit("session_"), F.col("user_id").cast("string"), F.lit("_"),
                 F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        mapped.alias("event_type"),
        F.col("ts").alias("event_ts"),
        F.when(has_sr, F.concat(F.lit('{"sr_id": "sr_'), F.col("event_id").cast("string"),
                                F.lit('"}'))).otherwise(F.lit("{}")).alias("properties"),
        F.col("ts").alias("_loaded_at"),
        F.lit("events").alias("_source_file"),
    )


def raw_sessions(events: DataFrame) -> DataFrame:
    e = events.filter(F.col("user_id") % 11 != 0).select(
        F.concat(F.lit("session_"), F.col("user_id").cast("string"), F.lit("_"),
                 F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        "ts", "event_id")
    g = e.groupBy("session_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("max_ts"),
                                    F.max("event_id").alias("max_id"),
                                    F.min("event_id").alias("min_id"))
    return g.select(
        "session_id", "started_at",
        F.when(F.col("max_id") % 5 != 0, F.col("max_ts")).alias("ended_at"),
        _pick(F.col("min_id") % 4, PAGE_TYPES).alias("page_type"),
        F.col("max_ts").alias("updated_at"),
        F.col("max_ts").alias("_loaded_at"),
        F.lit("events").alias("_source_file"),
    )


def service_requests(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                     lineitem: DataFrame) -> DataFrame:
    first_supp = lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("min_supp"))
    o = (orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
         .join(customer.select("c_custkey", "c_nationkey", "c_mktsegment"),
               F.col("o_custkey") == F.col("c_custkey"))
         .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(first_supp, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    created = _shift_years(F.col("o_orderdate"))
    status = (F.when(F.col("o_orderstatus") == "F", "completed")
              .when(F.col("o_orderstatus") == "P", "matched")
              .when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 4 == 0), "cancelled")
              .when(F.col("o_orderstatus") == "O", "submitted"))
    updated = _plus_days(created, F.col("o_orderkey") % 4)
    return o.select(
        F.concat(F.lit("sr_"), F.col("o_orderkey").cast("string")).alias("sr_id"),
        created.alias("created_at"),
        status.alias("status"),
        F.lower("c_mktsegment").alias("category"),
        F.lower("n_name").alias("geography"),
        F.concat(F.lit("sp_"), F.col("min_supp").cast("string")).alias("sp_id"),
        updated.alias("updated_at"),
        updated.alias("_loaded_at"),
        F.lit("orders").alias("_source_file"),
    )


def raw_pro_profiles(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                     supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """A profile row per supplier, category and month of its order lines. Lines are made
    distinct on the numbers and the category that these come from, and the supplier's
    columns, texts and further columns follow, so that few bytes are shuffled."""
    lines = (lineitem.select("l_orderkey", "l_suppkey", F.trunc(F.to_date("l_shipdate"), "MM").alias("month"))
             .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(customer.select("c_custkey", F.lower("c_mktsegment").alias("category")),
                   F.col("o_custkey") == F.col("c_custkey"))
             .select("l_suppkey", "category", "month").distinct())
    markets = (supplier.select("s_suppkey", "s_nationkey")
               .join(nation.select("n_nationkey", F.lower("n_name").alias("market")), F.col("s_nationkey") == F.col("n_nationkey"))
               .select("s_suppkey", "market").distinct())
    return lines.join(markets, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("sp_"), F.col("l_suppkey").cast("string")).alias("sp_id"),
        "market", "category",
        ((F.col("l_suppkey") + F.month("month")) % 7 != 0).alias("is_active"),
        _shift_years(F.col("month").cast("timestamp_ntz")).alias("updated_at"),
        _shift_years(F.col("month").cast("timestamp_ntz")).alias("_loaded_at"),
        F.lit("lineitem").alias("_source_file"))


def _flag_rank(c):
    """Return flags as numbers in text order, those between the known ones alike:
    the largest rank tells the largest flag, and a number's maximum is kept in a hash
    aggregate, a text's only in one that sorts all rows."""
    rank = F.when(c < "A", 0)
    for i, (known, after) in enumerate([("A", "N"), ("N", "R"), ("R", None)]):
        rank = rank.when(c == known, 2 * i + 1).when(c < after if after else c.isNotNull(), 2 * i + 2)
    return rank


FLAG_A, FLAG_N, FLAG_R = 1, 3, 5


def raw_payments(lineitem: DataFrame) -> DataFrame:
    """One payment per order line. The lines are shuffled once, by the ``sr_id``
    that payments are joined on, and that partitioning outlives the grouping."""
    sr_id = F.concat(F.lit("sr_"), F.col("l_orderkey").cast("string"))
    lines = lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", _flag_rank(F.col("l_returnflag")).alias("rank"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"))
    g = lines.repartition(sr_id).withColumn("sr_id", sr_id).groupBy("sr_id", "l_orderkey", "l_linenumber").agg(
        F.max("l_shipdate").alias("ship"),
        F.max("rank").alias("flag"),
        F.sum("price").alias("gross"),
        F.max("discount").alias("disc"))
    ln = F.col("l_linenumber")
    status = (F.when(F.col("flag") == FLAG_A, "completed")
              .when((F.col("flag") == FLAG_R) & (ln == 7), "chargeback")
              .when((F.col("flag") == FLAG_R) & (ln <= 2), "refunded")
              .when(F.col("flag") == FLAG_R, "completed")
              .when((F.col("flag") == FLAG_N) & (ln == 6), "failed")
              .when(F.col("flag") == FLAG_N, "pending"))
    gross = F.col("gross").cast("decimal(14,2)")
    rate = (F.lit(0.15).cast("decimal(4,2)") + F.col("disc")).cast("decimal(6,4)")
    commission = F.round(gross * rate, 2).cast("decimal(14,2)")
    pay_ts = _shift_years(F.col("ship"))
    updated = _plus_days(pay_ts, F.col("l_orderkey") % 3)
    return g.select(
        F.concat(F.lit("pay_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 ln.cast("string")).alias("payment_id"),
        "sr_id",
        pay_ts.alias("payment_ts"),
        _pick(ln % 4, PAYMENT_METHODS).alias("payment_method"),
        status.alias("payment_status"),
        gross.alias("gross_amount"),
        rate.alias("commission_rate"),
        commission.alias("commission_amount"),
        (gross - commission).cast("decimal(14,2)").alias("pro_payout_amount"),
        updated.alias("updated_at"),
        updated.alias("_loaded_at"),
        F.lit("lineitem").alias("_source_file"),
    )


def testdata_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    """RawSources whose tables are derived from ``<sf_dir>/<table>.parquet``."""

    def t(name):
        return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))

    builders = {
        "raw_events": lambda: raw_events(t("events")),
        "raw_sessions": lambda: raw_sessions(t("events")),
        "service_requests": lambda: service_requests(t("orders"), t("customer"), t("nation"),
                                                     t("lineitem")),
        "raw_pro_profiles": lambda: raw_pro_profiles(t("lineitem"), t("orders"), t("customer"),
                                                     t("supplier"), t("nation")),
        "raw_payments": lambda: raw_payments(t("lineitem")),
    }
    return RawSources(lambda n: builders[n]())
