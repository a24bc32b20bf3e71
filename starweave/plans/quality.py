"""Data-quality checks (DQ1-DQ6) and metric guardrails.

Checks are declared as data and run as one aggregate per table and kind:
all not-null and accepted-value checks on a table share one scan; each
unique check is one grouped count; relationships are anti joins against the
(bounded) calendar. Results are DataFrames ``[test_name, model, column_name,
test_type, severity, n_failed]``; ``raise_on_errors`` fails only for
severity ``error``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ntz_literal
from ..operators.joins import duplicate_keys, may_repeat

# The declared tests of the sources and facts.
PAYMENT_STATUSES = ["pending", "completed", "refunded", "failed", "chargeback"]
EVENT_TYPES = ["booking_started", "booking_submitted", "pro_viewed"]


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str                      # unique | not_null | accepted_values | relationships
    severity: str = "error"
    values: tuple = ()
    to: tuple = ()                 # (model, column) for relationships

    @property
    def name(self) -> str:
        return f"{self.model}__{self.column}__{self.kind}"


def _u(m, c, sev="error"):
    return Check(m, c, "unique", sev)


def _n(m, c, sev="error"):
    return Check(m, c, "not_null", sev)


SOURCE_CHECKS = [
    _u("raw_events", "event_id"), _n("raw_events", "event_id"), _n("raw_events", "event_ts"),
    _u("raw_sessions", "session_id"), _n("raw_sessions", "session_id"),
    _n("raw_sessions", "started_at"),
    _u("service_requests", "sr_id"), _n("service_requests", "sr_id"),
    _n("service_requests", "created_at"),
    _n("raw_pro_profiles", "sp_id"), _n("raw_pro_profiles", "is_active"),
    _u("raw_payments", "payment_id"), _n("raw_payments", "payment_id"),
    _n("raw_payments", "sr_id"), _n("raw_payments", "payment_ts"),
    _n("raw_payments", "payment_status"),
    Check("raw_payments", "payment_status", "accepted_values", values=tuple(PAYMENT_STATUSES)),
    _n("raw_payments", "gross_amount"), _n("raw_payments", "commission_rate"),
]

FACT_CHECKS = [
    _u("fct_booking_events", "booking_event_key"), _n("fct_booking_events", "booking_event_key"),
    _u("fct_booking_events", "session_id"), _n("fct_booking_events", "session_id"),
    _n("fct_booking_events", "sr_id"), _n("fct_booking_events", "first_booking_ts"),
    _n("fct_booking_events", "event_date"),
    Check("fct_booking_events", "event_date", "relationships", to=("dim_date", "date_key")),
    _n("fct_booking_events", "dw_updated_at"),
    _u("fct_session_events", "event_key"), _n("fct_session_events", "event_key"),
    _n("fct_session_events", "event_id"), _n("fct_session_events", "event_type"),
    Check("fct_session_events", "event_type", "accepted_values", "warn", tuple(EVENT_TYPES)),
    _n("fct_session_events", "event_ts"), _n("fct_session_events", "dw_updated_at"),
    _u("fct_booking_funnel", "booking_key"), _n("fct_booking_funnel", "booking_key"),
    _u("fct_revenue", "revenue_key"), _n("fct_revenue", "revenue_key"),
    _u("fct_revenue", "payment_id"), _n("fct_revenue", "payment_id"),
    _n("fct_revenue", "sr_id"), _n("fct_revenue", "payment_date_key"),
    Check("fct_revenue", "payment_date_key", "relationships", to=("dim_date", "date_key")),
    _n("fct_revenue", "gross_amount"), _n("fct_revenue", "commission_rate"),
    _n("fct_revenue", "payment_status"),
    Check("fct_revenue", "payment_status", "accepted_values", values=tuple(PAYMENT_STATUSES)),
    _n("fct_revenue", "dw_updated_at"),
]

ALL_CHECKS = SOURCE_CHECKS + FACT_CHECKS


def _row(chk: Check, n) -> list:
    return [F.lit(chk.name).alias("test_name"), F.lit(chk.model).alias("model"),
            F.lit(chk.column).alias("column_name"), F.lit(chk.kind).alias("test_type"),
            F.lit(chk.severity).alias("severity"), n.cast("bigint").alias("n_failed")]


def _unpivot(wide: DataFrame, structs: list) -> DataFrame:
    """Turn one aggregated row into one row per struct, from a single scan."""
    return wide.select(F.inline(F.array(*structs)))


def _scan_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """not_null checks (null rows) of one table in a single aggregation,
    unpivoted to rows."""
    wide = df.agg(*[F.count_if(F.col(c.column).isNull()).alias(f"c{i}") for i, c in enumerate(checks)])
    return _unpivot(wide, [F.struct(*_row(c, F.col(f"c{i}"))) for i, c in enumerate(checks)])


def _values_check(df: DataFrame, c: Check) -> DataFrame:
    """Distinct values outside the accepted ones (nulls pass)."""
    seen = df.filter(~F.col(c.column).isin(list(c.values))).select(c.column).distinct()
    return seen.agg(F.count(F.lit(1)).alias("n")).select(*_row(c, F.col("n")))


def _unique_check(df: DataFrame, c: Check) -> DataFrame:
    n = duplicate_keys(df.select(c.column), [c.column]).agg(F.count(F.lit(1)).alias("n"))
    return n.select(*_row(c, F.col("n")))


def _relationship_check(df: DataFrame, parent: DataFrame, c: Check) -> DataFrame:
    pcol = c.to[1]
    keys = parent.select(F.col(pcol).alias(c.column)).distinct()
    if c.to[0] == "dim_date":  # fixed size
        keys = F.broadcast(keys)
    orphans = df.select(c.column).filter(F.col(c.column).isNotNull()).join(keys, c.column, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("n")).select(*_row(c, F.col("n")))


def run_checks(tables: dict[str, DataFrame], kinds=("unique", "not_null", "accepted_values",
                                                    "relationships"),
               checks: list[Check] = ALL_CHECKS) -> DataFrame:
    """Evaluate declared checks on the given tables (models absent are skipped)."""
    parts = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in kinds and c.model in tables:
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        df = tables[model]
        scan = [c for c in cs if c.kind == "not_null"]
        if scan:
            parts.append(_scan_checks(df, scan))
        for c in cs:
            if c.kind == "unique":
                parts.append(_unique_check(df, c))
            elif c.kind == "accepted_values":
                parts.append(_values_check(df, c))
            elif c.kind == "relationships" and c.to[0] in tables:
                parts.append(_relationship_check(df, tables[c.to[0]], c))
    return reduce(DataFrame.unionByName, parts)


def check_table(name: str, df: DataFrame, dim_date: DataFrame) -> None:
    """Evaluate the checks declared on one written table and raise on errors. Keys are
    compared for a unique check if hashes of them repeat, else they don't."""
    checks = [c for c in ALL_CHECKS if c.model == name and (c.kind != "unique" or may_repeat(df, c.column))]
    if checks:
        raise_on_errors(run_checks({"dim_date": dim_date, name: df}, checks=checks))


def raise_on_errors(results: DataFrame) -> None:
    bad = results.filter((F.col("severity") == "error") & (F.col("n_failed") > 0)).collect()
    if bad:
        names = ", ".join(f"{r.test_name}={r.n_failed}" for r in bad)
        raise AssertionError(f"data tests failed: {names}")


def freshness(sources: dict[str, DataFrame]) -> DataFrame:
    """Latest ``_loaded_at`` and row count per source (DQ6, re-aimed: the
    reference declares the loaded-at field but no thresholds)."""
    parts = [df.agg(F.lit(name).alias("source_name"),
                    F.max("_loaded_at").alias("max_loaded_at"),
                    F.count(F.lit(1)).alias("rows_loaded")) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)


def freshness_age(sources: dict[str, DataFrame], as_of: _dt.datetime, warn_hours: int, error_hours: int) -> DataFrame:
    """One row per source: its latest load, how many whole hours before ``as_of``
    that was, and ``pass``, ``warn`` or ``error`` by the two bounds; a source
    without a load time has no age and is an error."""
    age = F.floor(F.timestamp_diff("SECOND", F.col("max_loaded_at"), ntz_literal(as_of)) / 3600)
    status = (F.when(F.col("age_hours").isNull() | (F.col("age_hours") >= error_hours), "error")
              .when(F.col("age_hours") >= warn_hours, "warn").otherwise("pass"))
    return freshness(sources).withColumn("age_hours", age.cast("long")).withColumn("status", status)


def guardrails(funnel: DataFrame, revenue: DataFrame, bookings: DataFrame) -> DataFrame:
    """G1-G4, G8 as violation counts (0 = holds; G8 is informational). G2
    counts converted rows whose SR has no booking event."""
    def rows(wide, pairs):
        return _unpivot(wide, [F.struct(F.lit(n).alias("guardrail"),
                                        F.col(c).cast("bigint").alias("n_rows"))
                               for c, n in pairs])

    f = funnel.agg((F.count(F.lit(1)) - F.count_distinct("booking_key")).alias("g1"))
    converted = funnel.filter(F.col("is_converted") == 1).select("sr_id")
    g2 = converted.join(bookings.select("sr_id"), "sr_id", "left_anti").agg(F.count(F.lit(1)).alias("g2"))
    r = revenue.agg(
        (F.count(F.lit(1)) - F.count_distinct("revenue_key")).alias("g3"),
        F.count_if((F.col("payment_status") == "completed")
                   & ((F.col("net_platform_revenue") + F.col("net_pro_payout"))
                      != F.col("gross_amount"))).alias("g4"))
    status = F.col("payment_status")
    g8 = (revenue.filter(status.isin("refunded", "chargeback") & F.col("sr_id").isNotNull()).groupBy("sr_id")
          .agg(F.max(status == "refunded").alias("refunded"), F.max(status == "chargeback").alias("chargeback"))
          .agg(F.count(F.lit(1)).alias("g8"), F.count_if("refunded").alias("g8r"),
               F.count_if("chargeback").alias("g8c")))
    return (rows(f, [("g1", "funnel_booking_key_unique")])
            .unionByName(rows(g2, [("g2", "converted_subset_of_bookings")]))
            .unionByName(rows(r, [("g3", "revenue_key_unique"),
                                  ("g4", "completed_net_split_equals_gross")]))
            .unionByName(rows(g8, [("g8", "srs_with_reversal_rows"), ("g8r", "srs_with_refunded_rows"),
                                   ("g8c", "srs_with_chargeback_rows")])))


def fan_out_report(lookups: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """For each lookup side of a join, how many keys repeat and the largest
    multiplicity. A lookup is safe only with zero repeated keys."""
    parts = []
    for name, (df, keys) in lookups.items():
        d = duplicate_keys(df.select(*keys), keys)
        parts.append(d.agg(F.lit(name).alias("lookup"),
                           F.count(F.lit(1)).alias("duplicate_keys"),
                           F.coalesce(F.max("n_rows"), F.lit(1)).cast("bigint")
                           .alias("max_rows_per_key")))
    return reduce(DataFrame.unionByName, parts)
