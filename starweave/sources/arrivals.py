"""Views of the raw sources in which rows arrive late or are corrected later.

They feed the registered nightly runs: what a source shows before a night
differs from event time by fixed rules over the ids, and the view without a
night is what all nights together have delivered.

* Every fifth event lands, by its load time, 8 days after it happened.
* Every session row lands at its last update; that of every fourth user 6 days
  later, and carries the landing time as its update time.
* A payment is pending until its update. That of every seventh order lands 35
  days early with that timestamp and is corrected on its true day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.time import ntz_literal
from .raw import RawSources

# The first date is the full build, every further one a night.
EVENT_NIGHTS = [_dt.date(2024, 1, 16), _dt.date(2024, 1, 23)]
PAYMENT_NIGHTS = [_dt.date(2020, 6, 16), _dt.date(2020, 7, 16)]
HOT_SESSION = "session_hot"
LATE_EVENT, LATE_SESSION, EARLY_PAYMENT = 8, 6, 35  # days


def _days(n: int):
    return F.make_dt_interval(F.lit(n))


def _number(name: str):
    return F.regexp_extract(name, r"(\d+)", 1).cast("long")


def late_arrivals(raw: RawSources, night: _dt.date | None) -> RawSources:
    """Sources as landed before ``night``; None: everything has landed."""
    def events(df):
        late = F.when(_number("event_id") % 5 == 0, F.col("event_ts") + _days(LATE_EVENT)).otherwise(F.col("event_ts"))
        df = df.withColumn("_loaded_at", late)
        return df.filter(F.col("_loaded_at") < ntz_literal(night)) if night else df

    def sessions(df):
        landed = F.when(_number("session_id") % 4 == 0, F.col("updated_at") + _days(LATE_SESSION)).otherwise(F.col("updated_at"))
        df = df.withColumn("updated_at", landed)
        return df.filter(F.col("updated_at") < ntz_literal(night)) if night else df

    def payments(df):
        if night is None:
            return df
        n, paid = ntz_literal(night), F.col("payment_ts")
        early = (_number("payment_id") % 7 == 0) & (paid >= n)
        first = F.when(early, paid - _days(EARLY_PAYMENT)).otherwise(paid)
        open_ = F.col("updated_at") >= n
        status = F.when(open_, F.lit("pending")).otherwise(F.col("payment_status"))
        updated = F.when(open_, first).otherwise(F.col("updated_at"))
        return (df.withColumns({"payment_status": status, "updated_at": updated, "payment_ts": first})
                .filter(F.col("payment_ts") < n))

    views = {"raw_events": events, "raw_sessions": sessions, "raw_payments": payments}
    return RawSources(lambda name: views[name](raw.table(name)) if name in views else raw.table(name))


def bad_payments(raw: RawSources, night: _dt.date) -> RawSources:
    """Sources as landed before ``night`` in which every payment updated the day
    before has lost its amount."""
    def payments(df):
        fresh = F.col("updated_at") >= ntz_literal(night - _dt.timedelta(days=1))
        return df.withColumn("gross_amount", F.when(~fresh, F.col("gross_amount")))

    seen = late_arrivals(raw, night)
    return RawSources(lambda name: payments(seen.table(name)) if name == "raw_payments" else seen.table(name))


def hot_sessions(raw: RawSources) -> RawSources:
    """Sources in which one session, which has a session row, holds every third
    event, and every tenth of the other events has no session."""
    def events(df):
        n = _number("event_id")
        return df.withColumn("session_id", F.when(n % 3 == 0, F.lit(HOT_SESSION))
                             .when(n % 10 != 1, F.col("session_id")))

    def sessions(df):
        hot = df.agg(*[(F.lit(HOT_SESSION) if c == "session_id" else F.min(c)).alias(c) for c in df.columns])
        return df.unionByName(hot)

    views = {"raw_events": events, "raw_sessions": sessions}
    return RawSources(lambda name: views.get(name, lambda df: df)(raw.table(name)))


def mixed_properties(raw: RawSources) -> RawSources:
    """Sources in which the properties of some events are null, cut off by one
    character, or hold a number or JSON null as ``sr_id``."""
    def events(df):
        n, text = _number("event_id"), F.col("properties")
        return df.withColumn("properties", F.when(n % 23 == 0, F.lit(None).cast("string"))
                             .when(n % 19 == 0, F.expr("left(properties, length(properties) - 1)"))
                             .when(n % 17 == 0, F.concat(F.lit('{"sr_id": '), n.cast("string"), F.lit("}")))
                             .when(n % 13 == 0, F.lit('{"sr_id": null}')).otherwise(text))

    return RawSources(lambda name: events(raw.table(name)) if name == "raw_events" else raw.table(name))


def without_category(raw: RawSources, category: str) -> RawSources:
    """Sources before the first service request of ``category``."""
    requests = {"service_requests": lambda df: df.filter(~F.col("category").eqNullSafe(category))}
    return RawSources(lambda name: requests.get(name, lambda df: df)(raw.table(name)))
