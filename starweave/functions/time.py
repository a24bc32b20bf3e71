"""Date and time expressions.

Every timestamp is TIMESTAMP_NTZ; the helpers avoid functions whose result
depends on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed anchor for whole-second counts (any instant before all data works).
_EPOCH = "timestamp_ntz'1900-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """YYYYMMDD text key of a timestamp or date."""
    return F.date_format(_col(c), "yyyyMMdd")


def to_day(c) -> Column:
    return F.to_date(_col(c))


def _whole_seconds(c: Column) -> Column:
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), c)


def seconds_between(start, end) -> Column:
    """Count of second boundaries crossed from start to end (0.9s->1.1s is 1).

    Null when either side is null. Result is BIGINT.
    """
    return _whole_seconds(_col(end)) - _whole_seconds(_col(start))


def lookback(c, as_of: _dt.date | str, days: int) -> Column:
    """Inclusive lower bound ``c >= as_of - days`` as a foldable literal, so the
    predicate reaches the Parquet scan."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return _col(c) >= ntz_literal(as_of - _dt.timedelta(days=days))


def ntz_literal(d: _dt.date | _dt.datetime) -> Column:
    """TIMESTAMP_NTZ literal built from text, so no time zone (of the Python
    process or the session) can shift it."""
    if not isinstance(d, _dt.datetime):
        d = _dt.datetime.combine(d, _dt.time())
    return F.lit(d.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
