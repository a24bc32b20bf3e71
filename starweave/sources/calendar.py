"""Daily calendar generator (S8): start inclusive, end exclusive."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Calendar range of dim_date (end exclusive).
CALENDAR_START = _dt.date(2020, 1, 1)
CALENDAR_END = _dt.date(2035, 12, 31)


def date_spine(spark: SparkSession, start: _dt.date = CALENDAR_START,
               end: _dt.date = CALENDAR_END) -> DataFrame:
    """One row per day in [start, end) as column ``date_day``.

    Built from ``spark.range`` so the rows are generated in parallel slices
    rather than exploded from a single row.
    """
    n = (end - start).days
    return (spark.range(0, n, 1, numPartitions=max(1, min(64, n // 2048 + 1)))
            .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day")))
