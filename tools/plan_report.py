"""Summarise the executed (final AQE) plans of the main jobs over landed raw
tables: shuffles, join strategies, aggregates, windows, scan pushdown.

usage: python tools/plan_report.py [sf_dir]   -> markdown table on stdout
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starweave.plans import metrics  # noqa: E402
from starweave.plans.build import Models  # noqa: E402
from starweave.session import build_session  # noqa: E402
from starweave.sources import testdata_sources  # noqa: E402
from starweave.sources.raw import RawSources, land  # noqa: E402

PATTERNS = {
    "hash shuffle": r"Exchange hashpartitioning",
    "range shuffle": r"Exchange rangepartitioning",
    "single-partition shuffle": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "broadcast hash join": r"BroadcastHashJoin",
    "sort-merge join": r"SortMergeJoin",
    "shuffled hash join": r"ShuffledHashJoin",
    "hash agg": r"HashAggregate",
    "sort agg": r"SortAggregate",
    "window": r"\bWindow \[",
}


def summarise(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    out = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    out["pushed"] = sorted({m for m in re.findall(r"PushedFilters: \[([^\]]+)\]", plan)})
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="plan-report-")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    land(testdata_sources(spark, sf_dir), os.path.join(scratch, "landing"), 8)
    m = Models(spark, RawSources.from_landing(spark, os.path.join(scratch, "landing")),
               dt.datetime(2024, 1, 31))
    jobs = {n: m[n] for n in ["dim_pro", "dim_service_request", "fct_booking_events",
                              "fct_session_events", "fct_booking_funnel", "fct_revenue"]}
    jobs["conversion_by_month"] = metrics.booking_conversion_rate(
        m["fct_booking_funnel"], ["year", "month"], m["dim_date"])
    cols = list(PATTERNS)
    print("| job | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    pushed = {}
    for name, df in jobs.items():
        s = summarise(df)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
        pushed[name] = s["pushed"]
    print()
    for name, p in pushed.items():
        print(f"* {name}: " + "; ".join(f"`{x}`" for x in p))
    spark.stop()


if __name__ == "__main__":
    main()
