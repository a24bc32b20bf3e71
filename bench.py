"""Benchmark of the headline jobs; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 1; the median is reported).

The flow mirrors production: ``land_raw`` derives the five raw sources from
the driver's tables and lands them as Parquet (an ingestion step, timed like
the rest); the engine then reads the landed tables with their declared
schema. Model jobs run to the ``noop`` sink (full execution, no collect);
``full_build`` writes all ten tables to a warehouse and metrics / checks read
the written facts, as analysts and scheduled tests do; ``nightly_incremental``
is one incremental day on top of a build as of the day before.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starweave.plans import metrics, quality  # noqa: E402
from starweave.plans.build import Models  # noqa: E402
from starweave.plans.incremental import EVENTS_CUTOFF, known_at  # noqa: E402
from starweave.plans.run import build_full_to_warehouse, build_incremental  # noqa: E402
from starweave.plans.warehouse import Warehouse  # noqa: E402
from starweave.session import build_session  # noqa: E402
from starweave.sources import testdata_sources  # noqa: E402
from starweave.sources.raw import RawSources, land  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "1"))
RUN_TS = dt.datetime(2024, 1, 31, 6)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    scratch = tempfile.mkdtemp(prefix="starweave-bench-")
    spark = build_session(f"local[{CPUS}]", "starweave-bench", shuffle_partitions=2 * CPUS,
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"})
    landing = os.path.join(scratch, "landing")
    state = {}

    def land_raw():
        land(testdata_sources(spark, SF_DIR), landing, files_per_table=CPUS)
        state["raw"] = RawSources.from_landing(spark, landing)

    def models():
        return Models(spark, state["raw"], RUN_TS)

    def full_build():
        wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir=scratch))
        build_full_to_warehouse(spark, state["raw"], wh, RUN_TS, check=False)  # checks are timed as dq_all
        state["wh"] = wh

    def read(n):
        return state["wh"].read(n)

    def nightly():
        """Warehouse as of the night of EVENTS_CUTOFF, then the next night's
        run over the sources as known one day later (only the timed part)."""
        wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir=scratch))
        build_full_to_warehouse(spark, known_at(state["raw"], EVENTS_CUTOFF), wh, RUN_TS, check=False)
        next_day = EVENTS_CUTOFF + dt.timedelta(days=1)
        t0 = time.perf_counter()
        build_incremental(spark, known_at(state["raw"], next_day), wh, next_day, RUN_TS, check=False)
        return time.perf_counter() - t0

    def dq_all():
        tables = {n: state["raw"].table(n) for n in ["raw_events", "raw_sessions",
                                                     "service_requests", "raw_pro_profiles",
                                                     "raw_payments"]}
        for n in ["fct_booking_events", "fct_session_events", "fct_booking_funnel",
                  "fct_revenue", "dim_date"]:
            tables[n] = read(n)
        noop(quality.run_checks(tables))

    jobs = {
        "land_raw": land_raw,
        "fct_session_events": lambda: noop(models()["fct_session_events"]),
        "fct_revenue": lambda: noop(models()["fct_revenue"]),
        "dim_pro": lambda: noop(models()["dim_pro"]),
        "fct_booking_funnel": lambda: noop(models()["fct_booking_funnel"]),
        "full_build": full_build,
        "booking_conversion_rate": lambda: noop(metrics.booking_conversion_rate(
            read("fct_booking_funnel"), ["category_key"])),
        "revenue_by_month": lambda: noop(metrics.revenue_metrics(
            read("fct_revenue"), ["year", "month"], read("dim_date"))),
        "session_metrics": lambda: [noop(f(read("fct_session_events"))) for f in
                                    (metrics.bounce_rate, metrics.booking_rate_by_entry_page,
                                     metrics.avg_seconds_between_events)],
        "dq_all": dq_all,
        "nightly_incremental": nightly,
    }
    noop(testdata_sources(spark, SF_DIR).raw_sessions)  # warm-up: JVM, codegen, listing
    times = {}
    for name, fn in jobs.items():
        runs = []
        for _ in range(REPEAT):
            t0 = time.perf_counter()
            inner = fn()
            runs.append(inner if isinstance(inner, float) else time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": CPUS,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
