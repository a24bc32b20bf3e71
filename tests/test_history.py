"""Type-2 dimensions whose nights read current versions and touched months only."""

import datetime as dt
import random

from pyspark.sql import functions as F

from starweave.operators import close_versions, scd2_apply, scd2_upserts, upsert
from starweave.plans.incremental import Change
from starweave.plans.warehouse import Warehouse

SR = "dim_service_request"
COLUMNS = "service_request_key string, sr_id string, status string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
DAY = dt.datetime(2024, 1, 10)


def versions(spark, *given):
    """(sr, status, day) as open versions."""
    rows = [(f"{sr}@{day}", sr, status, DAY + dt.timedelta(days=day), None, True) for sr, status, day in given]
    return spark.createDataFrame(rows, COLUMNS)


def history(spark, *given):
    return close_versions(versions(spark, *given), ["sr_id"]).select(*versions(spark, *given).columns)


def plain(df):
    return sorted((r.service_request_key, r.status, r.valid_to, r.is_current) for r in df.collect())


def test_upserts_equal_the_whole_apply(spark):
    rng, seen = random.Random(4), set()
    for _ in range(6):
        held = {(f"s{i}", day): rng.choice("abc") for i in range(6) for day in rng.sample(range(0, 40, 4), rng.randrange(1, 4))}
        batch = {f"s{i}": (rng.choice("abc"), rng.randrange(0, 60, 2)) for i in rng.sample(range(9), 5)}
        dim = history(spark, *[(sr, status, day) for (sr, day), status in held.items()])
        incoming = versions(spark, *[(sr, status, day) for sr, (status, day) in batch.items()])
        fresh, forward = scd2_upserts(dim.filter("is_current"), dim, incoming, ["sr_id"], ["status"])
        want = scd2_apply(dim, incoming, ["sr_id"], ["status"])
        assert plain(upsert(dim, fresh, "service_request_key")) == plain(want)
        seen.add(forward)
    assert False in seen


def night(spark, wh, *batch):
    fresh, forward = scd2_upserts(wh.read(SR, current=True), wh.read(SR), versions(spark, *batch), ["sr_id"], ["status"])
    before = {f.file: f.month for f in wh.files(SR)}
    wh.apply(SR, Change(fresh, "service_request_key", unique=True, track=("sr_id",), among_current=forward))
    after = {f.file: f.month for f in wh.files(SR)}
    return forward, {m for f, m in before.items() if f not in after}, {m for f, m in after.items() if f not in before}


def test_a_night_rewrites_current_versions_and_the_months_it_touches(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), small_file_bytes=0)
    old = [("a", "x", 0), ("a", "y", 40), ("b", "x", 0), ("b", "y", 70), ("c", "x", 0)]
    wh.write_full(SR, history(spark, *old))
    assert sorted(f.month for f in wh.files(SR)) == ["202402", "202403", "current"]
    assert wh.read(SR, current=True).count() == 3 and len(wh.read(SR, current=True).inputFiles()) == 1
    # c changes: its old version closes in April; the closed months stay as they are
    forward, gone, new = night(spark, wh, ("c", "z", 90), ("a", "y", 95))
    assert forward and gone == {"current"} and new == {"current", "202404"}
    assert plain(wh.read(SR)) == plain(history(spark, *old, ("c", "z", 90)))
    # a version of b that comes late cuts the one that closed in March
    forward, gone, new = night(spark, wh, ("b", "w", 30))
    assert not forward and gone == {"current", "202403"} and new == {"current", "202402", "202403"}
    assert plain(wh.read(SR)) == plain(history(spark, *old, ("c", "z", 90), ("b", "w", 30)))


def test_type_2_reads_of_current_versions_open_one_part(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full(SR, history(spark, *[("s", str(i), 30 * i) for i in range(12)]))
    assert [r.status for r in wh.read(SR, current=True).collect()] == ["11"]
    assert len(wh.files(SR)) > len(wh.files(SR, current=True)) == 1
    day = wh.read(SR, since=dt.date(2024, 3, 1), until=dt.date(2024, 3, 31))
    assert day.select(F.month("valid_from").alias("m")).distinct().collect() == [(3,)]
