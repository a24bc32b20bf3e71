"""The warehouse's commit point, file skipping, merges by file and the audit."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from starweave.plans import metrics
from starweave.plans.run import build_full_to_warehouse, build_incremental
from starweave.plans.versions import LostRace
from starweave.plans.warehouse import Warehouse
from starweave.session import cut_lineage, released_cuts
from starweave.sources import testdata_sources
from starweave.sources.raw import RawSources
from tests.conftest import RUN_TS, SF_SMALL

FUNNEL = "fct_booking_funnel"
COLUMNS = "booking_key string, created_at_date_key string, category_key string, n int"


def rows(spark, *given):
    return spark.createDataFrame([(k, day, "c", n) for k, day, n in given], COLUMNS)


def found(wh, **kw):
    got = [(r.booking_key, r.created_at_date_key, r.n) for r in wh.read(FUNNEL, **kw).collect()]
    return sorted(got, key=repr)


def year(spark):
    return rows(spark, *[(f"k{m:02d}{d:02d}", f"2024{m:02d}{d:02d}", 0) for m in range(1, 13) for d in range(1, 29)])


def test_a_transaction_shows_nothing_until_it_ends(spark, tmp_path):
    wh, reader = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    wh.write_full(FUNNEL, rows(spark, ("a", "20240101", 1)))
    with wh.transaction():
        wh.write_full(FUNNEL, rows(spark, ("a", "20240101", 2)))
        wh.merge_partitions(FUNNEL, rows(spark, ("b", "20240102", 3)), "booking_key", True)
        assert found(wh) == [("a", "20240101", 2), ("b", "20240102", 3)]
        assert found(reader) == [("a", "20240101", 1)]
    assert found(reader) == [("a", "20240101", 2), ("b", "20240102", 3)]


@pytest.mark.parametrize("failure", [ValueError, KeyboardInterrupt])
def test_a_failed_transaction_leaves_the_version_and_no_files(spark, tmp_path, failure):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full(FUNNEL, rows(spark, ("a", "20240101", 1)))
    before = sorted(glob.glob(f"{tmp_path}/fact/*/*/*"))
    with pytest.raises(failure):
        with wh.transaction():
            wh.write_full(FUNNEL, rows(spark, ("x", "20240101", 9)))
            raise failure
    assert found(wh) == [("a", "20240101", 1)] and sorted(glob.glob(f"{tmp_path}/fact/*/*/*")) == before


def test_the_second_of_two_runs_that_began_together_fails(spark, tmp_path):
    one, two = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    one.write_full(FUNNEL, rows(spark, ("a", "20240101", 1)))
    with pytest.raises(LostRace):
        with two.transaction():
            two.merge_partitions(FUNNEL, rows(spark, ("b", "20240102", 2)), "booking_key", True)
            one.merge_partitions(FUNNEL, rows(spark, ("c", "20240103", 3)), "booking_key", True)
    assert found(two) == [("a", "20240101", 1), ("c", "20240103", 3)]
    two.merge_partitions(FUNNEL, rows(spark, ("b", "20240102", 2)), "booking_key", True)
    assert [k for k, _, _ in found(one)] == ["a", "b", "c"]


def test_readers_go_on_and_old_versions_go(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full(FUNNEL, rows(spark, ("a", "20240101", 1)))
    open_read = wh.read(FUNNEL)  # planned on the first version
    wh.write_full(FUNNEL, rows(spark, ("a", "20240101", 2)))
    assert [r.n for r in open_read.collect()] == [1]
    for n in (3, 4):
        wh.write_full(FUNNEL, rows(spark, ("a", "20240101", n)))
    assert wh.versions.numbers() == [3, 4] and len(glob.glob(f"{tmp_path}/fact/{FUNNEL}/data/*")) == 2
    assert len(glob.glob(f"{tmp_path}/fact/{FUNNEL}/_manifests/*")) == 2 and found(wh) == [("a", "20240101", 4)]


def test_clean_removes_what_a_dead_run_left(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full(FUNNEL, rows(spark, ("a", "20240101", 1)))
    dead = Warehouse(spark, str(tmp_path))
    block = dead.transaction()
    block.__enter__()  # a process that ends here runs no clean-up
    dead.write_full(FUNNEL, rows(spark, ("x", "20240101", 9)))
    assert found(wh) == [("a", "20240101", 1)] and len(glob.glob(f"{tmp_path}/fact/{FUNNEL}/data/*")) == 2
    wh.clean()
    assert found(wh) == [("a", "20240101", 1)] and len(glob.glob(f"{tmp_path}/fact/{FUNNEL}/data/*")) == 1


def test_a_week_opens_the_files_of_its_days(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full(FUNNEL, year(spark).union(rows(spark, ("late", None, 0))))
    since, until = dt.date(2024, 3, 4), dt.date(2024, 3, 10)
    week = wh.read(FUNNEL, since=since, until=until)
    assert [d for _, d, _ in found(wh, since=since, until=until)] == [f"202403{d:02d}" for d in range(4, 11)]
    assert len(week.inputFiles()) == 1 < 12 <= len(wh.read(FUNNEL).inputFiles())
    metric = metrics.booking_conversion_rate(week.withColumn("is_converted", F.lit(1)), [])
    assert len(metric.inputFiles()) == 1 and metric.first()["total_bookings"] == 7
    assert wh.read(FUNNEL).filter("created_at_date_key is null").count() == 1
    none = wh.read(FUNNEL, since=dt.date(2030, 1, 1))
    assert none.count() == 0 and none.columns == wh.read(FUNNEL).columns


def test_files_within_a_month_are_skipped_too(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wh.write_full(FUNNEL, rows(spark, *[(f"k{i}", f"202401{1 + i % 28:02d}", 0) for i in range(560)]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(wh.files(FUNNEL)) == 8
    assert len(wh.files(FUNNEL, dt.date(2024, 1, 8), dt.date(2024, 1, 9))) <= 2


def test_a_merge_rewrites_the_files_it_touches_once(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), small_file_bytes=0)
    wh.write_full(FUNNEL, year(spark))
    before = {f.file for f in wh.files(FUNNEL)}
    wh.merge_partitions(FUNNEL, rows(spark, ("k0305", "20240305", 7), ("k0401", "20240712", 8), ("new", "20240801", 9)), "booking_key", True)
    after = {f.file for f in wh.files(FUNNEL)}
    assert len(before - after) == 2  # March, and April that a row has left; August only gains a file
    got = {k: (d, n) for k, d, n in found(wh)}
    assert len(got) == 337 and got["k0305"] == ("20240305", 7) and got["k0401"] == ("20240712", 8) and got["new"] == ("20240801", 9)
    assert sum(f.rows for f in wh.files(FUNNEL)) == 337


def test_nights_do_not_pile_up_small_files(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write_full(FUNNEL, rows(spark, ("a", "20240101", 1)))
    for n in range(5):
        wh.merge_partitions(FUNNEL, rows(spark, (f"b{n}", "20240102", n)), "booking_key", True)
    assert len(wh.files(FUNNEL)) == 1 and len(found(wh)) == 6
    members = lambda k: spark.createDataFrame([(k, "x")], "category_key string, category string")
    wh.write_full("dim_category", members("m"))
    for n in range(12):
        wh.append("dim_category", members(f"m{n}"))
    assert wh.read("dim_category").count() == 13 and len(wh.files("dim_category")) <= 8


def test_a_lookup_with_a_repeated_key_stops_the_run(spark, tmp_path):
    raw = testdata_sources(spark, SF_SMALL)
    some = raw.raw_sessions.first()["session_id"]
    twice = lambda n: raw.table(n).unionByName(raw.table(n).filter(F.col("session_id") == some)) if n == "raw_sessions" else raw.table(n)
    wh, tables = Warehouse(spark, str(tmp_path)), ["dim_date", "dim_session", "fct_session_events"]
    with pytest.raises(ValueError, match="dim_session: join key"):
        build_full_to_warehouse(spark, RawSources(twice), wh, RUN_TS, tables)
    assert wh.versions.numbers() == []


def test_a_night_whose_lookup_comes_to_repeat_publishes_nothing(spark, tmp_path, monkeypatch):
    """A merge that leaves two rows of one session under two keys is found among the changed rows."""
    from starweave.plans import incremental as inc
    raw, tables = testdata_sources(spark, SF_SMALL), ["dim_date", "dim_session"]
    wh, day = Warehouse(spark, str(tmp_path)), inc.EVENTS_CUTOFF
    build_full_to_warehouse(spark, raw, wh, RUN_TS, tables)
    before = wh.read("dim_session").count()
    step = inc.step_dim_session

    def rekeyed(*args):
        change = step(*args)
        change.fresh = change.fresh.withColumn("session_key", F.concat(F.lit("other"), "session_key"))
        return change

    monkeypatch.setattr(inc, "step_dim_session", rekeyed)
    with pytest.raises(ValueError, match="dim_session: join key"):
        build_incremental(spark, raw, wh, day, RUN_TS, ["dim_session"])
    assert wh.read("dim_session").count() == before


def test_runs_leave_no_intermediate_tables(spark, tmp_path):
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir"), "cut", "*")
    before = set(glob.glob(folder))
    with released_cuts(spark):
        assert cut_lineage(spark.range(3)).count() == 3
    raw = testdata_sources(spark, SF_SMALL)
    build_full_to_warehouse(spark, raw, Warehouse(spark, str(tmp_path)), RUN_TS, ["dim_date", "dim_session", "fct_session_events"])
    assert set(glob.glob(folder)) == before
