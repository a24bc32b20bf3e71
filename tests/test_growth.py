"""What a job shuffles and writes grows with its input, not with a multiple of it."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from starweave.sources import testdata as adapter

DAY = dt.datetime(1995, 3, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lineitem(spark, rows):
    return spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
                                       "l_discount double, l_returnflag string, l_shipdate timestamp_ntz")


def test_payments_are_shuffled_once_by_their_request(spark):
    """F9 (fct_revenue): the grouping of order lines and the join by sr_id share a shuffle."""
    lines = _lineitem(spark, [(n // 3, 1, n % 3, 10.0, 0.05, "A", DAY) for n in range(9)])
    requests = spark.createDataFrame([("sr_1", "x")], "sr_id string, status string")
    plan = _plan(adapter.raw_payments(lines).hint("merge").join(requests, "sr_id"))
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert "SortAggregate" not in plan


def test_payment_status_follows_the_largest_flag(spark):
    """Flags as ranks: repeated lines, unknown flags and nulls give the status that text order gives."""
    flags = {1: ["A", "A"], 2: ["A", "N"], 3: ["N", "R"], 4: ["A", "B"], 5: [None, "A"], 6: [None, None],
             7: ["N", "P"], 8: ["R", "S"], 9: ["", "a"], 10: ["AA", "A"], 11: ["", "A"], 12: ["0", "N"]}
    lines = _lineitem(spark, [(k, 1, 4, 10.0, 0.05, f, DAY) for k, fs in flags.items() for f in fs]
                      + [(None, 1, 4, 10.0, 0.05, "A", DAY), (13, 1, None, 10.0, 0.05, "A", DAY)])
    known = {"A": "completed", "R": "completed", "N": "pending"}
    got = {r.payment_id: (r.sr_id, r.payment_status, float(r.gross_amount)) for r in adapter.raw_payments(lines).collect()}
    want = {f"pay_{k}_4": (f"sr_{k}", known.get(max((f for f in fs if f is not None), default=None)), 20.0) for k, fs in flags.items()}
    assert {k: v for k, v in got.items() if k} == want
    assert sum(r.payment_id is None for r in adapter.raw_payments(lines).collect()) == 2


def test_builds_compare_as_bags_by_a_digest(spark):
    """F4 (rebuilt_facts): differing rows are counted as both exceptAll would, in one narrow shuffle."""
    from starweave.plans.catalog import _builds_compared
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    schema = "a string, b decimal(14,2), c timestamp_ntz, dw_updated_at timestamp_ntz"
    micro = dt.datetime(2024, 1, 1, 0, 0, 0, 1)

    def compared(one, two):
        frames = [spark.createDataFrame([(*r, t) for r in rows], schema) for rows, t in ((one, t1), (two, t2))]
        return tuple(_builds_compared(*frames, t1, t2).first())

    row = ("x", None, t1)
    assert compared([row, row], [row, row]) == (2, 0, True)
    assert compared([row, row], [row]) == (1, 1, True)
    assert compared([row], [("x", None, micro)]) == (1, 2, True)
    assert compared([(None, None, t1)], [("null", None, t1)]) == (1, 2, True)
    assert compared([], []) == (0, 0, True)
    frames = [spark.createDataFrame([(*row, t)], schema) for t in (t2, t2)]
    assert tuple(_builds_compared(*frames, t1, t2).first()) == (1, 0, False)
    plan = _plan(_builds_compared(*frames, t1, t2))
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_metric_dimensions_writes_only_what_its_metrics_read(spark, monkeypatch):
    """F8 (metric_dimensions): refused columns, hashed keys among them, are not materialised."""
    from starweave.plans import catalog, metrics
    written, cut = [], catalog.cut_lineage
    monkeypatch.setattr(catalog, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    rows = catalog.registry()["metric_dimensions"](spark, "/root/testdata/sf0.001").collect()
    assert {r.dimension for r in rows if r.refused} >= {"revenue_key", "booking_key", "pro_key"}
    for family, columns in zip(catalog.METRIC_OF, written, strict=True):
        assert set(columns) <= {*metrics.SAFE_DIMS[family], *metrics.MEASURES[family]}


def test_a_run_derives_its_sources_once(spark, monkeypatch):
    """F1, F2, F3 (replays, nights, readers): the derived sources are loaded once, whatever the steps ask."""
    from starweave.plans import catalog
    from starweave.sources.raw import RawSources
    loads, make = [], catalog.testdata_sources

    def counted(spark, d):
        raw = make(spark, d)
        return RawSources(lambda name: loads.append(name) or raw.table(name))

    monkeypatch.setattr(catalog, "testdata_sources", counted)
    catalog.registry()["incremental_revenue"](spark, "/root/testdata/sf0.001").count()
    assert sorted(loads) == sorted(catalog.LANDED["fct_revenue"])


def test_upsert_reads_its_batch_twice_but_keeps_the_columns_in_order(spark):
    """a merge on a column that is not the first returns the target's column order."""
    from starweave.operators import upsert
    old = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 1)], "key string, id string, n int")
    new = spark.createDataFrame([("k2", "b", 2)], "key string, id string, n int")
    got = upsert(old, new, "id")
    assert got.columns == ["key", "id", "n"] and {tuple(r) for r in got.collect()} == {("k1", "a", 1), ("k2", "b", 2)}
    with pytest.raises(ValueError):
        upsert(old, new.union(new), "id")


def test_revenue_night_takes_each_payment_once(spark):
    """recent payments and those of changed requests are one pass; a repeated payment counts once."""
    from starweave.plans.incremental import step_fct_revenue
    from tests.conftest import RUN_TS, raw_frames, ts
    from starweave.plans.build import Models
    old, new = ts("2024-01-01 00:00:00"), ts("2024-01-15 12:00:00")
    money = (10, 0.2, 2, 8)

    def pay(key, sr, t):
        return (key, sr, t, "ach", "completed", *[__import__("decimal").Decimal(str(x)) for x in money], t)

    raw = raw_frames(
        spark,
        service_requests=[("s1", old, "completed", "plumbing", "x", "p1", new), ("s2", old, "matched", "plumbing", "x", "p1", old)],
        raw_payments=[pay("a", "s1", old), pay("b", "s1", new), pay("c", "s2", old), pay("d", "s2", new), pay("d", "s2", new),
                      pay("e", None, new)])
    m = Models(spark, raw, RUN_TS)
    change = step_fct_revenue(raw.raw_payments, raw.service_requests, m, dt.date(2024, 1, 16), RUN_TS)
    assert sorted(r.payment_id for r in change.fresh.collect()) == ["a", "b", "d"]
    assert change.on == "payment_id" and change.unique


def test_profiles_are_made_distinct_before_they_are_widened(spark):
    """F7 (incremental_funnel): order lines are made distinct on a number, the category and the month, not on the
    texts made of them; repeated suppliers and nations, null days and segments that differ in case give each profile once."""
    lines = _lineitem(spark, [(1, 7, 1, 1.0, 0.0, "A", DAY), (1, 7, 2, 1.0, 0.0, "A", DAY), (2, 7, 1, 1.0, 0.0, "A", DAY),
                              (2, 7, 2, 1.0, 0.0, "A", None), (1, None, 3, 1.0, 0.0, "A", DAY), (1, 8, 4, 1.0, 0.0, "A", DAY)])
    orders = spark.createDataFrame([(1, 1), (2, 2)], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame([(1, "TOOLS"), (2, "Tools")], "c_custkey long, c_mktsegment string")
    supplier = spark.createDataFrame([(7, 0), (7, 0), (7, 1), (8, None)], "s_suppkey long, s_nationkey int")
    nation = spark.createDataFrame([(0, "X"), (0, "x"), (1, "Y")], "n_nationkey int, n_name string")
    profiles = adapter.raw_pro_profiles(lines, orders, customer, supplier, nation)
    got = sorted(((r.sp_id, r.market, r.category, r.is_active, r.updated_at) for r in profiles.collect()), key=str)
    month = DAY.replace(year=DAY.year + 25, day=1)
    assert got == sorted([("sp_7", m, "tools", a, t) for m in "xy" for a, t in [((7 + 3) % 7 != 0, month), (None, None)]], key=str)
    plan = _plan(profiles)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("l_suppkey" in line and "month" in line for line in shuffles) and not any("sp_id" in line for line in shuffles), plan


def test_versions_are_compared_before_their_keys_are_hashed(spark, monkeypatch):
    """the type-2 step shuffles and writes the batch without hashed keys, and looks up older
    versions of the keys that have one."""
    from starweave.operators import scd2
    from starweave.plans.build import Models
    from starweave.plans.incremental import step_dim_service_request
    from tests.conftest import RUN_TS, raw_frames, ts
    old, new = ts("2024-01-01 00:00:00"), ts("2024-01-15 12:00:00")
    before = raw_frames(spark, service_requests=[(s, old, "matched", "plumbing", "x", "p1", old) for s in ("s1", "s2")])
    now = raw_frames(spark, service_requests=[("s1", old, "completed", "plumbing", "x", "p1", new),
                                              ("s2", old, "matched", "plumbing", "x", "p1", new),
                                              ("s3", new, "submitted", "plumbing", "x", "p1", new)])
    b, n = Models(spark, before, RUN_TS), Models(spark, now, RUN_TS)
    written, cut = [], scd2.cut_lineage
    monkeypatch.setattr(scd2, "cut_lineage", lambda df: written.append(df) or cut(df))
    change = step_dim_service_request(b["dim_service_request"], now.service_requests, n["dim_category"], n["dim_geography"],
                                      dt.date(2024, 1, 16), RUN_TS)
    got = {(r.sr_id, r.status, r.valid_to, r.is_current, r.category_key is not None) for r in change.fresh.collect()}
    assert got == {("s1", "matched", new, False, True), ("s1", "completed", None, True, True), ("s3", "submitted", None, True, True)}
    assert change.among_current
    assert "service_request_key" not in written[0].columns and written[0].count() == 2
    assert [r.sr_id for r in written[1].collect()] == ["s1"]


def test_funnel_night_looks_at_booked_requests_only(spark):
    """requests without a booking are not in the scope, however they changed; a request that lost its booking
    to an earlier one loses its row, a null sr_id gains none."""
    from starweave.plans import incremental as inc
    from starweave.plans.build import Models
    from tests.conftest import RUN_TS, raw_frames, ts
    night, old, new = dt.date(2024, 1, 16), ts("2023-12-01 00:00:00"), ts("2024-01-15 12:00:00")

    def requests(t, status):
        return [(s, old, status, "plumbing", "x", "p1", t) for s in ("s1", "s2", "s3", "s4", None)]

    def event(key, session, sr, t):
        return (key, session, "booking_submitted", t, f'{{"sr_id": "{sr}"}}')

    first = [event("e2", "a", "s1", ts("2024-01-14 10:00:00")), event("e3", "b", "s3", ts("2024-01-02 10:00:00"))]
    earlier = event("e1", "a", "s2", ts("2024-01-14 09:00:00"))
    sessions = [(s, old, old, "home", old) for s in "ab"]
    before = Models(spark, raw_frames(spark, service_requests=requests(old, "submitted"), raw_events=first,
                                      raw_sessions=sessions), RUN_TS)
    raw = raw_frames(spark, service_requests=requests(new, "matched"), raw_events=[*first, earlier], raw_sessions=sessions)
    now = Models(spark, raw, RUN_TS)
    bookings = inc.step_fct_booking_events(raw.raw_events, night, RUN_TS).fresh
    booked = bookings.select("sr_id").union(before["fct_booking_events"].join(bookings, "session_id", "left_semi").select("sr_id"))
    kept = inc.booked_requests(raw.service_requests, now["fct_booking_events"], booked)
    assert sorted(r.sr_id for r in kept.collect()) == ["s1", "s2", "s3"]
    versioned = spark.createDataFrame([("s3",), ("s4",)], "sr_id string")
    change = inc.step_fct_booking_funnel(kept, now, booked, versioned, raw.raw_sessions.limit(0), night, RUN_TS)
    assert sorted(r.booking_key for r in change.scope.collect()) == ["s1", "s2", "s3"]
    got = change.apply(before["fct_booking_funnel"]).drop("dw_updated_at")
    assert sorted(r.booking_key for r in got.collect()) == ["s2", "s3"]
    whole = now["fct_booking_funnel"].drop("dw_updated_at")
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_funnel_replay_equals_the_full_build_without_wide_scope(spark, monkeypatch):
    """the query's scope holds booked requests only and its rows are those of a full build."""
    from starweave.plans import catalog, incremental as inc
    scopes, make = [], inc.funnel_scope
    monkeypatch.setattr(inc, "funnel_scope", lambda *a, **k: scopes.append(make(*a, **k)) or scopes[-1])
    got = catalog.registry()["incremental_funnel"](spark, "/root/testdata/sf0.001")
    whole = catalog.registry()["fct_booking_funnel"](spark, "/root/testdata/sf0.001")
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()
    bookings = catalog.registry()["fct_booking_events"](spark, "/root/testdata/sf0.001")
    assert scopes[0].join(bookings, "sr_id", "left_anti").isEmpty()


def _revenue_sources(spark):
    """Requests with null times, categories and pros, one that comes twice, and payments of them and of none."""
    from tests.conftest import RUN_TS, raw_frames, ts
    from starweave.plans.build import Models
    from decimal import Decimal
    old, new = ts("2024-01-01 00:00:00.123456"), ts("2024-01-15 12:00:00")
    requests = [("s1", old, "completed", "plumbing", "x", "p1", new), ("s2", old, "matched", None, "x", "p1", None),
                ("s3", old, None, "plumbing", None, "p2", old), ("s3", old, "matched", "plumbing", "y", None, new)]
    profiles = [("p1", "m", "plumbing", True, None), ("p1", "m", "roofing", False, old), ("p2", None, "plumbing", None, old)]
    states = ["completed", "refunded", "chargeback", "pending", None]
    payments = [(f"{s}_{i}", s, old if i % 2 else new, "ach", st, Decimal("10.00"), Decimal("0.2000"), Decimal("2.00"), Decimal("8.00"), new)
                for s in ("s1", "s2", "s3", "s4", None) for i, st in enumerate(states)] + [(None, "s1", None, None, "failed", None, None, None, None, old)]
    return Models(spark, raw_frames(spark, service_requests=requests, raw_pro_profiles=profiles, raw_payments=payments), RUN_TS)


def _same(one, two):
    return one.columns == two.columns and one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_revenue_is_shuffled_and_stored_without_hashed_keys(spark, tmp_path):
    """F4 (revenue_in_window): version and revenue keys, which do not compress, are made when the fact is read."""
    from starweave.functions import hash_key, surrogate_key, ts_text
    from starweave.plans.warehouse import MONTH, Warehouse
    m, wh = _revenue_sources(spark), Warehouse(spark, str(tmp_path))
    stored, form = m.stored("fct_revenue")
    assert not [c for c in stored.columns if c in ("revenue_key", "service_request_key", "pro_key")]
    wh.write_full("fct_revenue", stored, form)
    files = spark.read.parquet(wh.path("fct_revenue") + "/data")
    assert {"revenue_key", "service_request_key", "pro_key"}.isdisjoint(files.columns) and files.count() == 31  # s3, with two requests and two versions, counts four times
    whole = wh.read("fct_revenue")
    assert _same(whole, m["fct_revenue"]) and wh.read("fct_revenue", keep_month=True).columns == [*whole.columns, MONTH]
    looked_up = (whole.select("payment_id", "sr_id", "sp_id", "category_key", "service_request_key", "pro_key", "revenue_key")
                 .join(m["dim_service_request"].select("sr_id", F.col("service_request_key").alias("key")), "sr_id")
                 .join(m["dim_pro"].select("sp_id", "category_key", F.col("pro_key").alias("pro")), ["sp_id", "category_key"], "left"))
    assert whole.join(m["dim_service_request"], "service_request_key", "left_anti").isEmpty()
    assert looked_up.filter(~F.col("pro").eqNullSafe(F.col("pro_key")) | ~F.col("revenue_key").eqNullSafe(hash_key("payment_id"))).isEmpty()
    unknown = m["dim_service_request"].filter("sr_id = 's2'").select(surrogate_key("sr_id", ts_text(F.lit(None).cast("timestamp_ntz"))))
    assert {r[0] for r in unknown.collect()} == {r[0] for r in whole.filter("sr_id = 's2'").select("service_request_key").collect()}


def test_a_table_takes_rows_of_its_form(spark, tmp_path):
    """a fact written with its keys takes a night's rows; one stored in a form takes no finished ones."""
    from starweave.plans.incremental import Change
    from starweave.plans.warehouse import Warehouse
    m, wh = _revenue_sources(spark), Warehouse(spark, str(tmp_path))
    stored, form = m.stored("fct_revenue")
    kept, fresh = F.col("payment_id").isNotNull() & (F.col("sr_id") == "s1"), F.col("payment_id").isin("s1_0", "s2_1")
    for table_form in (None, form):
        wh.write_full("fct_revenue", m["fct_revenue"].filter(kept) if table_form is None else stored.filter(kept), table_form)
        wh.apply("fct_revenue", Change(stored.filter(fresh), "payment_id", unique=True, form=form))
        assert _same(wh.read("fct_revenue"), m["fct_revenue"].filter(kept | fresh))
    with pytest.raises(ValueError, match="form"):
        wh.merge_partitions("fct_revenue", m["fct_revenue"].filter(fresh), "payment_id", True)


def test_a_run_frees_the_shuffle_files_of_its_finished_jobs(spark, tmp_path):
    """inside a run shuffle files go when their job ends, not when the driver collects garbage."""
    from starweave.session import FREE_SHUFFLES, released_cuts

    def shuffled(name):
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        before = set(str(disk.getAllFiles()).split(", "))
        spark.range(1000).repartition(4).write.parquet(str(tmp_path / name))
        for _ in range(50):
            left = [f for f in set(str(disk.getAllFiles()).split(", ")) - before if "shuffle_" in f]
            if not left or name == "outside":
                break
            time.sleep(0.1)
        return left

    was = spark.conf.get(FREE_SHUFFLES, "false")
    assert shuffled("outside")
    with released_cuts(spark):
        assert not shuffled("inside")
    assert spark.conf.get(FREE_SHUFFLES, "false") == was


def test_builds_that_agree_compare_by_their_buckets(spark, monkeypatch):
    """F1 (rebuilt_facts): buckets of rows have digests of fixed size; rows meet one by one only where these differ."""
    from starweave.plans import catalog
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    digests, cut = [], catalog.cut_lineage
    monkeypatch.setattr(catalog, "cut_lineage", lambda *a: digests.append(cut(*a)) or digests[-1])
    one = spark.range(20000).select(F.col("id").cast("string").alias("a"), F.lit(t1).cast("timestamp_ntz").alias("dw_updated_at"))
    two = one.withColumn("dw_updated_at", F.lit(t2).cast("timestamp_ntz")).repartition(7)
    word = F.col("word0") != 0

    def compared(second):
        row = tuple(catalog._builds_compared(one, second, t1, t2).first())
        return row, digests[-1].count(), digests[-1].filter(word).count()

    assert compared(two) == ((20000, 0, True), catalog.DIGEST_BUCKETS, 0)
    other = two.withColumn("a", F.when(F.col("a") == "77", F.lit("x")).when(F.col("a") == "5", F.lit("6")).otherwise(F.col("a")))
    row, _, differing = compared(other)
    assert row == (20000, 4, True) and 1 <= differing <= 4
    assert compared(two.union(two.limit(1)))[0] == (20001, 1, True)


def test_unique_keys_are_told_by_their_hashes(spark, monkeypatch):
    """F2 (readers_keep_published), F1: long keys are compared, and shuffled, only where hashes of them repeat."""
    from starweave.operators.joins import may_repeat
    from starweave.plans import quality
    from starweave.plans.dims import dim_date
    keys = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "k string")
    assert not may_repeat(keys, "k") and not may_repeat(keys.limit(0), "k") and may_repeat(keys.union(keys), "k")
    asked, unique = [], quality._unique_check
    monkeypatch.setattr(quality, "_unique_check", lambda df, c: asked.append(c.column) or unique(df, c))
    m = _revenue_sources(spark)
    days = dim_date(spark, dt.datetime(2024, 1, 31))
    fact = m["fct_revenue"].filter("payment_id is not null and payment_status is not null and sr_id <> 's3'")
    quality.check_table("fct_revenue", fact, days)
    assert not asked
    with pytest.raises(AssertionError, match="fct_revenue__payment_id__unique=10, fct_revenue__revenue_key|fct_revenue__revenue_key__unique"):
        quality.check_table("fct_revenue", fact.unionByName(fact), days)
    assert sorted(asked) == ["payment_id", "revenue_key"]


def test_a_revenue_night_joins_its_payments_once(spark, monkeypatch):
    """F3 (nightly_revenue): whether payments repeat is asked of the payments read, not of their join; a merge of
    checked keys makes them distinct no second time and keeps no list of replaced rows that nobody asks for."""
    from starweave.plans import incremental as inc, warehouse
    m, plans = _revenue_sources(spark), []
    ask = inc.may_repeat
    monkeypatch.setattr(inc, "may_repeat", lambda df, key: plans.append(_plan(df)) or ask(df, key))
    raw = m.raw
    change = inc.step_fct_revenue(raw.raw_payments.filter("payment_id is not null"), raw.service_requests.filter("sr_id <> 's3'"), m, dt.date(2024, 1, 16), m.run_ts)
    assert len(plans) == 1 and "Join" not in plans[0]
    written, cut = [], warehouse.cut_lineage
    monkeypatch.setattr(warehouse, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    import tempfile
    wh = warehouse.Warehouse(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    wh.write_full("fct_revenue", *m.stored("fct_revenue"))
    before = wh.read("fct_revenue").filter("sr_id <> 's3'").count()
    wh.write_full("fct_revenue", m.stored("fct_revenue")[0].filter("sr_id <> 's3' and payment_id is not null"), "revenue")
    change.fresh = change.fresh.filter("sr_id <> 's3'").dropDuplicates(["payment_id"])
    wh.apply("fct_revenue", change)
    assert len(written) == 1 and wh.read("fct_revenue").count() == before - 1
