import hashlib

from pyspark.sql import functions as F

from starweave.functions import (date_key, json_text, lookback, seconds_between, surrogate_key,
                                 ts_text)
from tests.conftest import ts


def test_surrogate_key_null_parts_and_separator(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    got = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    want = [hashlib.sha256(b"a|null").hexdigest(), hashlib.sha256(b"null|b").hexdigest()]
    assert got == want


def test_seconds_between_counts_boundaries(spark):
    # subsecond fixture: 0.9s -> 1.1s crosses one second boundary
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00.900"), ts("2024-01-01 00:00:01.100")),
                                (ts("2024-01-01 00:00:01.100"), ts("2024-01-01 00:00:01.900")),
                                (None, ts("2024-01-01 00:00:01"))], "a timestamp_ntz, b timestamp_ntz")
    got = [r.d for r in df.select(seconds_between("a", "b").alias("d")).collect()]
    assert got == [1, 0, None]


def test_timestamp_text_is_fixed_millis(spark):
    df = spark.createDataFrame([(ts("2024-01-02 03:04:05.678901"),)], "t timestamp_ntz")
    r = df.select(ts_text("t").alias("s"), date_key("t").alias("k")).first()
    assert r.s == "2024-01-02 03:04:05.678" and r.k == "20240102"


def test_json_cases(spark):
    rows = [('{"sr_id": "sr_1"}',), ("{}",), ('{"sr_id": null}',), ("not json",),
            ('{"sr_id": 42}',), (None,)]
    df = spark.createDataFrame(rows, "p string")
    got = [r.v for r in df.select(json_text("p", "sr_id").alias("v")).collect()]
    assert got == ["sr_1", None, None, None, "42", None]


def test_lookback_is_literal_and_pushed_to_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(ts("2024-01-10 00:00:00"),), (ts("2024-01-20 00:00:00"),)],
                          "u timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path).filter(lookback("u", "2024-01-16", 1))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(u), GreaterThanOrEqual(u,2024-01-15" in plan
