"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard scores every key by ``weight / -ln(u)``, u being a seeded hash of
key and shard in (0, 1); the highest score wins, ties go to the smaller shard.
The id and the shards alone decide: with one shard more, a row either stays or
moves to the new shard. Slots number the rows of a shard without gaps; they
come from counts of hash buckets and a running number within one bucket, both
of about the square root of the row count, so no task numbers a whole shard.

Defined cases: null text has no bytes and crc32 0; rows with a null id share
one key; rows that repeat an id share a shard and have slots of their own; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

LAW = "key"
SHARDS = 8


def _unit52(*parts) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0, 1, ...) of a key for the given shard weights."""
    def score(shard: int, weight: float) -> Column:
        u = (_unit52(key, F.lit(str(shard))) + 0.5) / F.lit(float(1 << 52))
        return F.struct((F.lit(float(weight)) / -F.ln(u)).alias("score"), F.lit(-shard).alias("shard"))
    return -F.array_max(F.array(*[score(i, w) for i, w in enumerate(weights)]))["shard"]


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               weights: Sequence[float] = (1.0,) * SHARDS, new_weight: float = 1.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"),
                       F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    rows = rows.select("doc_id", (F.col("bytes") + 1).alias("size"), "text_crc32", rendezvous(key, weights).alias("shard"),
                       rendezvous(key, [*weights, new_weight]).alias("grown_shard"), _unit52(key).alias("place"))
    rows = cut_lineage(rows)
    buckets = int(rows.count() ** 0.5) + 1
    rows = rows.withColumn("bucket", F.shiftright(F.shiftright("place", 22) * buckets, 30))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offset = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = cut_lineage(counts.select("shard", "bucket", offset.alias("offset")))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("place", "doc_id", "size", "text_crc32")) - 1
    return (rows.withColumn("inside", inside).join(offsets, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                    (F.col("offset") + F.col("inside")).cast("long").alias("slot"), "grown_shard"))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS) -> None:
    """Write the rows with all their columns in one folder per shard."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    docs.withColumn("shard_", rendezvous(key, weights)).write.partitionBy("shard_").parquet(path)


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# CRC-32 by its table, which a rule makes; the bytes come from the hex form.
OP10_SQL = rf"""
WITH RECURSIVE steps(i, c, n) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM range(0, 256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n + 1 FROM steps WHERE n < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM steps WHERE n = 8),
k AS (
  SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS hx, coalesce(CAST(doc_id AS VARCHAR), '') AS key FROM documents),
x AS (
  SELECT doc_id, key, len(hx) + 1 AS size,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(hx, lambda h: CAST('0x' || h AS BIGINT))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS text_crc32
  FROM k, tab),
s AS (
  SELECT key, j, 1.0 / -ln((CAST('0x' || substr(md5(key || ':' || j), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS score
  FROM (SELECT DISTINCT key FROM k), range(0, {SHARDS + 1}) r(j)),
b AS (
  SELECT key, CAST(arg_max(j, (score, -j)) FILTER (j < {SHARDS}) AS INTEGER) AS shard, CAST(arg_max(j, (score, -j)) AS INTEGER) AS grown_shard
  FROM s GROUP BY key)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY CAST('0x' || substr(md5(key), 1, 13) AS BIGINT), doc_id, size, text_crc32) - 1 AS slot
FROM x JOIN b USING (key)
"""
