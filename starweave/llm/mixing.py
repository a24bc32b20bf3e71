"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources, by code point with null last, weigh 5, 2, 1, repeating. They share all
words in proportion; a source stops at three times its own size and the excess
is reshared by weight. In closed form: sorted by size per weight, the sources
that reach their cap come first, and the others all get weight times one level.

Words are then taken in equal blocks. The number of blocks is apportioned to
the sources by highest quotients ``target / (2j - 1)``, and each source's
blocks to its shards, again by highest quotients. A source's documents stand
in a seeded order, end to end; its shards are equal stretches of that line.
Each shard takes all its blocks as often as its quota holds them, and the
rest of the quota as a run of blocks from a seeded place on. A source's last
block may be short and be taken up to three times, so that what is taken lies
within four blocks of the target.

A document's start on the line comes from sums of hash buckets and a running
sum within one bucket; both have about the square root of the row count as
members, so no task gets a whole source.

Defined cases: null text has size 0 and nothing taken; a null source is one
source; rows that repeat an id are documents of their own; a null id has its
own place in the order; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_WORDS = 16
SHARDS = 4
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def hash52(*parts) -> Column:
    """52 seeded bits of the text form of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """Adds weight and target to (source, source_size), one row per source."""
    one = Window.partitionBy(F.lit(1))
    order = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sources.withColumn("k", order.cast("long")).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("k") % len(WEIGHTS) + 1).cast("int")))
    weighed = weighed.withColumn("cap", (F.col("source_size") * CAP).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = one.orderBy("ratio", "k").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(one) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = rest / (F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    weighed = weighed.withColumn("level", level)
    free = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "k", "level"))).over(one)["level"]
    return weighed.withColumn("target", F.least("cap", F.coalesce(F.col("weight") * free, "cap"))).drop("ratio", "level", "cap")


def apportion(frame: DataFrame, group: str, member: str, votes: str, seats: str) -> DataFrame:
    """Adds ``quota``: the group's ``seats`` dealt to its members by the highest
    quotients votes / (2j - 1), ties to the smaller member.

    All seats above a level that surely holds too few, and candidates down to
    one that surely holds enough, are counted; only these candidates, at most
    four per member, are ranked.
    """
    whole = Window.partitionBy(group)
    q = F.col(votes) * F.col(seats) / F.sum(votes).over(whole)
    slack = F.count("*").over(whole) / F.col(seats)
    ready = (frame.filter(F.col(seats) > 0).withColumn("q", F.coalesce(q, F.lit(0.0))).withColumn("slack", slack)
             .withColumn("sure", F.greatest(F.lit(0).cast("long"), F.floor(F.col("q") * (1 - F.col("slack")) + 0.5)))
             .withColumn("most", F.floor(F.col("q") * (1 + F.col("slack")) + 0.5))
             .withColumn("open", F.col(seats) - F.sum("sure").over(whole)))
    tried = (ready.filter("most > sure").withColumn("j", F.explode(F.sequence(F.col("sure") + 1, F.col("most"))))
             .withColumn("place", F.row_number().over(whole.orderBy((F.col(votes) / (2 * F.col("j") - 1)).desc(), member, "j")))
             .filter("place <= open").groupBy(group, member).agg(F.count("*").alias("more")))
    sure = ready.select(F.col(group).alias("g_"), F.col(member).alias("m_"), "sure")
    return (frame.join(sure, (frame[group] == sure["g_"]) & (frame[member] == sure["m_"]), "left").drop("g_", "m_")
            .join(tried.select(F.col(group).alias("g_"), F.col(member).alias("m_"), "more"),
                  (F.col(group) == F.col("g_")) & (F.col(member) == F.col("m_")), "left").drop("g_", "m_")
            .withColumn("quota", F.coalesce("sure", F.lit(0)) + F.coalesce("more", F.lit(0))).drop("sure", "more"))


def plan(sources: DataFrame, block: int, shards: int, seed: str, rows: int | None = None) -> DataFrame:
    """One row per source, ``rows`` at most where that is known, with its target
    and the stretches that its shards take."""
    aimed = cut_lineage(targets(sources), rows)
    one = Window.partitionBy(F.lit(1))
    dealt = apportion(aimed.withColumn("all_", F.lit(1)).withColumn(
        "seats", F.floor(F.sum("source_size").over(one) / block + 0.5)), "all_", "k", "target", "seats")
    blocks = F.ceil(F.col("source_size") / block)
    dealt = dealt.withColumn("blocks", blocks).withColumn("seats", F.least("quota", F.col("blocks") * CAP)).drop("quota", "all_")
    cells = cut_lineage(dealt, rows).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "first", F.floor(F.col("shard") * F.col("blocks") / shards)).withColumn(
        "votes", F.floor((F.col("shard") + 1) * F.col("blocks") / shards) - F.col("first")).filter("votes > 0")
    cells = apportion(cells, "k", "shard", "votes", "seats")
    begin = F.pmod(hash52(F.lit(seed), F.col("k"), F.col("shard")), "votes")
    cells = cells.withColumn("rest", F.col("quota") % F.col("votes")).withColumn("begin", begin)
    end = F.least(F.col("first") + F.col("votes"), F.col("blocks"))
    word = lambda at: F.least(at * block, F.col("source_size")).cast("long")
    run = F.col("begin") + F.col("rest")
    cells = cells.select("k", F.struct(
        F.floor(F.col("quota") / F.col("votes")).cast("long").alias("times"), word(F.col("first")).alias("a"), word(end).alias("z"),
        word(F.col("first") + F.col("begin")).alias("a1"), word(F.col("first") + F.least(run, "votes")).alias("z1"),
        word(F.col("first") + F.greatest(run - F.col("votes"), F.lit(0))).alias("z2")).alias("stretch"))
    # at most `shards` stretches per source
    stretches = cells.groupBy("k").agg(F.collect_list("stretch").alias("stretches"))
    return cut_lineage(aimed.join(stretches, "k", "left").select("k", "source", "source_size", "target", "stretches"), rows)


def _overlap(x, y, a, z) -> Column:
    return F.greatest(F.least(y, z) - F.greatest(x, a), F.lit(0).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK_WORDS, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sized = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    rows = sized.count() or 1
    totals = cut_lineage(totals, rows)
    sources = plan(totals.drop("rows"), block, shards, seed, totals.count())
    buckets = int(rows ** 0.5) + 1
    place = hash52(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    keyed = sized.join(sources.select("k", "source"), sized["source"].eqNullSafe(sources["source"])).select(
        "k", "doc_id", "size", place.alias("place")).withColumn(
        "bucket", F.shiftright(F.shiftright("place", 22) * buckets, 30))
    sums = keyed.groupBy("k", "bucket").agg(F.sum("size").alias("words"))
    offset = F.sum("words").over(Window.partitionBy("k").orderBy("bucket")) - F.col("words")
    offsets = cut_lineage(sums.select("k", "bucket", offset.alias("offset")), rows)
    inside = F.sum("size").over(Window.partitionBy("k", "bucket").orderBy("place", "doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    lined = keyed.withColumn("inside", inside).join(offsets, ["k", "bucket"]).withColumn("x", F.col("offset") + F.col("inside"))
    lined = lined.withColumn("y", F.col("x") + F.col("size")).join(sources.drop("source"), "k")
    x, y = F.col("x"), F.col("y")
    taken = F.aggregate("stretches", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["times"] * _overlap(x, y, s["a"], s["z"])
                        + _overlap(x, y, s["a1"], s["z1"]) + _overlap(x, y, s["a"], s["z2"]))
    return lined.select("doc_id", "size", "source_size", "target", F.coalesce(taken, F.lit(0).cast("long")).alias("taken"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _apportion_sql(frame: str, group: str, member: str, votes: str) -> str:
    return f"""
  SELECT f.*, coalesce(sure, 0) + coalesce(more, 0) AS quota FROM {frame} f
  LEFT JOIN (SELECT {group} AS g, {member} AS m, sure FROM {frame}_r) s ON s.g = f.{group} AND s.m = f.{member}
  LEFT JOIN (
    SELECT g, m, count(*) AS more FROM (
      SELECT {group} AS g, {member} AS m, open, row_number() OVER (PARTITION BY {group} ORDER BY {votes} / (2 * j - 1) DESC, {member}, j) AS place
      FROM (SELECT *, unnest(range(sure + 1, most + 1)) AS j FROM {frame}_r WHERE most > sure)) WHERE place <= open GROUP BY g, m) t
  ON t.g = f.{group} AND t.m = f.{member}"""


def _ready_sql(frame: str, group: str, votes: str) -> str:
    return f"""
  SELECT *, seats - sum(sure) OVER (PARTITION BY {group}) AS open FROM (
    SELECT *, greatest(0, CAST(floor(q * (1 - slack) + 0.5) AS BIGINT)) AS sure, CAST(floor(q * (1 + slack) + 0.5) AS BIGINT) AS most FROM (
      SELECT *, coalesce({votes} * seats / sum({votes}) OVER (PARTITION BY {group}), 0.0) AS q,
        count(*) OVER (PARTITION BY {group}) / seats AS slack FROM {frame} WHERE seats > 0))"""


OP5_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s0),
s2 AS (SELECT *, [5, 2, 1][k % 3 + 1] AS weight, CAST(3 * source_size AS DOUBLE) AS cap, 3.0 * source_size / [5, 2, 1][k % 3 + 1] AS ratio FROM s1),
s3 AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM s2 WINDOW b AS (ORDER BY CAST(ratio AS DOUBLE), k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS MATERIALIZED (
  SELECT k, source, source_size,
    CAST(least(cap, coalesce(weight * (SELECT arg_min(level, (ratio, k)) FROM s3 WHERE ratio > level), cap)) AS DOUBLE) AS target FROM s3),
a AS MATERIALIZED (
  SELECT *, 1 AS all_, CAST(floor((SELECT sum(source_size) FROM s4) / {BLOCK_WORDS} + 0.5) AS BIGINT) AS seats FROM s4),
a_r AS MATERIALIZED ({_ready_sql("a", "all_", "target")}),
a_q AS ({_apportion_sql("a", "all_", "k", "target")}),
c0 AS (
  SELECT k, source_size, CAST(ceil(source_size / {BLOCK_WORDS}) AS BIGINT) AS blocks, quota, unnest(range(0, {SHARDS})) AS shard FROM a_q),
c1 AS (SELECT *, shard * blocks // {SHARDS} AS first, (shard + 1) * blocks // {SHARDS} - shard * blocks // {SHARDS} AS votes FROM c0),
c AS MATERIALIZED (SELECT k, source_size, blocks, shard, first, votes, CAST(least(quota, 3 * blocks) AS BIGINT) AS seats FROM c1 WHERE votes > 0),
c_r AS MATERIALIZED ({_ready_sql("c", "k", "votes")}),
c_q AS ({_apportion_sql("c", "k", "shard", "votes")}),
c2 AS (
  SELECT *, quota % votes AS rest, CAST('0x' || substr(md5('{SEED}:' || k || ':' || shard), 1, 13) AS BIGINT) % votes AS beg FROM c_q),
c3 AS MATERIALIZED (
  SELECT k, quota // votes AS times, least(first * {BLOCK_WORDS}, source_size) AS a, least((first + votes) * {BLOCK_WORDS}, source_size) AS z,
    least((first + beg) * {BLOCK_WORDS}, source_size) AS a1, least((first + least(beg + rest, votes)) * {BLOCK_WORDS}, source_size) AS z1,
    least((first + greatest(beg + rest - votes, 0)) * {BLOCK_WORDS}, source_size) AS z2 FROM c2),
l AS (
  SELECT d.doc_id, d.size, s4.k, s4.source_size, s4.target,
    sum(d.size) OVER (PARTITION BY s4.k ORDER BY CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT), doc_id, d.size
                      ROWS UNBOUNDED PRECEDING) - d.size AS x
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source)
SELECT doc_id, size, l.source_size, target, CAST(coalesce(sum(
    times * greatest(least(x + size, z) - greatest(x, a), 0) + greatest(least(x + size, z1) - greatest(x, a1), 0)
    + greatest(least(x + size, z2) - greatest(x, a), 0)), 0) AS BIGINT) AS taken
FROM l LEFT JOIN c3 ON c3.k = l.k GROUP BY doc_id, size, l.source_size, target
"""
