"""A corpus pipeline from the operators of starweave.llm.

Five stages, in this order: documents of no known language go; one document of
each near-duplicate group stays; documents contaminated by the benchmark go;
sources are mixed to their target weights, a document being repeated or left
out as a whole; the rest becomes token ids in binary files, whose records are
returned. Every stage reads what the one before it has written; all but the
last return the columns of ``documents``.

Defined cases follow the operators', except that near duplicates go row by row
where ids are null or repeated: one row of each group stays, the one of least
doc_id (null last), so copies without doc_id or under one doc_id go as well.
Rows that repeat a doc_id are mixed as the single document they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starweave.llm import decontaminate, language, mixing, neardup, tokenfiles
from starweave.session import cut_lineage


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    if not neardup.unique_ids(docs, "doc_id"):
        return _one_row_of_each_group(docs)
    found = neardup.near_duplicates(docs)
    copies = cut_lineage(found.filter("not kept and doc_id is not null").select(F.col("doc_id").alias("copy_of")).distinct(), docs.count())
    return docs.join(copies, docs["doc_id"] == copies["copy_of"], "left_anti")


def _one_row_of_each_group(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.struct(*docs.columns).alias("doc")).withColumn("near_row", F.monotonically_increasing_id())
    rows = cut_lineage(rows)  # each row keeps its number
    found = neardup.near_duplicates(rows.select("near_row", "doc.text"), "near_row").select(F.col("doc_id").alias("near_row"), "component_id")
    named = found.join(rows.select("near_row", "doc.doc_id"), "near_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "near_row"))
    stays = cut_lineage(named.groupBy("component_id").agg(first.alias("first")).select(F.col("first.near_row").alias("near_row")),
                        rows.count())
    return rows.join(stays, "near_row", "left_semi").select("doc.*")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, in whole documents.

    The mix takes stretches of a source's words, so few documents per source are
    taken in part. These are rounded along a line, by size: a document gets the
    rounded running sum of the parts less the one before it. The errors of
    neighbours on the line have opposite signs, so a source's words stay within
    one (partly taken) document of what the mix takes. Sources of one size and
    target share a line."""
    mixed = mixing.mix(docs).groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("size", "taken")],
                                                   *[F.max(c).alias(c) for c in ("source_size", "target")])
    rows = docs.count()
    mixed = cut_lineage(mixed.filter("taken > 0"), rows)
    part = F.col("taken") % F.col("size")
    line = Window.partitionBy("source_size", "target").orderBy("size", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    share = part / F.col("size")
    cut = mixed.filter(part > 0).withColumn("share", share).withColumn("upto", F.sum("share").over(line))
    rounded = F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - F.col("share") + 0.5)
    cut = cut.select(F.col("doc_id").alias("cut_id"), rounded.alias("more"))
    times = F.floor(F.col("taken") / F.col("size")) + F.coalesce("more", F.lit(0))
    kept = cut_lineage(mixed.join(cut, F.col("doc_id").eqNullSafe(F.col("cut_id")), "left")
                       .select("doc_id", times.cast("int").alias("times")).filter("times > 0"), rows)
    # the same plan at every size: the kept ids grow with the corpus
    whole = docs.select(F.struct(*docs.columns).alias("doc")).join(
        kept.hint("shuffle_hash"), F.col("doc.doc_id").eqNullSafe(F.col("doc_id")))
    return whole.withColumn("turn", F.explode(F.sequence(F.lit(1), "times"))).select("doc.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenfiles.tokenised(docs, tokenfiles.default_tokenizer())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

# Rank-order profiles and the tokenizer's merges are beyond SQL; the tests
# compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
