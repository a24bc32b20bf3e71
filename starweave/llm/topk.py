"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become integers, floor(256 * x). In a task, one block of query rows
meets one block of vectors: for each term (dimension) with weight in a query,
the term's postings, scaled by the weight, are added into dense score arrays;
a partition selection keeps each query's best, and a window merges the blocks'
candidates. Vectors and queries are both cut into blocks of bounded size, each
pair of blocks being one task's work.

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part, nor do rows without id; a vector's missing components count as
0; rows with the query's id are not its candidates; every query row asks, and
the pairs of rows that repeat a query id are ranked together; equal scores go
to the smaller id; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SCALE = 256
EVERY = 50
VECTOR_BLOCK, QUERY_BLOCK = 8192, 2048
ROWS_AT_ONCE = 64


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), dims))
    at = np.arange(dims)[None, :] < n[:, None]
    out[at] = np.floor(SCALE * lists.flatten().to_numpy().astype(np.float64))
    return out


def accumulate(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Scores (queries, vectors), term by term."""
    scores = np.zeros((len(queries), len(vectors)), queries.dtype)
    for term in range(queries.shape[1]):
        weight, posting = queries[:, term], vectors[:, term]
        asked, docs = np.flatnonzero(weight), np.flatnonzero(posting)
        if 2 * len(docs) > len(posting):  # a long list is added as a whole
            if len(asked) == len(weight):
                scores += weight[:, None] * posting
            else:
                scores[asked] += weight[asked, None] * posting
        elif len(docs) and len(asked):
            scores[np.ix_(asked, docs)] += weight[asked, None] * posting[docs]
    return scores


def _best(k: int):
    def search(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not queries.num_rows or not vectors.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64())] * 3, names)
        dims = max(int(np.diff(t.column("vector").combine_chunks().offsets.to_numpy()).max()) for t in (queries, vectors))
        q, v = _matrix(queries.column("vector"), dims), _matrix(vectors.column("vector"), dims)
        bound = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * dims
        if bound < 2 ** 31:
            q, v = q.astype(np.int32), v.astype(np.int32)
        elif bound < 2 ** 62:
            q, v = q.astype(np.int64), v.astype(np.int64)
        else:  # whole numbers of any size; results are held to the range of a long
            q, v = (np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape) for m in (q, v))
        asked, ids = queries.column("vec_id").to_numpy(), vectors.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], v[order]
        out = []
        for i in range(0, len(asked), ROWS_AT_ONCE):
            scores = accumulate(q[i:i + ROWS_AT_ONCE], v)
            for query, row in zip(asked[i:i + ROWS_AT_ONCE].tolist(), scores, strict=True):
                others = np.concatenate([np.arange(np.searchsorted(ids, query)), np.arange(np.searchsorted(ids, query, "right"), len(ids))])
                row = row[others]
                if len(row) > k:
                    least = np.partition(row, len(row) - k)[len(row) - k]
                    others, row = others[row >= least], row[row >= least]
                first = np.argsort(-row, kind="stable")[:k]  # ids ascend among equals
                limit = 2 ** 63 - 1
                out += [(query, i_, max(-limit - 1, min(limit, int(s)))) for i_, s in
                        zip(ids[others[first]].tolist(), row[first].tolist(), strict=True)]
        return pa.Table.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names)

    return search


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best pairs of each query id's rows with other vectors."""
    def usable(frame: DataFrame) -> DataFrame:
        whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (frame.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
                .filter("vec_id is not null and vector is not null").filter(whole))

    vectors = usable(embeddings)
    asked = cut_lineage(usable(queries).withColumn("turn", F.monotonically_increasing_id()))
    chunks, blocks = (F.lit(-(-frame.count() // size) or 1).cast("long") for frame, size in ((vectors, VECTOR_BLOCK), (asked, QUERY_BLOCK)))
    dealt = (vectors.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), chunks))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))))
    sent = (asked.withColumn("block", F.pmod(F.xxhash64("turn"), blocks)).drop("turn")
            .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))))
    found = (sent.groupBy("chunk", "block").cogroup(dealt.groupBy("chunk", "block"))
             .applyInArrow(_best(k), "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_top_k(spark, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(embeddings, embeddings.filter(F.col("vec_id") % EVERY == 0))


OP6_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
