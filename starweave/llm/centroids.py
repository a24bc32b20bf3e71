"""Centroid clustering over an incremental distance matrix, in exact integers.

Vectors become integers, floor(256 * x). Every vector keeps its integer dot
product with each centroid: one row of the distance matrix, since
|v - c|^2 = |v|^2 - 2 v.c + |c|^2. A round reads the written state, adds to each
dot product the vector's components times the centroid's change, over the
components that changed and no others, takes the nearest centroid again and
writes the new state; a second, narrow pass sums the vectors of each cluster per
task batch, and Spark adds these partial sums. The driver holds centroids, counts
and sums only: k times dims numbers, whatever the number of vectors. States are
Parquet tables in the folder of ``spark.checkpoint.dir``; once the next state is
written, the one before is removed.

While dims * max(|component|)^2 stays below 2**51 the products run in float64,
which is exact there, and dot products are longs. Beyond, numbers are Python
integers, dot products are kept as text and sums go through Spark in digits of
2**30, so results stay exact; a distance or an inertia above the range of a long
is then held to that range.

Defined cases: vectors that are null, of another length, or hold null, NaN or
infinite components take no part; every row of a repeated id is a vector of its
own; rows without id follow all others in the order of starting centroids, equal
hashes go by the vector; fewer vectors than k start as many centroids; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SCALE = 256
K, DIMS, ROUNDS, SEED = 40, 64, 5, 2
EXACT = 1 << 51
ROWS_AT_ONCE = 4096
DIGIT = 30  # bits of a digit of wide sums
LONGEST = (1 << 63) - 1


def _usable(embeddings: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the vectors that take part."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter((F.size("vector") == dims) & whole)


def _integers(lists: pa.Array, dims: int, wide: bool) -> np.ndarray:
    """floor(256 * x) of lists of doubles, one row per vector."""
    x = lists.flatten().to_numpy()
    if not wide:
        return np.floor(SCALE * x).reshape(-1, dims)
    ratios = [a.as_integer_ratio() for a in x.tolist()]  # 256 * x may leave the range of a double
    return np.array([SCALE * a // b for a, b in ratios], object).reshape(-1, dims)


def _stored(numbers: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of whole numbers as lists; wide numbers are kept as text."""
    rows, columns = numbers.shape
    flat = numbers.ravel()
    flat = pa.array([str(x) for x in flat]) if pa.types.is_string(kind) else pa.array(flat.astype(kind.to_pandas_dtype()))
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * columns), flat)


def _loaded(lists: pa.Array, columns: int, wide: bool) -> np.ndarray:
    flat = lists.flatten()
    flat = np.array([int(x) for x in flat.to_pylist()], object) if wide else flat.to_numpy().astype(np.float64)
    return flat.reshape(-1, columns)


def _digits(total: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a whole number; the highest digit carries the sign."""
    place = 0
    while abs(total) >= EXACT:
        yield place, total & ((1 << DIGIT) - 1)
        total, place = total >> DIGIT, place + 1
    yield place, total


def starting_centroids(vectors: DataFrame, k: int, dims: int, seed: int) -> list[list[int]]:
    """The k vectors of smallest hash, as integers."""
    tag = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(tag.asc_nulls_last(), "vector").limit(k).collect()  # k rows
    if not first:
        return []
    lists = pa.array([r["vector"] for r in first], pa.list_(pa.float64()))
    return [[int(c) for c in row] for row in _integers(lists, dims, wide=True)]


def _update(dots: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> None:
    """Add the products of every vector with each centroid's change, component by
    changed component; ``dots`` is (k, n), ``vectors`` (dims, n)."""
    for c, delta in enumerate(change):
        moved = np.flatnonzero(delta)
        if len(moved):
            dots[c] += delta[moved] @ vectors[moved]


def _nearest(dots: np.ndarray, vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster (smallest number among equals) and squared distance of each vector."""
    distance = (centroids * centroids).sum(1)[:, None] - 2 * dots
    cluster = distance.argmin(0)
    return cluster, distance[cluster, np.arange(dots.shape[1])] + (vectors * vectors).sum(0)


class Matrix:
    """Centroids on the driver and the written state of all vectors."""

    def __init__(self, vectors: DataFrame, centroids: list[list[int]], wide: bool):
        self.vectors, self.wide, self.dims = vectors, wide, len(centroids[0])
        self.centroids = np.array(centroids, object)
        self.products_of = np.zeros_like(self.centroids)  # the centroids that the dot products stand for
        self.state, self.folder = None, None

    def assign(self) -> None:
        """Write the state under the present centroids."""
        spark = self.vectors.sparkSession
        vector, dot = ("string", "string") if self.wide else ("int", "long")
        schema = f"vec_id long, vector array<{vector}>, dots array<{dot}>, cluster int, distance long"
        source = self.vectors if self.state is None else self.state.select("vec_id", "vector", "dots")
        folder = os.path.join(ensure_checkpoint_dir(spark), "cut", uuid.uuid4().hex)
        source.mapInArrow(self._step(first=self.state is None), schema).write.option("compression", "zstd").parquet(folder)
        if self.folder is not None:
            _remove(spark, self.folder)
        self.folder, self.state = folder, spark.read.schema(schema).parquet(folder)
        self.products_of = self.centroids.copy()

    def _step(self, first: bool):
        dims, wide, kind = self.dims, self.wide, object if self.wide else np.float64
        centroids, change = self.centroids.astype(kind), (self.centroids - self.products_of).astype(kind)
        vector_type, dot_type = (pa.string(), pa.string()) if wide else (pa.int32(), pa.int64())

        def step(batches):
            for batch in batches:
                for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(i, ROWS_AT_ONCE)
                    if first:
                        rows = _integers(part.column("vector"), dims, wide)
                        dots = np.zeros((len(centroids), len(rows)), kind)
                    else:
                        rows = _loaded(part.column("vector"), dims, wide)
                        dots = np.ascontiguousarray(_loaded(part.column("dots"), len(centroids), wide).T)
                    vectors = np.ascontiguousarray(rows.T)
                    _update(dots, vectors, change)
                    cluster, distance = _nearest(dots, vectors, centroids)
                    held = pa.array([min(int(d), LONGEST) for d in distance.tolist()], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id"), _stored(rows, vector_type), _stored(dots.T, dot_type), pa.array(cluster, pa.int32()), held],
                        ["vec_id", "vector", "dots", "cluster", "distance"])

        return step

    def move(self) -> None:
        """Every centroid with vectors becomes the floor of their mean."""
        dims, wide = self.dims, self.wide

        def sums(batches):
            """(cluster, component, place, total), component -1 being the count."""
            for batch in batches:
                cluster, vectors = batch.column("cluster").to_numpy(), _loaded(batch.column("vector"), dims, wide)
                order = np.argsort(cluster, kind="stable")
                used, begin = np.unique(cluster[order], return_index=True)
                out = [(c, -1, 0, n) for c, n in zip(used.tolist(), np.diff(np.append(begin, len(order))).tolist(), strict=True)]
                for c, row in zip(used.tolist(), np.add.reduceat(vectors[order], begin, axis=0), strict=True):
                    out += [(c, j, place, digit) for j, total in enumerate(row) for place, digit in _digits(int(total))]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)],
                                                 ["cluster", "component", "place", "total"])

        partial = self.state.select("cluster", "vector").mapInArrow(sums, "cluster long, component long, place long, total long")
        whole = partial.groupBy("cluster", "component", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        counts, totals = [0] * len(self.centroids), np.zeros_like(self.centroids)
        for r in whole.collect():  # k * (dims + 1) sums
            if r["component"] < 0:
                counts[r["cluster"]] = int(r["total"])
            else:
                totals[r["cluster"], r["component"]] += int(r["total"]) << (DIGIT * r["place"])
        for c, n in enumerate(counts):
            if n:
                self.centroids[c] = totals[c] // n


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cluster(embeddings: DataFrame, k: int = K, dims: int = DIMS, rounds: int = ROUNDS, seed: int = SEED,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, vector in whole numbers, cluster, distance) of every vector under
    the final centroids, and these as lists of integers."""
    vectors = _usable(embeddings, dims, id_col, vector_col)
    centroids = starting_centroids(vectors, k, dims, seed)
    if not centroids:
        return vectors.select("*", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), []
    largest = vectors.select(F.max(F.array_max(F.transform("vector", F.abs))).alias("x")).first()["x"]
    matrix = Matrix(vectors, centroids, wide=dims * (SCALE * largest + 1) ** 2 >= EXACT)
    for _ in range(rounds):
        matrix.assign()
        matrix.move()
    matrix.assign()
    return matrix.state.drop("dots"), [[int(x) for x in c] for c in matrix.centroids]


def op11_centroids(spark, sf_dir: str) -> DataFrame:
    found, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    inertia = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(total).collect()}  # k rows
    whole = min(LONGEST, sum(inertia.values()))
    named = [(i, min(LONGEST, inertia.get(i, 0)), whole, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for i, c in enumerate(centroids)]
    named = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """Rounds written out one after another."""
    parts = [f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, embedding,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(e) AS x, unnest(range({DIMS})) AS j FROM v),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, embedding) - 1 AS c, e FROM v
  ORDER BY c LIMIT {K})"""]
    for i in range(ROUNDS + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT v.r, k.c, list_sum(list_transform(list_zip(v.e, k.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i} k)
  GROUP BY r)""")
        if i < ROUNDS:
            parts.append(f"""
s{i} AS MATERIALIZED (
  SELECT best.c AS c, j, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM a{i} JOIN x USING (r) GROUP BY ALL),
m{i} AS MATERIALIZED (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS e FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT k.c, coalesce(m{i}.e, k.e) AS e FROM c{i} k LEFT JOIN m{i} USING (c))""")
    return ",".join(parts) + f"""
SELECT v.vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(k.e, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} k ON k.c = best.c
"""


OP11_SQL = _sql()
