"""Connected components of an edge table by Spark joins.

Every task first runs a union-find over its own edges and keeps a spanning
forest; star rounds (each node hands its neighbours to its smallest one) then
join the forests of all tasks. Node tables and minima are written between the
rounds, so that the joins start from fresh exchanges whose hot keys Spark can
split, and nothing but counts and checksums reaches the driver. The tables are
written in files by the number of edges, not by that of shuffle partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and each node's smallest reachable node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(at[:len(a)].tolist(), at[len(a):].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:  # indexes follow the nodes' order: the smaller one stays
            parent[max(x, y)] = min(x, y)
    return nodes, nodes[np.fromiter((root(i) for i in range(len(nodes))), np.int64, len(nodes))]


def _forest(batches):
    for batch in batches:
        node, low = union_find(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        keep = node != low
        yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(low[keep])], ["a", "b"])


def _hand(edges: DataFrame, key: str, rows: int) -> DataFrame:
    """Edges with ``m``, the smallest ``b`` of their key, from two written tables."""
    low = cut_lineage(edges.groupBy(F.col(key).alias("k")).agg(F.min("b").alias("m")), rows)
    return edges.join(low, edges[key] == low["k"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edge table (a, b), both long and
    not null; ``component`` is the smallest node that it reaches."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    rows = 2 * edges.count()  # no round has more edges, either way
    stars = cut_lineage(pairs.mapInArrow(_forest, "a long, b long").distinct(), rows)
    mark = None
    while True:
        now = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == mark:
            break
        mark = now
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_hand(both, "a", rows).filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
                 .filter("a <> b").distinct())
        large = cut_lineage(large, rows)
        handed = _hand(large, "a", rows)
        stars = cut_lineage(handed.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                            .unionByName(handed.select("a", F.col("m").alias("b"))).distinct(), rows)
    low = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(low)
