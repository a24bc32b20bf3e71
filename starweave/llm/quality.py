"""Quality scores by a factorisation machine.

Features of a text: its lowered words, hashed, with logarithmic counts of unit
length; statistics of its structure (lengths, character classes, repetition)
and its size, each as one of a few steps; and numeric metadata columns
(``documents.n_chars``), each as one of a few logarithmic steps. A score adds
weights and the pairwise products of low-rank factors; the products of all pairs
are summed in linear time as half of (square of the sum - sum of the squares) per
factor.

Training: a sample bounded in rows and bytes comes to the driver as sparse rows
and is fitted by AdaGrad in a fixed order. It takes one row of each labelled id,
in the order of the ids' hashes, up to TRAIN_ROWS rows and TRAIN_BYTES bytes of
features. Scoring covers every whole text in the tasks.

Defined cases: null and empty texts are scored by their statistics and metadata;
metadata that is null, no number or in no column of the table is a step of its own,
numbers below zero are another; of rows that repeat an id the one with the greatest
text (null the least) is learned from;
labels of one document that differ count as the larger one; null labels and
labels without a document are left out; without labels every score is 0.5; rows
with a null id are not held out and never learned from; rows that repeat an id
are rows of their own; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .language import remainder
from .textscan import SPACE_WORDS, U64, Words, map_texts, utf8, words

TRAIN_ROWS, TRAIN_BYTES = 10_000, 256 << 20
META_COLS = ("n_chars",)
BITS, FACTORS = 16, 8
STEPS, STATS = 24, 12
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.1, 1e-5

_CLASSES = np.zeros((6, 256), bool)  # upper, digit, white space, line end, ASCII sign, beyond ASCII
_CLASSES[0, 0x41:0x5B] = _CLASSES[1, 0x30:0x3A] = _CLASSES[3, 0x0A] = _CLASSES[5, 0x80:] = True
_CLASSES[2] = ~SPACE_WORDS
_CLASSES[4, 0x21:0x7F] = True
_CLASSES[4, 0x30:0x3A] = _CLASSES[4, 0x41:0x5B] = _CLASSES[4, 0x61:0x7B] = False


def meta_steps(values: np.ndarray) -> np.ndarray:
    """The step of each number: 0 without one, 1 below zero, then by its logarithm."""
    known = ~np.isnan(values)
    size = np.log2(1 + np.clip(np.where(known, values, 0), 0, 2.0 ** (STEPS - 3)))
    return np.where(known, np.where(values < 0, 1, 2 + size.astype(np.int64)), 0)


def features(column: pa.Array, meta: Sequence[np.ndarray] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature indexes, values, offsets of the texts) as sparse rows; ``meta``
    holds arrays of one number per text, NaN for none."""
    found = words(column, SPACE_WORDS)
    data, offsets = utf8(column)
    n = len(offsets) - 1
    owner = found.owner()
    key = np.sort(owner << BITS | (found.hash & U64((1 << BITS) - 1)).astype(np.int64))
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    text, index = key[new] >> BITS, key[new] & ((1 << BITS) - 1)
    value = 1 + np.log(count)
    length = np.sqrt(np.bincount(text, value * value, n))
    value = value / length[text]
    stats = _statistics(found, data, offsets, text, count)
    step = np.clip((stats * STEPS).astype(np.int64), 0, STEPS - 1)
    step = np.column_stack([step, *[meta_steps(m) for m in meta]])
    wide = step.shape[1]
    own = (1 << BITS) + np.arange(wide) * STEPS + step
    per = np.bincount(text, minlength=n)
    end = np.cumsum(per)
    place = np.repeat(end, wide)
    index = np.insert(index, place, own.reshape(-1)).astype(np.int32)
    value = np.insert(value, place, 1 / np.sqrt(STATS)).astype(np.float32)
    return index, value, np.concatenate(([0], end + wide * np.arange(1, n + 1)))


def _statistics(found: Words, data, offsets, text, count) -> np.ndarray:
    """(texts, STATS) numbers from 0 to 1."""
    n, size, total = len(offsets) - 1, np.diff(offsets), found.counts
    share = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets]) / np.maximum(size, 1)
    shares = [share(c[data]) for c in _CLASSES]
    distinct = np.bincount(text, minlength=n) / np.maximum(total, 1)
    top = np.zeros(n)
    np.maximum.at(top, text, count)
    owner = found.owner()
    again = (found.hash[1:] == found.hash[:-1]) & (owner[1:] == owner[:-1]) if len(owner) else np.empty(0, bool)
    signed_end = _CLASSES[4][data[found.end - 1]] if len(owner) else np.empty(0, bool)
    per_word = np.maximum(total, 1)
    return np.stack([
        np.sqrt(shares[0]), np.sqrt(shares[1]), shares[2], np.sqrt(shares[3]), np.sqrt(shares[4]), np.sqrt(shares[5]),
        np.log2(1 + total) / 16, np.minimum(1, size / per_word / 24), distinct, top / per_word,
        np.bincount(owner[1:][again], minlength=n) / per_word, np.bincount(owner[signed_end], minlength=n) / per_word], axis=1)


class Machine:
    """Weights and factors; ``rows`` are (index, value, offsets) as features() gives,
    with ``metas`` columns of metadata."""

    def __init__(self, seed: int = 1, metas: int = 0):
        dims = (1 << BITS) + (STATS + metas) * STEPS
        self.bias, self.w = np.float32(0), np.zeros(dims, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (dims, FACTORS)).astype(np.float32)

    def margin(self, index, value, offsets):
        """Margins, and the factors' sums that the gradients need."""
        if len(offsets) == 1:
            return np.empty(0, np.float32), np.empty((0, FACTORS), np.float32)
        vx = self.v[index] * value[:, None]
        sums = np.add.reduceat(vx, offsets[:-1])  # no row is empty
        squares = np.add.reduceat(vx * vx, offsets[:-1])
        linear = np.add.reduceat(self.w[index] * value, offsets[:-1])
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def fit(self, index, value, offsets, label, epochs: int = EPOCHS) -> Machine:
        positive = label.mean()
        if not len(label) or positive in (0, 1):
            self.bias = np.float32(0 if not len(label) else 6 * (2 * positive - 1))
            return self
        gw, gv = np.full(len(self.w), 1e-6, np.float32), np.full(self.v.shape, 1e-6, np.float32)
        self.bias = np.float32(np.log(positive / (1 - positive)))
        order = np.random.default_rng(2)
        for _ in range(epochs):
            turn = order.permutation(len(label))
            for i in range(0, len(turn), BATCH):
                rows = turn[i:i + BATCH]
                n = (offsets[rows + 1] - offsets[rows]).astype(np.int64)
                own = np.concatenate(([0], np.cumsum(n)))
                at = np.arange(own[-1]) + np.repeat(offsets[rows] - own[:-1], n)
                ix, x = index[at], value[at]
                m, sums = self.margin(ix, x, own)
                error = np.repeat(1 / (1 + np.exp(-m)) - label[rows], n).astype(np.float32)
                ex = error * x
                seen, which = np.unique(ix, return_inverse=True)
                dw = np.bincount(which, ex, len(seen)).astype(np.float32) + DECAY * self.w[seen]
                pull = ex[:, None] * (np.repeat(sums, n, axis=0) - self.v[ix] * x[:, None])
                dv = np.stack([np.bincount(which, pull[:, f], len(seen)) for f in range(FACTORS)], axis=1).astype(np.float32)
                dv += DECAY * self.v[seen]
                gw[seen] += dw * dw
                gv[seen] += dv * dv
                self.w[seen] -= RATE * dw / np.sqrt(gw[seen])
                self.v[seen] -= RATE / 2 * dv / np.sqrt(gv[seen])
        return self


def _metas(part: pa.RecordBatch) -> list[np.ndarray]:
    return [part.column(name).to_numpy(zero_copy_only=False).astype(np.float64)
            for name in part.schema.names if name.startswith("meta_")]


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> pa.Table:
    """(id, label, index, value) of labelled documents in the order of their ids:
    those first by hash, at most ``rows`` of them and ``max_bytes`` of features."""
    order = [F.xxhash64("id"), F.col("id")]
    chosen = (labels.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
              .orderBy(*order).limit(rows))
    content = ["text", *[c for c in docs.columns if c.startswith("meta_")]]

    def sparse(part: pa.RecordBatch) -> pa.RecordBatch:
        index, value, offsets = features(part.column("text"), _metas(part))
        at = pa.array(offsets, pa.int32())
        return pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("label"), pa.ListArray.from_arrays(at, pa.array(index)), pa.ListArray.from_arrays(at, pa.array(value))],
            ["id", "label", "index", "value"])

    known = (docs.join(F.broadcast(chosen), "id")  # at most `rows` ids
             .groupBy("id", "label").agg(F.max(F.struct(*content)).alias("one")).select("id", "label", "one.*"))
    found = cut_lineage(map_texts(known, sparse, "id long, label double, index array<int>, value array<float>"))
    sizes = found.select("id", order[0].alias("place"), (8 * F.size("index")).alias("bytes")).toPandas()  # at most `rows`
    sizes = sizes.sort_values(["place", "id"])
    within = sizes[sizes["bytes"].astype("int64").cumsum() <= max_bytes]
    if not len(within):
        return found.limit(0).toArrow()
    last = within.iloc[-1]
    return found.filter((order[0] < int(last["place"])) | ((order[0] == int(last["place"])) & (F.col("id") <= int(last["id"])))).toArrow()


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> Machine:
    """Fit on a bounded sample of documents (id, text, meta_*) with (id, label)."""
    table, metas = sample(docs, labels, rows, max_bytes), sum(c.startswith("meta_") for c in docs.columns)
    if not table.num_rows:
        blank = Machine(metas=metas)
        blank.v[:] = 0
        return blank
    table = table.sort_by([("id", "ascending")]).combine_chunks()
    lists = table.column("index").combine_chunks()
    return Machine(metas=metas).fit(
        lists.flatten().to_numpy(), table.column("value").combine_chunks().flatten().to_numpy(),
        np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy().astype(np.int64)))), table.column("label").to_numpy())


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) for (id, held_out, text, meta_*)."""
    def score(part: pa.RecordBatch) -> pa.RecordBatch:
        margin, _ = machine.margin(*features(part.column("text"), _metas(part)))
        p = 1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -500, 500)))
        return pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"])

    return map_texts(docs, score, "doc_id long, held_out boolean, score double, predicted int", max_bytes=1 << 20)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   meta_cols: Sequence[str] = META_COLS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    metas = [(F.col(c).try_cast("double") if c in docs.columns else F.lit(None).cast("double")).alias(f"meta_{i}")
             for i, c in enumerate(meta_cols)]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *metas)
    learned = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label")).filter(remainder(F.col("id"), 3) != 1)
    machine = train(rows, learned)
    return scored(rows.withColumn("held_out", F.coalesce(remainder(F.col("id"), 3) == 1, F.lit(False))), machine)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
