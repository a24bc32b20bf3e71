"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are equal), at
least ``powers`` (3 or more) periods and ``min_words`` words long, that no
neighbouring word extends. A task looks at whole texts, in slices of a megabyte
or one longer text. The symbols are pairs of text and word, words told apart byte
for byte, so nothing matches across texts. Per slice:

* prefix doubling ranks the substrings of 1, 2, 4, ... words. Positions whose
  substring occurs once keep their rank, so the work follows what repeats;
* a wavelet tree over the suffix array of the positions that repeat answers range
  successor: the next position, from any place on, where a given substring stands;
* every block of L = 2, 4, 8, ... words at a multiple of L asks for its
  occurrences in the two neighbouring windows of starts, one to L and L + 1 to
  2 L - 1 words on. A run with L <= q < 2 L holds such a block and its copy q
  words on (the least L also serves all shorter periods);
* the occurrences in a window form an arithmetic progression. Up to two of them
  are candidate periods themselves. Three or more mean that the block has their
  difference p as period; then q parts the ends of the block's and the
  occurrences' p-periodic stretches, or their beginnings, one of which lies
  inside the run;
* common extensions from the ranks stretch each candidate to both sides. Among
  candidates of one stretch the smallest is its period.

Defined cases: null and empty texts have no words and no runs; rows without id
and rows that repeat an id are looked at each; an empty table gives no rows;
further columns are ignored (``collapsed`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import map_texts, slices, tidy
from .wordarrays import word_array, word_ids

MIN_WORDS, POWERS = 24, 3


class Substrings:
    """Ranks of the substrings of 2**k symbols from every position on: the index,
    in the suffix array, of the first of the positions where the substring stands."""

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        _, which, count = np.unique(symbols, return_inverse=True, return_counts=True)
        self.ranks, self.sizes = [], []
        rank = (np.cumsum(count) - count)[which].astype(np.int32)
        size = count[which].astype(np.int32)
        while True:
            many = np.flatnonzero(size > 1)
            if len(many) == 0:
                break
            self.ranks.append(rank)
            self.sizes.append(size)
            step = 1 << (len(self.ranks) - 1)
            if step >= n:
                break
            # parts of a class are ordered by what follows; the text's end comes first
            after = np.zeros(len(many), np.int64)
            inside = many + step < n
            after[inside] = rank[many[inside] + step] + np.int64(1)
            key = rank[many].astype(np.int64) * (n + 1) + after
            order = np.argsort(key, kind="stable")
            many, key = many[order], key[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            old = rank[many]
            begin = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
            length = np.diff(np.append(first, len(many)))
            offset = np.repeat(first, length) - np.repeat(begin, np.diff(np.append(begin, len(many))))
            rank, size = rank.copy(), size.copy()
            rank[many] = old + offset
            size[many] = np.repeat(length, length)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j on are equal (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            a, b = i + out, j + out
            inside = b < self.n
            b = np.where(inside, b, 0)
            a = np.where(inside, a, 0)
            out += (inside & (self.ranks[k][a] == self.ranks[k][b])).astype(np.int64) << k
        return out

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j are equal (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            a, b = i - out - (1 << k), j - out - (1 << k)
            inside = a >= 0
            b = np.where(inside, b, 0)
            a = np.where(inside, a, 0)
            out += (inside & (self.ranks[k][a] == self.ranks[k][b])).astype(np.int64) << k
        return out


class WaveletTree:
    """Counts and order statistics of value ranges within index ranges of an array."""

    def __init__(self, values: np.ndarray, below: int):
        self.levels = []
        for bit in reversed(range(below.bit_length())):
            one = (values >> bit) & 1 == 1
            zeros = np.concatenate(([0], np.cumsum(~one))).astype(np.int32)
            self.levels.append((bit, zeros, zeros[-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in [lo, hi) are less than x."""
        out = np.zeros(len(lo), np.int64)
        for bit, zeros, total in self.levels:
            one = (x >> bit) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            out += np.where(one, b - a, 0)
            lo, hi = np.where(one, total + lo - a, a), np.where(one, total + hi - b, b)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value in [lo, hi) that k others precede in order."""
        out = np.zeros(len(lo), np.int64)
        for bit, zeros, total in self.levels:
            a, b = zeros[lo], zeros[hi]
            one = k >= b - a
            out |= np.where(one, 1 << bit, 0)
            k = np.where(one, k - (b - a), k)
            lo, hi = np.where(one, total + lo - a, a), np.where(one, total + hi - b, b)
        return out


def find_runs(symbols: np.ndarray, min_words: int = MIN_WORDS, powers: int = POWERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a sequence, by start, then period."""
    if powers < 3 or min_words < 2:
        raise ValueError("runs need three or more powers and two or more words")
    subs = Substrings(symbols)
    least = max(0, ((min_words + 1) // 3).bit_length() - 1)
    found = [_stretched(subs, block, q, min_words, powers) for block, q in _candidates(subs, least, powers)]
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    start, end, q = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    first = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))[:len(start)]
    start, end, q = start[first], end[first], q[first]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _candidates(subs: Substrings, least: int, powers: int):
    """Per block length, blocks that occur again nearby and candidate periods."""
    if len(subs.ranks) <= least:
        return
    again = subs.sizes[least] > 1
    place = np.flatnonzero(again)
    suffixes = place[np.argsort(subs.ranks[-1][place], kind="stable")]
    # ranks count all suffixes; the tree holds those that repeat
    held = np.concatenate(([0], np.cumsum(np.bincount(subs.ranks[-1][place], minlength=subs.n))))
    tree = WaveletTree(suffixes, subs.n)
    for k in range(least, len(subs.ranks)):
        length = 1 << k
        if k > least and powers * length > subs.n:
            return
        block = np.arange(0, subs.n, length)
        block = block[subs.sizes[k][block] > 1]
        if not len(block):
            continue
        lo = held[subs.ranks[k][block]]
        hi = lo + subs.sizes[k][block]
        for first, last in ((1, length), (length + 1, 2 * length - 1)):
            before = tree.below(lo, hi, np.minimum(block + first, subs.n))
            n = tree.below(lo, hi, np.minimum(block + last + 1, subs.n)) - before
            one, two, more = (np.flatnonzero(n >= m) for m in (1, 2, 3))
            at = np.zeros((3, len(block)), np.int64)  # first, second and last occurrence
            at[0, one] = tree.smallest(lo[one], hi[one], before[one])
            at[1, two] = tree.smallest(lo[two], hi[two], before[two] + 1)
            at[2, two] = tree.smallest(lo[two], hi[two], (before + n)[two] - 1)
            yield block[one], at[0, one] - block[one]
            yield block[two], at[1, two] - block[two]
            yield block[two], at[2, two] - block[two]
            own, far, p = block[more], at[0, more], (at[1] - at[0])[more]
            ends = far + subs.ahead(far, far + p) - own - subs.ahead(own, own + p)
            begins = far - subs.behind(far, far + p) - own + subs.behind(own, own + p)
            for q in (ends, begins):
                yield own[q > 0], q[q > 0]


def _stretched(subs: Substrings, block: np.ndarray, q: np.ndarray, min_words: int, powers: int):
    """The stretches around blocks that keep a candidate period, if long enough."""
    inside = block + q < subs.n
    block, q = block[inside], q[inside]
    start = block - subs.behind(block, block + q)
    end = block + q + subs.ahead(block, block + q)
    long = end - start >= np.maximum(min_words, powers * q)
    return start[long], end[long], q[long]


class Scan:
    """Words and runs of a column of texts: per run its text and, within the
    text, its first word, length and period. ``source`` may replace words: given
    the words' counts per text, it returns the index of the word to stand at each."""

    def __init__(self, column: pa.Array, min_words: int = MIN_WORDS, powers: int = POWERS, source: Callable | None = None):
        self.words, self.first = word_array(column)
        ids = word_ids(self.words)
        if source is not None:
            at = source(self.first)
            self.words, ids = self.words.take(pa.array(at)), ids[at]
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        begin, end, self.period = find_runs(owner * (int(ids.max(initial=0)) + 1) + ids, min_words, powers)
        self.text = owner[begin]
        self.start, self.length = begin - self.first[self.text], end - begin
        cover = np.zeros(len(ids) + 1, np.int64)  # words after the first period of a run
        np.add.at(cover, begin + self.period, 1)
        np.add.at(cover, end, -1)
        self.dropped = np.cumsum(cover)[:-1] > 0

    def kept_texts(self) -> pa.Array:
        """The words that stay, joined by one space, per text."""
        kept = np.concatenate(([0], np.cumsum(~self.dropped)))[self.first]
        lists = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), self.words.filter(pa.array(~self.dropped)))
        return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  powers: int = POWERS) -> DataFrame:
    """(doc_id, start, length, period), one row per run, in words."""
    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Scan(batch.column("text"), min_words, powers)
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(s.text)), pa.array(s.start), pa.array(s.length),
                                           pa.array(s.period)], ["doc_id", "start", "length", "period"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, scan, "doc_id long, start long, length long, period long")


def collapsed(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, powers: int = POWERS) -> DataFrame:
    """The documents, all columns kept; a text with runs keeps each run's first
    period and its other words, joined by one space, any other text stays as it is."""
    def run(batches):
        tidy()
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20, 4096):
                at = part.schema.get_field_index(text_col)
                s = Scan(part.column(at), min_words, powers)
                has = np.zeros(part.num_rows, bool)
                has[s.text] = True
                text = pc.if_else(pa.array(has), s.kept_texts().cast(part.schema.field(at).type), part.column(at))
                yield part.set_column(at, part.schema.field(at), text)

    return docs.mapInArrow(run, docs.schema)


def _planted(first: np.ndarray, crc: list[int | None]) -> np.ndarray:
    """The contract's plants: in texts with crc % 10 = 0 the words from one place on repeat."""
    at = np.arange(first[-1])
    for begin, end, h in zip(first[:-1].tolist(), first[1:].tolist(), crc, strict=True):
        n = end - begin
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            at[begin + a:end] = begin + a + np.arange(n - a) % p
    return at


def _digest(batch: pa.RecordBatch) -> pa.RecordBatch:
    s = Scan(batch.column("text"), source=lambda first: _planted(first, batch.column("crc").to_pylist()))
    of = defaultdict(list)
    for text, *run in zip(s.text.tolist(), s.start.tolist(), s.length.tolist(), s.period.tolist(), strict=True):
        of[text].append(tuple(run))  # by start, then period
    none = hashlib.sha256(b"").hexdigest()
    n_runs, best, listed = [], [], []
    for i in range(batch.num_rows):
        runs = of.get(i, ())
        top = None
        for run in runs:
            if top is None or run[1] * top[2] > top[1] * run[2]:  # the exact quotients, crosswise
                top = run
        n_runs.append(len(runs))
        best.append((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
        listed.append(hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest() if runs else none)
    kept = [hashlib.sha256(t).hexdigest() for t in s.kept_texts().to_pylist()]
    columns = [pa.array([b[c] for b in best], pa.int64()) for c in range(4)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_runs, pa.int64()), *columns, pa.array(listed), pa.array(kept)],
                                      ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("crc"))
    return map_texts(rows, _digest, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                                    "runs_sha256 string, collapsed_sha256 string")
