"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The symbols are words (runs of ASCII letters, digits and non-ASCII characters,
A-Z lowered). Patterns are all windows of 13 consecutive words of a benchmark
item; an item of fewer words is one pattern. Patterns of one length form a
search table: blocks of two words index a shift table, so that a scan jumps
over positions where no pattern can end; a zero shift looks up the bucket of
the block as a pattern's suffix, and the stretch is then compared directly,
word by word.

The scan of a batch moves one lane per stretch of text through the words at
once. Patterns are taken from the driver in blocks of bounded size, whatever
the size of the benchmark: each block scans the documents and what it finds is
united by document.

Defined cases: null or wordless texts have no words and are clean; items
without words hold no window; an item without id is named by the empty string; windows shared by items count for each of them;
rows that repeat a doc_id are judged each by itself; an empty benchmark leaves
everything clean; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rows import keyed_rows
from .textscan import ALNUM_WORDS, U64, Words, keep_rows, map_texts, ranges, same_words, spans, words

WINDOW = 13
PATTERN_BYTES = 16 << 20  # benchmark text that one scan of the documents looks for
SHIFT_BITS = 18
LANE = 512


@dataclass
class Table:
    """Search table for patterns of one length. A pattern is a place in the
    items' words; equal windows of several items share one."""

    length: int
    block: int
    shift: np.ndarray      # by block hash: how far a scan may jump
    suffix: np.ndarray     # block hash of each pattern's end, sorted
    place: np.ndarray      # the patterns' first words, in that order
    owners: np.ndarray     # item indexes of all patterns, one pattern after another
    owned: np.ndarray      # where each pattern's owners begin, with the total at the end


def _block_hash(hashes: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    """Table index of the ``block`` words that end at each position."""
    h = hashes[at] * U64(0x9E3779B97F4A7C15)
    if block == 2:
        h = h + hashes[at - 1] * U64(0xC2B2AE3D27D4EB4F)
    return (h >> U64(64 - SHIFT_BITS)).astype(np.int64)


def _same_windows(a: Words, i: np.ndarray, b: Words, j: np.ndarray, length: int) -> np.ndarray:
    """Whether the windows from words i and j on are equal: by hash first, then
    word by word, byte for byte."""
    live = np.arange(len(i))
    for k in range(length):
        live = live[a.hash[i[live] + k] == b.hash[j[live] + k]]
    for k in range(length):
        live = live[same_words(a, i[live] + k, b, j[live] + k)]
    out = np.zeros(len(i), bool)
    out[live] = True
    return out


def tables(items: Words, window: int = WINDOW) -> list[Table]:
    """Search tables for all windows of the items, one for each length."""
    first, count = items.first[:-1], items.counts
    size = np.minimum(count, window)
    out = []
    for length in np.unique(size[size > 0]).tolist():
        own = np.flatnonzero(size == length)
        n = count[own] - length + 1
        place, owner = ranges(first[own], n), np.repeat(own, n)
        # windows of one hash are one pattern if their words agree
        whole = spans(items.hash, place, place + length)
        _, one, which = np.unique(whole, return_index=True, return_inverse=True)
        odd = np.flatnonzero(~_same_windows(items, place, items, place[one][which], length))
        which[odd] = len(one) + np.arange(len(odd))
        order = np.lexsort((owner, which))
        which, owner = which[order], owner[order]
        distinct = np.concatenate(([True], (which[1:] != which[:-1]) | (owner[1:] != owner[:-1])))
        which, owner = which[distinct], owner[distinct]
        place = np.concatenate([place[one], place[odd]])
        block = min(2, length)
        shift = np.full(1 << SHIFT_BITS, length - block + 1, np.int64)
        for end in range(block - 1, length):
            np.minimum.at(shift, _block_hash(items.hash, place + end, block), length - 1 - end)
        suffix = _block_hash(items.hash, place + length - 1, block)
        order = np.argsort(suffix, kind="stable")
        begin = np.searchsorted(which, np.arange(len(place) + 1))
        held = np.diff(begin)[order]
        out.append(Table(length, block, shift, suffix[order], place[order], owner[ranges(begin[:-1][order], held)],
                         np.concatenate(([0], np.cumsum(held)))))
    return out


def occurrences(found: Words, items: Words, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """(word position where an occurrence starts, pattern) of all occurrences."""
    first, counts = found.first[:-1], found.counts
    lanes = np.maximum(0, -(-(counts - table.length + 1) // LANE))
    begin = ranges(np.zeros(len(lanes), np.int64), lanes) * LANE + np.repeat(first, lanes) + table.length - 1
    stop = np.minimum(begin + LANE, np.repeat(found.first[1:], lanes))
    at, hits = begin, []
    while True:
        live = at < stop
        at, stop = at[live], stop[live]
        if not len(at):
            break
        jump = table.shift[_block_hash(found.hash, at, table.block)]
        if len(zero := at[jump == 0]):
            hits.append(zero)
        at = at + np.maximum(jump, 1)
    if not hits:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    end = np.concatenate(hits)
    suffix = _block_hash(found.hash, end, table.block)
    low, high = np.searchsorted(table.suffix, suffix, "left"), np.searchsorted(table.suffix, suffix, "right")
    start, pattern = np.repeat(end - table.length + 1, high - low), ranges(low, high - low)
    same = _same_windows(found, start, items, table.place[pattern], table.length)  # direct comparison
    return start[same], pattern[same]


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _searcher(items: pa.Table, window: int):
    """A function from a text column to its words, the covered ones among them,
    and the items that each text holds."""
    names, patterns = items.column("item").combine_chunks(), words(items.column("text"), ALNUM_WORDS)
    search = tables(patterns, window)

    def find(column: pa.Array) -> tuple[Words, np.ndarray, dict[int, set[str]]]:
        found = words(column, ALNUM_WORDS)
        edges = np.zeros(found.first[-1] + 1, np.int64)
        held: dict[int, set[str]] = {}
        for table in search:
            start, pattern = occurrences(found, patterns, table)
            np.add.at(edges, start, 1)
            np.add.at(edges, start + table.length, -1)
            seen = np.unique(np.stack([np.searchsorted(found.first, start, "right") - 1, pattern]), axis=1)
            for doc, p in seen.T.tolist():
                own = table.owners[table.owned[p]:table.owned[p + 1]]
                held.setdefault(doc, set()).update(names.take(pa.array(own)).to_pylist())
        return found, np.cumsum(edges[:-1]) > 0, held

    return find


def _scan(docs: DataFrame, items: pa.Table, window: int) -> DataFrame:
    """(row, id, n_words, hit ranges, items) of every document for a pattern block."""
    find = _searcher(items, window)

    def scan(part: pa.RecordBatch) -> pa.RecordBatch:
        found, hit, held = find(part.column("text"))
        owner = found.owner()
        new = np.concatenate(([True], (hit[1:] != hit[:-1]) | (owner[1:] != owner[:-1]))) if len(hit) else hit
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(hit))
        begin, end = begin[hit[begin]], end[hit[begin]]
        doc = owner[begin]
        offsets = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)), pa.int32())
        base = found.first[doc]
        spans = [pa.ListArray.from_arrays(offsets, pa.array(x - base)) for x in (begin, end)]
        return pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("id"), pa.array(found.counts), *spans,
             pa.array([sorted(held.get(i, ())) for i in range(part.num_rows)], pa.list_(pa.string()))],
            ["row", "id", "n_words", "hit_start", "hit_end", "items"])

    return map_texts(docs, scan, "row long, id long, n_words long, hit_start array<long>, hit_end array<long>, items array<string>")


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    item = F.coalesce(F.col(item_col).cast("string"), F.lit(""))
    return benchmark.select(item.alias("item"), F.col(text_col).alias("text")).filter("text is not null")


def _pattern_blocks(benchmark: DataFrame):
    """The benchmark's items in blocks of at most PATTERN_BYTES (an item larger
    than that is its own block)."""
    size = benchmark.select(F.sum(F.octet_length("text")).alias("s")).first()["s"] or 0
    blocks = -(-int(size) // PATTERN_BYTES) or 1
    if blocks == 1:
        yield benchmark.toArrow
        return
    kept = cut_lineage(benchmark.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(2 * blocks))))
    for i in range(2 * blocks):
        yield kept.filter(F.col("block") == i).drop("block").toArrow


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, hit_start, hit_end, items): the word ranges of every
    document that lie in occurrences of benchmark windows, and those items."""
    blocks = list(_pattern_blocks(_items(benchmark, item_col, item_text_col)))
    if len(blocks) == 1:
        docs = docs.select(F.col(id_col).cast("long").alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        return _scan(docs, blocks[0](), window).drop("row")
    docs = keyed_rows(docs, id_col, text_col)
    scans = [cut_lineage(_scan(docs, block(), window)) for block in blocks]
    whole = scans[0]
    for more in scans[1:]:
        whole = whole.unionByName(more)
    return (whole.groupBy("row", "id", "n_words")
            .agg(F.flatten(F.collect_list("hit_start")).alias("hit_start"), F.flatten(F.collect_list("hit_end")).alias("hit_end"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("row"))


def contamination(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """One row per document with its hit words, items and verdict."""
    def judge(batches):
        for batch in batches:
            hit = []
            for start, end in zip(batch.column("hit_start").to_pylist(), batch.column("hit_end").to_pylist(), strict=True):
                last = n = 0
                for s, e in sorted(zip(start, end, strict=True)):
                    n += max(0, e - max(s, last))
                    last = max(last, e)
                hit.append(n)
            items = batch.column("items").to_pylist()
            words_ = batch.column("n_words").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_words"), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
                 pa.array([_digest(x) for x in items]), pa.array([h > 0 and 20 * h >= n for h, n in zip(hit, words_, strict=True)], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return contaminated_spans(docs, benchmark, **columns).mapInArrow(
        judge, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, as they are, that are not contaminated."""
    blocks = list(_pattern_blocks(_items(benchmark, item_col, item_text_col)))
    if len(blocks) > 1:  # the verdict needs what all blocks have found; rows are told apart by a number of their own
        row = "row"
        while row in docs.columns:
            row += "_"
        rows = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
        judged = contamination(rows, benchmark, id_col=row, text_col=text_col, item_col=item_col, item_text_col=item_text_col, window=window)
        gone = judged.filter("contaminated").select(F.col("doc_id").alias(row))
        return rows.join(gone, row, "left_anti").select(*docs.columns)
    find = _searcher(blocks[0](), window)

    def clean(texts: pa.Array) -> np.ndarray:
        found, hit, _ = find(texts)
        n = np.bincount(found.owner()[hit], minlength=len(texts))
        return ~((n > 0) & (20 * n >= found.counts))

    return keep_rows(docs, clean, text_col)


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP2_SQL = r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS MATERIALIZED (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
p AS MATERIALIZED (
  SELECT DISTINCT item, least(13, len(ws)) AS n,
    unnest(list_transform(range(1, greatest(len(ws) - 12, 1) + 1), lambda i: array_to_string(ws[i:i + 12], ' '))) AS pat
  FROM b WHERE len(ws) > 0),
d AS (
  SELECT doc_id, l.n, unnest(range(1, len(ws) - l.n + 2)) AS i, ws FROM w, (SELECT DISTINCT n FROM p) l WHERE len(ws) >= l.n),
o AS MATERIALIZED (SELECT d.doc_id, d.i, d.n, p.item FROM d JOIN p ON p.n = d.n AND p.pat = array_to_string(d.ws[d.i:d.i + d.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
