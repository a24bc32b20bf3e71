"""Removal of long repeated passages: 35-word edges of a de Bruijn graph, compacted by anchors.

A window of 35 consecutive words is an edge between its first and its last 34
words; an edge is repeated if it occurs at two places of the corpus. Words
covered by repeated edges are removed.

1. Each task compacts consecutive edges into path segments: the least hash of
   the 25 eleven-word grams of a window is its anchor, and successive windows
   with the same anchor are one segment. Equal windows choose equal anchors,
   wherever they stand, so edges only ever meet within an anchor.
2. A Spark join brings equal segments together. All edges of a segment that
   occurs twice are repeated. An anchor that stands in different segments is a
   place where paths branch (or end): there one occurrence of each segment is
   cut into its single edges again, and those are joined.
3. The source coordinates of repeated segments and edges are gathered by
   document, and spans that touch are compacted into maximal spans. Segments and
   edges are equal if two 64-bit hashes are (their anchor's and their own), over
   words hashed with a key drawn for the run.

Defined cases: null and wordless texts have n_words 0 and keep the empty text;
texts under 35 words lose nothing; every row is a document of its own, so rows
that repeat are repeats of each other; rows without doc_id are judged like all
others; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rows import keyed_rows
from .textscan import SPACE_WORDS, U64, Words, map_texts, mix, ngrams, ranges, run_key, signed, spans, words

WINDOW, GRAM = 35, 11
PLACE_BITS = 26  # low bits of a gram's rank that hold its place: ties go to the leftmost


def segments(found: Words, window: int = WINDOW, gram: int = GRAM):
    """(text, first window, windows, anchor hash, segment hash) of all segments."""
    grams = ngrams(found.hash, gram)
    span = window - gram + 1
    none = np.empty(0, np.int64)
    counts = np.maximum(found.counts - window + 1, 0)
    if not counts.sum():
        return none, none, none, none.view(U64), none.view(U64)
    bits = max(PLACE_BITS, int(len(grams) - 1).bit_length())
    low = (grams >> U64(bits) << U64(bits)) | np.arange(len(grams), dtype=U64)
    width = 1  # least of each run of `span` grams by doubling
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    anchor = (low & U64((1 << bits) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    start = ranges(found.first[:-1], counts)
    at = anchor[start]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
    length = np.diff(np.append(new, len(at)))
    begin = start[new]
    end = begin + length + window - 1
    # the anchor's place within the segment is part of the segment's identity
    whole = mix(spans(found.hash, begin, end) ^ mix((at[new] - begin).astype(U64)))
    return text[new], begin - found.first[text[new]], length, grams[at[new]], whole


def repeated_spans(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(row, start, stop): ranges of windows of ``rows`` (row, text) that are repeated."""
    key = run_key()

    def segment(part: pa.RecordBatch) -> pa.RecordBatch:
        text, start, length, anchor, whole = segments(words(part.column("text"), SPACE_WORDS, lower=False, key=key), window, gram)
        row = part.column("row").to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(row[text]), pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32)), signed(anchor), signed(whole)],
            ["row", "start", "windows", "anchor", "segment"])

    all_ = cut_lineage(map_texts(rows.select("row", "text"), segment,
                                 "row long, start int, windows int, anchor long, segment long"))
    meeting = cut_lineage(all_.groupBy("anchor").agg(F.count("*").alias("places"), F.min("segment").alias("s"), F.max("segment").alias("t"))
                          .filter("places > 1").select("anchor", (F.col("s") != F.col("t")).alias("branches")))
    shared = cut_lineage(all_.join(meeting, "anchor").select("anchor", "segment", "branches", "row", "start", "windows"))
    classes = cut_lineage(shared.groupBy("anchor", "segment").agg(
        F.count("*").alias("n"), F.min(F.col("row")).alias("first_row"), F.max("branches").alias("branches")))
    marked = shared.drop("branches").join(classes, ["anchor", "segment"])
    marked = cut_lineage(marked.select("anchor", "row", "start", "windows", "n", "first_row", "branches"))
    whole = marked.filter("n > 1").select("row", "start", (F.col("start") + F.col("windows")).alias("stop"))
    # Branching anchors: all unrepeated segments, and one text's places of each repeated one.
    open_ = marked.filter("branches and (n = 1 or row = first_row)").groupBy("row").agg(
        F.collect_list(F.struct("start", "windows", "anchor", (F.col("n") > 1).alias("known"))).alias("parts"))
    texts = rows.select("row", "text").join(open_.hint("shuffle_hash"), "row")

    def cut(part: pa.RecordBatch) -> pa.RecordBatch | None:
        found = words(part.column("text"), SPACE_WORDS, lower=False, key=key)
        edges = ngrams(found.hash, window)
        lists = part.column("parts")
        parts = lists.flatten()
        n = np.diff(lists.offsets.to_numpy())
        text = np.repeat(np.arange(part.num_rows), n)
        start, count = parts.field("start").to_numpy().astype(np.int64), parts.field("windows").to_numpy().astype(np.int64)
        at = ranges(start, count)
        edge = edges[np.repeat(found.first[text], count) + at]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part.column("row").to_numpy()[text], count)), pa.array(at.astype(np.int32)),
             pa.array(np.repeat(parts.field("anchor").to_numpy(), count)), signed(edge),
             pa.array(np.repeat(parts.field("known").to_numpy(zero_copy_only=False), count))],
            ["row", "at", "anchor", "edge", "known"])

    edges = cut_lineage(map_texts(texts, cut, "row long, at int, anchor long, edge long, known boolean"))
    twice = cut_lineage(edges.groupBy("anchor", "edge").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", "edge"))
    single = edges.filter("not known").join(twice, ["anchor", "edge"]).select("row", F.col("at").alias("start"), (F.col("at") + 1).alias("stop"))
    return whole.unionByName(single)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: its words, those removed, the SHA-256 of the kept
    words joined by one space, and ``spans``, the removed word ranges as a flat
    list of starts and ends."""
    rows = keyed_rows(docs, id_col, text_col)
    found = cut_lineage(repeated_spans(rows, window)).groupBy("row").agg(
        F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    joined = rows.join(found.hint("shuffle_hash"), "row", "left")

    def strip(part: pa.RecordBatch) -> pa.RecordBatch:
        n, removed, digest, spans_ = _kept(part, window)
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(n), pa.array(removed), pa.array(digest), spans_],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    return map_texts(joined, strip, "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<long>")


def _kept(part: pa.RecordBatch, window: int):
    found = words(part.column("text"), SPACE_WORDS, lower=False)
    total = int(found.first[-1])
    edges = np.zeros(total + 1, np.int64)
    for name, sign, more in (("starts", 1, 0), ("stops", -1, window - 1)):
        lists = part.column(name)
        n = np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False)
        at = lists.flatten().to_numpy().astype(np.int64) + np.repeat(found.first[:-1], n) + more
        np.add.at(edges, at, sign)
    gone = np.cumsum(edges[:-1]) > 0
    counts = found.counts
    owner = found.owner()
    removed = np.bincount(owner[gone], minlength=part.num_rows).astype(np.int64)
    data = found.data.tobytes()
    start, end = found.start.tolist(), found.end.tolist()
    digest, flat, offsets = [], [], [0]
    for i, (a, b) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)):
        if removed[i] == 0:
            kept = range(a, b)
        else:
            own = np.diff(gone[a:b].astype(np.int8), prepend=0, append=0)
            flat += np.stack([np.flatnonzero(own == 1), np.flatnonzero(own == -1)], axis=1).reshape(-1).tolist()
            kept = (np.flatnonzero(~gone[a:b]) + a).tolist()
        offsets.append(len(flat))
        digest.append(hashlib.sha256(b" ".join([data[start[k]:end[k]] for k in kept])).hexdigest())
    return counts, removed, digest, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


OP8_SQL = r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
c AS (SELECT doc_id, list(DISTINCT k) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS k FROM g SEMI JOIN r USING (h)) GROUP BY doc_id),
k AS (
  SELECT u.doc_id, u.i, u.word FROM (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w) u
  ANTI JOIN (SELECT doc_id, unnest(gone) AS i FROM c) x USING (doc_id, i)),
t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM k GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
