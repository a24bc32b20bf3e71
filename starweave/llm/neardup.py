"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

Texts are lower-cased (A-Z), cut into words, and compared as sets of distinct
word shingles; two documents are linked when ``100 * common >= 75 * union``.

1. One pass writes a SuperMinHash signature per document, and the size and two
   fingerprints of its whole set. Documents that agree in these have equal sets
   and are linked at once: only the smallest id of each such class goes on.
   Sets are compared by hashes with a key drawn for the run, so texts that
   collide cannot be made beforehand.
2. Signatures are cut into bands; every bucket offers its members a link to
   one centre (a star, never all pairs). A link counts after both full shingle
   sets were compared. Hot centres are salted by their number of links.
3. Verified links are grouped by union-find and star rounds. In buckets whose
   members are still in different groups, the remaining members are compared
   block by block: where two signatures come near the threshold, the full sets
   decide; only links leave the task, never pairs.

Defined cases: null or wordless text has an empty set (n_shingles 0) and links
with nothing; a text of fewer words than a shingle is one shingle; rows that
repeat a doc_id are one document with several rows, each compared by its own
text; a row without doc_id comes back with null component and ``kept`` false;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, files_for
from .components import components
from .textscan import U64, Words, map_texts, mix, ngrams, run_key, signed, slices, spans, words

SLOTS, BAND_ROWS = 128, 4  # 32 bands: a pair at similarity 0.75 is missed once in 190,000
LINKS_PER_TASK = 128
WIDE = 8  # short rows that one with bands and sketch counts as
BLOCK = 2048  # rows of a bucket, and their shingles, in one block
BLOCK_SHINGLES = 1 << 20
NEAR = 0.57  # share of equal slots; 4.7 standard deviations under 0.75
_STEP = 0x9E3779B97F4A7C15


def superminhash(elements: np.ndarray, owner: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n, slots) of the sets whose elements are given with their owners.

    Each element draws a random permutation of the slots, step by step, and at
    step j offers ``j + r`` to the j-th slot of it; a slot keeps the least. The
    offers of step j + 1 are all larger than those of step j, so a set is done
    as soon as every slot holds an offer of a step so far. Values are integers:
    the step in the top byte, r below.
    """
    signature = np.full((n, slots), np.iinfo(U64).max, U64)
    swaps: list[np.ndarray] = []
    for step in range(slots):
        if not len(elements):
            break
        draw = mix(elements + U64(step * _STEP % (1 << 64)))
        pick = step + ((mix(draw) >> U64(32)) % U64(slots - step)).astype(np.int64)
        slot = pick.copy()
        for t in range(step - 1, -1, -1):  # undo the swaps (t, swaps[t]) before this one
            slot = np.where(slot == swaps[t], t, np.where(slot == t, swaps[t], slot))
        np.minimum.at(signature.reshape(-1), owner * slots + slot, U64(step << 56) | (draw >> U64(8)))
        open_ = signature.max(axis=1) >= U64((step + 1) << 56) if step < 255 else np.zeros(n, bool)
        keep = open_[owner]
        swaps.append(pick)
        if not keep.all():
            elements, owner = elements[keep], owner[keep]
            swaps = [s[keep] for s in swaps]
    return signature


def shingle_sets(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and offsets."""
    grams, counts = ngrams(found.hash, n), found.counts
    out, size = [], np.zeros(len(counts), np.int64)
    for i, (first, count) in enumerate(zip(found.first[:-1].tolist(), counts.tolist(), strict=True)):
        if count >= n:
            own = np.sort(grams[first:first + count - n + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif count:
            own = spans(found.hash, np.array([first]), np.array([first + count]))
        else:
            continue
        out.append(own)
        size[i] = len(own)
    return np.concatenate(out) if out else np.empty(0, U64), np.concatenate(([0], np.cumsum(size)))


def signatures(docs: DataFrame, shingle: int = 5, key: int = 0) -> DataFrame:
    """(id, n, f1, f2, bands, sketch): set size, two fingerprints of the set,
    the band keys and a byte of every slot. Size and fingerprints follow the
    run's key, the signature does not: candidates are the same in every run."""
    def sign(part: pa.RecordBatch) -> pa.RecordBatch:
        drawn, first = shingle_sets(words(part.column("text")), shingle)
        size = np.diff(first)
        signature = superminhash(drawn, np.repeat(np.arange(len(size)), size), len(size))
        sets, first = shingle_sets(words(part.column("text"), key=key), shingle)
        n = np.diff(first)
        owner = np.repeat(np.arange(len(n)), n)
        f1, f2 = np.zeros(len(n), U64), np.zeros(len(n), U64)
        np.add.at(f1, owner, mix(sets))
        np.bitwise_xor.at(f2, owner, mix(sets + U64(_STEP)))
        rows = signature.reshape(len(n), -1, BAND_ROWS)
        band = np.zeros(rows.shape[:2], U64)
        for i in range(BAND_ROWS):
            band = mix(band * U64(3) + rows[:, :, i])
        band = mix(band + np.arange(rows.shape[1], dtype=U64) * U64(_STEP))
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, band.size + 1, band.shape[1]), pa.int32()), signed(band.reshape(-1)))
        sketch = (mix(signature) & U64(255)).astype(np.uint8)
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(n), signed(f1), signed(f2), bands, pa.array([r.tobytes() for r in sketch], pa.binary())],
            ["id", "n", "f1", "f2", "bands", "sketch"])

    return map_texts(docs, sign, "id long, n long, f1 long, f2 long, bands array<long>, sketch binary")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int((a[at] == b).sum())


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int, key: int = 0,
             rows: int | None = None) -> DataFrame:
    """The links (a, b) of ``pairs``, of at most ``rows`` where that is known,
    whose full shingle sets meet the threshold."""
    pairs = cut_lineage(pairs, rows)
    share = cut_lineage(pairs.groupBy("b").agg(F.ceil(F.count("*") / LINKS_PER_TASK).alias("salts")), rows)
    tasks = cut_lineage(
        pairs.join(share, "b")
        .select(F.col("a").alias("id"), F.col("b").alias("centre"), F.pmod(F.xxhash64("a"), "salts").alias("salt"))
        .unionByName(share.select(F.col("b").alias("id"), F.col("b").alias("centre"),
                                  F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))), rows and 2 * rows)
    texts = docs.join(tasks.hint("shuffle_hash"), "id").select("centre", "salt", "id", "text")

    def compare(share: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, held, kept = share[0].as_py(), [], None
        for batch in batches:  # the texts of one salted share of a centre's links
            for part in slices(batch, "text", 1 << 20, 4096):
                sets, first = shingle_sets(words(part.column("text"), key=key), shingle)
                ids = part.column("id").to_pylist()
                for i, own in enumerate(ids):
                    own_set = sets[first[i]:first[i + 1]]
                    if own == centre:
                        kept = own_set
                    else:
                        held.append((own, own_set))
                        if kept is None:
                            continue
                if kept is not None and held:
                    yield from links(centre, kept, held)
                    held = []

    def links(centre, kept, held):
        good = []
        for own, own_set in held:
            both = _common(kept, own_set)
            if 100 * both >= percent * (len(kept) + len(own_set) - both) and both:
                good.append(own)
        if good:
            yield pa.RecordBatch.from_pydict({"a": pa.array(good, pa.int64()), "b": pa.array([centre] * len(good), pa.int64())})

    return cut_lineage(texts.groupBy("centre", "salt").applyInArrow(compare, "a long, b long").distinct(), rows)


def _linked_in_blocks(shingle: int, percent: int, key: int):
    """Task function: links between members of different groups in one block
    pair of a bucket. Sets are compared in full where signatures come near the
    threshold; what is linked already is not compared again, and a pair that
    shares an earlier band is left to that band's bucket."""
    def block(pair: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, groups, chunks, sketches, bands, sets = [], [], [], [], [], []
        for batch in batches:
            for part in slices(batch, "text", 1 << 20, 4096):
                flat, first = shingle_sets(words(part.column("text"), key=key), shingle)
                sets += [flat[first[i]:first[i + 1]] for i in range(part.num_rows)]
                ids.append(part.column("id").to_numpy())
                groups.append(part.column("group").to_numpy())
                chunks.append(part.column("chunk").to_numpy())
                sketches += part.column("sketch").to_pylist()
                bands.append(part.column("bands").flatten().to_numpy())
        ids, chunks = np.concatenate(ids), np.concatenate(chunks)
        group = np.unique(np.concatenate(groups), return_inverse=True)[1]
        sketch = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(ids), -1)
        band = np.concatenate(bands).reshape(len(ids), -1)
        at = int(np.flatnonzero(band[0] == pair[0].as_py())[0])
        left, right = (np.flatnonzero(chunks == k.as_py()) for k in pair[1:3])
        a, b = [], []
        for i in left.tolist():
            near = right[(group[right] != group[i]) & ((ids[right] > ids[i]) if pair[1] == pair[2] else True)]
            equal = (sketch[near] == sketch[i]).mean(axis=1)
            near, equal = near[equal >= NEAR], equal[equal >= NEAR]
            near = near[np.argsort(-equal, kind="stable")]
            for j in near[~(band[near, :at] == band[i, :at]).any(axis=1)].tolist():
                if group[i] == group[j]:
                    continue
                both = _common(sets[i], sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a.append(max(ids[i], ids[j]))
                    b.append(min(ids[i], ids[j]))
                    group[group == group[j]] = group[i]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return block


def _remaining_links(active: DataFrame, reps: DataFrame, docs: DataFrame, shingle: int, percent: int, key: int,
                     rows: int) -> DataFrame:
    """Links among bucket members (key, id, group) of different groups."""
    active = cut_lineage(active.join(reps, "id"), WIDE * rows)
    sizes = cut_lineage(active.groupBy("key").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("chunks"), F.count("*").alias("members")), rows)
    spread = sizes.agg(F.sum(F.col("members") * F.col("chunks"))).first()[0] or 0
    chunked = active.join(sizes.drop("members"), "key").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks"))
    dealt = chunked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select("key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                         "id", "group", "chunk", "sketch", "bands")
    texts = docs.join(cut_lineage(dealt, WIDE * spread).hint("shuffle_hash"), "id")
    return cut_lineage(texts.groupBy("key", "low", "high")
                       .applyInArrow(_linked_in_blocks(shingle, percent, key), "a long, b long").distinct(), rows)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    if unique_ids(docs, "id"):
        return _of_unique_ids(docs, shingle, percent)
    rows = cut_lineage(docs.withColumn("row", F.monotonically_increasing_id()))
    found = _of_unique_ids(rows.filter("id is not null").select(F.col("row").alias("id"), "text"), shingle, percent)
    placed = cut_lineage(found.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("home"))
                         .join(rows.select("row", "id"), "row"))
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))
    named = placed.join(_joined(placed.filter("n_shingles > 0")), "home", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept"))
    nameless = signatures(rows.filter("id is null").select("id", "text"), shingle)
    return named.unionByName(nameless.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                             F.lit(None).cast("long").alias("component_id"), F.lit(False).alias("kept")))


def unique_ids(docs: DataFrame, id_col: str) -> bool:
    return docs.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1)).isEmpty()


def _joined(placed: DataFrame) -> DataFrame:
    """(home, component): the homes of one id's rows belong together, under the
    smallest id of all their rows."""
    pairs = cut_lineage(placed.select("id", "home").distinct())
    low = pairs.groupBy("id").agg(F.min("home").alias("b"))
    more = cut_lineage(components(cut_lineage(pairs.join(low, "id").select(F.col("home").alias("a"), "b").distinct())))
    homes = pairs.groupBy("home").agg(F.min("id").alias("least"))
    homes = cut_lineage(homes.join(more.withColumnsRenamed({"node": "home", "component": "whole"}), "home", "left")
                        .select("home", "least", F.coalesce("whole", "home").alias("whole")))
    named = homes.groupBy("whole").agg(F.min("least").alias("component"))
    return cut_lineage(homes.join(named, "whole").select("home", "component"))


def _of_unique_ids(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    key = run_key()
    signed_ = cut_lineage(signatures(docs, shingle, key))
    n = signed_.count()
    known = signed_.filter("id is not null and n > 0")
    classes = cut_lineage(known.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"), F.count("*").alias("rows")), n)
    reps = cut_lineage(known.join(classes.select(F.col("rep").alias("id")).distinct(), "id").select("id", "n", "bands", "sketch"), WIDE * n)
    buckets = reps.select("id", F.explode("bands").alias("key"))
    shared = cut_lineage(buckets.groupBy("key").agg(F.min("id").alias("centre"), F.count("*").alias("members")).filter("members > 1"), n)
    rows = shared.agg(F.sum("members")).first()[0] or 0
    active = cut_lineage(buckets.join(shared, "key").select("key", "id", "centre"), rows)
    links = verified(active.filter("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct(),
                     docs, shingle, percent, key, rows)
    groups = cut_lineage(components(links), rows)
    active = cut_lineage(active.filter("id <> centre").join(groups, F.col("id") == groups["node"], "left")
                         .select("key", "id", F.coalesce("component", "id").alias("group")), rows)
    split = cut_lineage(active.groupBy("key").agg(F.min("group").alias("g"), F.max("group").alias("h"))
                        .filter("g <> h").select("key"), rows)
    active = cut_lineage(active.join(split, "key"), rows)
    if not active.isEmpty():
        more = _remaining_links(active, reps, docs, shingle, percent, key, rows)
        links = cut_lineage(links.unionByName(more), rows)
        groups = cut_lineage(components(links), rows)
    homes = cut_lineage(classes.join(groups, classes["rep"] == groups["node"], "left")
                        .select("n", "f1", "f2", F.coalesce("component", "rep").alias("home")), n)
    return _labelled(signed_, homes).coalesce(files_for(docs.sparkSession, n))


def _labelled(signed_: DataFrame, homes: DataFrame) -> DataFrame:
    """Rows with their component: the class's home, or the row itself."""
    placed = signed_.select("id", "n", "f1", "f2").join(homes, ["n", "f1", "f2"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("home")).otherwise(F.col("id")))
    return placed.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# Exact all-pairs version: shingle sets by SQL, links on full sets, groups by
# a recursive walk.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.reached) AS component_id, d.doc_id = min(r.reached) AS kept
FROM documents d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
"""
