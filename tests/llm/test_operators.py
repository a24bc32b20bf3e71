"""Defined cases of every operator, and brute-force versions of what SQL can't say."""

import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starweave.llm import components, decontaminate, language, mixing, neardup, quality, sharding, substrings, textscan, tokenfiles, topk, warc
from starweave.llm.textscan import SPACE_WORDS, words

SF = "/root/testdata/sf0.001"
BASE = " ".join(f"word{i}" for i in range(60))
NEAR = BASE.replace("word59", "other")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, id long, spans string, k long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing column names."""
    rows = [(1, BASE, "en", "a"), (2, NEAR, "en", "a"), (3, BASE, None, None), (4, None, "en", "b"), (5, "", "en", "b"), (6, " \t\n", "de", "b"),
            (7, "two words", "en", "b"), (8, "long " * 40_000, "en", "c"), (9, "1234 !!", "en", "c"), (None, BASE, "en", "a"),
            (10, "same row", "en", "c"), (10, "same row", "en", "c"), (11, "two words", "fr", "c")]
    return spark.createDataFrame([(*r, 0, 7, 7, "x", 7) for r in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long")


def by_id(frame, key="doc_id"):
    out = defaultdict(list)
    for row in frame.collect():
        out[row[key]].append(row)
    return out


def test_union_find():
    node, low = components.union_find(np.array([3, 5, 9]), np.array([2, 3, 8]))
    assert dict(zip(node.tolist(), low.tolist(), strict=True)) == {2: 2, 3: 2, 5: 2, 8: 8, 9: 8}


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    found = components.components(edges).collect()
    assert len(found) == 400 and {r["component"] for r in found} == {0}


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2 ** 63, 1000).astype(np.uint64)
    a, b = pool[:800], pool[100:900]  # 700 of 900 in common
    got = neardup.superminhash(np.concatenate([a, b]), np.repeat([0, 1], 800), 2)
    assert abs((got[0] == got[1]).mean() - 700 / 900) < 0.12
    single = neardup.superminhash(pool[:1], np.array([0]), 1)
    assert sorted((single[0] >> np.uint64(56)).tolist()) == list(range(128))  # one element ranks every slot once


def test_near_dedup_cases(odd, none):
    got = by_id(neardup.near_duplicates(odd))
    assert [got[i][0]["component_id"] for i in (1, 2, 3, 4, 5, 6, 8, 9)] == [1, 1, 1, 4, 5, 6, 8, 9]
    assert got[4][0]["n_shingles"] == got[6][0]["n_shingles"] == 0 and got[4][0]["kept"]
    assert got[7][0]["n_shingles"] == 1 and got[11][0]["component_id"] == 7 and not got[11][0]["kept"]
    assert got[8][0]["n_shingles"] == 1 and len(got[10]) == 2
    assert got[None][0]["component_id"] is None and got[None][0]["kept"] is False
    assert neardup.near_duplicates(none).count() == 0


def test_near_dedup_finds_links_that_miss_the_centre(spark):
    texts = []
    for i in range(40):  # a chain: neighbours are near, ends are not
        texts.append((i, " ".join(f"w{j}" for j in range(4 * i, 4 * i + 80))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r["component_id"] for r in neardup.near_duplicates(docs).collect()} == {0}


def test_near_dedup_of_a_doc_id_with_two_texts(spark):
    one, two = (" ".join(f"{c}{j}" for j in range(80)) for c in "xy")
    rows = [(1, one), (1, two), (2, one + " end"), (3, two + " end"), (4, "of its own"), (4, ""), (None, one)]
    got = by_id(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [{r["component_id"] for r in got[i]} for i in (1, 2, 3, 4)] == [{1}, {1}, {1}, {4}]
    assert [len(got[i]) for i in (1, 4, None)] == [2, 2, 1] and got[None][0]["n_shingles"] == 76
    assert all(r["kept"] == (r["doc_id"] in (1, 4)) for rows_ in got.values() for r in rows_)


def test_near_dedup_stage_keeps_one_row_of_each_group(spark):
    one, two = (" ".join(f"{c}{j}" for j in range(80)) for c in "xy")
    rows = [(None, one), (9, one + " end"), (5, one), (5, one), (5, two), (None, "a b c"), (None, "a b c")]
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, one), (5, two), (None, "a b c")], key=str)


def test_decontaminate_cases(spark, odd, none):
    window = " ".join(f"word{i}" for i in range(20, 33))
    items = bench(spark, [(1, window.upper(), 0), (2, "TWO words!", 0), (3, None, 0), (4, "...", 0), (12, window, 0)])
    got = by_id(decontaminate.contamination(odd, items))
    assert (got[1][0]["n_words"], got[1][0]["n_hit"], got[1][0]["n_items"], got[1][0]["contaminated"]) == (60, 13, 2, True)
    assert got[1][0]["items_sha256"] == hashlib.sha256(b"1,12").hexdigest()
    assert got[7][0]["n_hit"] == 2 and got[4][0]["n_words"] == 0 and not got[4][0]["contaminated"]
    assert got[8][0]["n_words"] == 40_000 and len(got[10]) == 2
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(odd, bench(spark, [])).filter("contaminated").count() == 0
    kept = decontaminate.decontaminated(odd, items)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 8, 9, 10, 10]


def test_decontaminate_in_blocks_equals_one_block(spark, odd, monkeypatch):
    items = bench(spark, [(i, " ".join(f"word{j}" for j in range(i, i + 14)), 0) for i in range(0, 40, 3)])
    once = sorted(map(tuple, decontaminate.contamination(odd, items).collect()), key=str)
    monkeypatch.setattr(decontaminate, "PATTERN_BYTES", 300)
    assert sorted(map(tuple, decontaminate.contamination(odd, items).collect()), key=str) == once


def test_language_cases(odd, none):
    got = by_id(language.identify(odd))
    assert [got[i][0]["lang_pred"] for i in (4, 5, 6, 9)] == ["und"] * 4 and got[4][0]["score"] == 0
    assert got[1][0]["lang_pred"] in {"en", "de", "fr"} and 0 < got[1][0]["score"] <= 1
    assert got[1][0]["held_out"] == (zlib.crc32(b"1") % 4 == 2) and got[None][0]["held_out"] is False
    assert language.identify(none).count() == 0
    assert language.identified(odd).columns == odd.columns


def test_language_held_out_accuracy_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r for r in docs.collect()}
    got = [r for r in language.identify(docs).collect()]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in got if r["held_out"]]) > 0.95

    def profile(text):
        n = Counter()
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        for word in letters.split():
            n.update(word)
            padded = f" {word} "
            n.update(padded[i:i + 2] for i in range(len(padded) - 1))
            n.update(padded[i:i + 3] for i in range(len(padded) - 2))
        return n

    rank = lambda n: [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], [0] * (3 - len(x[0])) + [ord(c) for c in x[0]]))][:language.PROFILE]
    learned = defaultdict(Counter)
    for d in truth.values():
        if zlib.crc32(str(d["doc_id"]).encode()) % 4 != 2:
            learned[d["lang"]] += profile(d["text"])
    places = {lang: {g: i for i, g in enumerate(rank(n))} for lang, n in learned.items()}
    for r in got[:60]:
        own = rank(profile(truth[r["doc_id"]]["text"]))
        far = {lang: sum(abs(p[g] - i) if g in p else language.PROFILE for i, g in enumerate(own)) for lang, p in places.items()}
        best = min(sorted(far), key=far.get)
        assert r["lang_pred"] == best and r["score"] == pytest.approx(1 - far[best] / (len(own) * language.PROFILE))


def test_quality_cases(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (7, 1, 0), (2, None, 0), (99, 1, 0), (8, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert quality.quality_scores(none, labels).count() == 0
    assert {r["score"] for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}


def test_quality_pairs_by_the_sum_of_squares_identity():
    machine = quality.Machine()
    machine.w[:] = np.random.default_rng(3).normal(size=len(machine.w))
    index, value, offsets = quality.features(pa.array(["a b c c", "", None]))
    got, _ = machine.margin(index, value, offsets)
    for row in range(3):
        ix, x = index[offsets[row]:offsets[row + 1]], value[offsets[row]:offsets[row + 1]]
        pairs = sum(float(machine.v[ix[i]] @ machine.v[ix[j]]) * x[i] * x[j] for i in range(len(ix)) for j in range(i))
        assert got[row] == pytest.approx(machine.w[ix] @ x + pairs, abs=1e-4)


def test_quality_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.93


def test_mixing_cases(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert {r["doc_id"]: r["size"] for r in got}[4] == 0
    assert sorted(map(tuple, mixing.mix(odd).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(none).count() == 0


def test_mixing_meets_targets(spark):
    got = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert sum(r["target"] for r in got) == pytest.approx(sum(r["source_size"] for r in got))
    for r in got:
        assert r["target"] <= 3 * r["source_size"] and abs(r["t"] - r["target"]) <= (mixing.CAP + 1) * mixing.BLOCK_WORDS


def test_apportionment_is_sainte_lague(spark):
    rng = np.random.default_rng(5)
    for seats in (1, 7, 50, 333):
        votes = [(0, i, float(v), seats) for i, v in enumerate(rng.exponential(100, 23).round(2))]
        got = {r["m"]: r["quota"] for r in mixing.apportion(spark.createDataFrame(votes, "g long, m long, v double, s long"), "g", "m", "v", "s").collect()}
        best = sorted(((-v / (2 * j - 1), m) for _, m, v, _ in votes for j in range(1, seats + 1)))[:seats]
        assert got == {m: Counter(m for _, m in best)[m] for _, m, _, _ in votes}


def test_top_k_cases(spark):
    rows = [(0, [1.0, 0.5], 9), (1, [0.5, 0.5], 9), (2, [0.5, 0.5], 9), (2, [0.5, 0.5], 9), (3, None, 9), (4, [float("nan"), 1.0], 9), (5, [None, 1.0], 9),
            (6, [1e30, 1e30], 9), (None, [1.0, 1.0], 9), (50, [], 9), (100, [-1.0], 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, chunk long")
    got = by_id(topk.top_k(vectors, vectors.filter("vec_id % 50 = 0")), "query_id")
    assert [(r["vec_id"], r["rank"]) for r in sorted(got[0], key=lambda r: r["rank"])] == [(6, 1), (1, 2), (2, 3), (2, 4), (50, 5)]
    assert {r["score"] for r in got[50]} == {0} and len(got[100]) == 5
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_top_k_of_repeated_query_ids_equals_sql(spark, monkeypatch):
    import duckdb
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (50, [-1.0, 0.5]), (50, [0.25, 0.5])]
    rows += [(i, [i / 4, 2 - i / 4]) for i in range(1, 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = sorted(con.execute(topk.OP6_SQL).fetchall())
    for size in (topk.QUERY_BLOCK, 2):
        monkeypatch.setattr(topk, "QUERY_BLOCK", size)
        monkeypatch.setattr(topk, "VECTOR_BLOCK", size)
        assert sorted(map(tuple, topk.top_k(vectors, vectors.filter("vec_id % 50 = 0")).collect())) == want


def test_warc_cases(spark):
    big, magic = "x" * 1000, "y\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 40
    rows = [(1, "u", big, 0), (5, None, big, 0), (3, "a b\r\nc", big, 0), (None, "u", big, 0), (7, "u", None, 0), (8, "u" * 99_999, "", 0), (9, "u", "small", 0),
            (10, "u", "small", 0), (11, "u", magic, 0), (5, "u", big, 0), (12, "u", "é" * 600, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, size long").repartition(2)
    files = warc.write_archives(pages, warc.new_folder(spark, "test"))
    whole = sorted(map(tuple, warc.read_archives(files).collect()), key=str)
    assert sorted(map(tuple, warc.read_archives(files, range_bytes=97).collect()), key=str) == whole and len(whole) == len(rows)
    kinds = sorted((r[0] or 0, r[3], r[4]) for r in whole if r[1] == 1000)
    assert [k[:2] for k in kinds] == [(0, "revisit"), (1, "revisit"), (3, "revisit"), (5, "response"), (5, "response")]
    assert {k[2] for k in kinds if k[1] == "revisit"} == {5}
    assert [r[2] for r in whole if r[0] == 11] == [hashlib.sha1(magic.encode()).hexdigest()]
    assert [r[1] for r in whole if r[0] in (7, 8)] == [0, 0]
    assert warc.archived(pages.limit(0)).count() == 0


def test_substring_cases(odd, none):
    got = by_id(substrings.remove_repeats(odd))
    assert got[1][0]["n_removed"] == 60 and got[2][0]["n_removed"] == 59 and got[None][0]["n_removed"] == 60
    assert got[2][0]["kept_sha256"] == hashlib.sha256(b"other").hexdigest() and list(got[2][0]["spans"]) == [0, 59]
    assert got[8][0]["n_removed"] == 40_000 and got[4][0]["n_words"] == 0 and len(got[10]) == 2
    assert substrings.remove_repeats(none).count() == 0


def test_substrings_against_brute_force(spark):
    rng = np.random.default_rng(7)
    passages = [[f"p{i}_{j}" for j in range(n)] for i, n in enumerate((34, 35, 36, 80, 120))]
    texts = []
    for i in range(60):
        own = [f"o{rng.integers(4)}" for _ in range(rng.integers(0, 60))]
        for _ in range(rng.integers(0, 4)):
            p = passages[rng.integers(5)]
            a = rng.integers(0, 20)
            own[len(own) // 2:len(own) // 2] = p[a:] if rng.random() < 0.5 else p
        texts.append((i, " ".join(own)))
    seen = Counter()
    for _, t in texts:
        w = t.split()
        seen.update(tuple(w[i:i + 35]) for i in range(len(w) - 34))
    got = by_id(substrings.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")))
    for i, t in texts:
        w = t.split()
        gone = {k for j in range(len(w) - 34) if seen[tuple(w[j:j + 35])] > 1 for k in range(j, j + 35)}
        assert got[i][0]["n_removed"] == len(gone)
        assert got[i][0]["kept_sha256"] == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()


def tokens_by_hand(rows):
    library, start, out = tokenfiles.Encoder(tokenfiles.default_tokenizer()).library, 0, []
    for id_, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [tokenfiles.END_ID]
        out.append((id_, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_cases_and_round_trip(spark, odd, none):
    tricky = odd.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(20, "It'S <|endoftext|> x<|ENDOFTEXT|>. é, é. 85.1, a.. À́  z \U0001F389,")], "doc_id long, text string"))
    rows = sorted(((r["doc_id"], r["text"]) for r in tricky.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = tokenfiles.tokenised(tricky, tokenfiles.default_tokenizer()).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == tokens_by_hand(rows)
    assert tokenfiles.tokenised(none, tokenfiles.default_tokenizer()).count() == 0


def test_token_records_read_in_any_order_and_checked(spark, odd):
    files = tokenfiles.write_tokens(odd, tokenfiles.new_folder(spark, "test"), tokenfiles.default_tokenizer()).collect()
    system, name = tokenfiles.located(files[0]["path"])
    entries = np.frombuffer(system.open_input_stream(f"{name}.idx").read(), tokenfiles.INDEX)
    with system.open_input_file(f"{name}.tok") as f:
        for e in entries[::-1]:
            assert tokenfiles.read_record(f, int(e["offset"]), int(e["n"]), 2)[-1] == tokenfiles.END_ID
        with pytest.raises(ValueError):
            tokenfiles.read_record(f, int(entries[0]["offset"]) + 1, int(entries[0]["n"]), 2)


def test_sharding_cases(odd, none):
    got = sharding.shard_rows(odd).collect()
    assert len(got) == odd.count() and {r["law"] for r in got} == {"key"}
    for shard in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got)
    first = {r["doc_id"]: r for r in got}
    assert first[4]["size"] == 1 and first[4]["text_crc32"] == 0 and first[1]["text_crc32"] == zlib.crc32(BASE.encode())
    assert sharding.shard_rows(none).count() == 0


def test_sharding_follows_weights(spark):
    got = spark.range(20_000).select(sharding.rendezvous(F.col("id").cast("string"), (1.0, 3.0)).alias("s")).groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got}[1] / 20_000 == pytest.approx(0.75, abs=0.02)


def test_word_hashes_do_not_depend_on_the_slice():
    texts = ["Ab c", None, "", "x\ty\r\nAB é"]
    whole = words(pa.array(texts), SPACE_WORDS)
    alone = [words(pa.array([t], pa.string()), SPACE_WORDS).hash.tolist() for t in texts]
    assert whole.hash.tolist() == sum(alone, []) and whole.counts.tolist() == [2, 0, 0, 4]


def copies_by_hand(takes):
    """How often each document stays: whole times, and the partly taken ones by
    size, each when the running sum of the parts passes a half."""
    out, lines = {r["doc_id"]: r["taken"] // r["size"] for r in takes}, defaultdict(list)
    for r in takes:
        if r["taken"] % r["size"]:
            lines[r["source_size"], r["target"]].append((r["size"], r["doc_id"], r["taken"] % r["size"] / r["size"]))
    for line in lines.values():
        upto, given = 0.0, 0
        for _, i, share in sorted(line):
            upto += share
            n = int(upto + 0.5) - given
            given += n
            out[i] += n
    return {i: n for i, n in out.items() if n}


def test_mixing_stage_meets_targets_within_a_document(spark):
    """A source of few long documents, one of many short ones, and columns that clash."""
    rows = [(i, "w " * 700, "a", 1, 1, 1) for i in range(9)] + [(100 + i, "w " * (1 + i % 9), "b", 1, 1, 1) for i in range(600)]
    rows += [(1000, "w " * 20_000, "c", 1, 1, 1), (1001, None, "c", 1, 1, 1), (None, "no id", "a", 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mixed_times int, mixed_turn int, times int")
    kept = corpus_pipeline.mixing_stage(spark, docs, "")
    assert kept.columns == docs.columns
    mixed = mixing.mix(docs).collect()
    of = {r["doc_id"]: r for r in mixed}
    words_, largest = Counter(), Counter()
    for i, _, source, *_ in rows:
        words_[source] += of[i]["taken"]
        largest[source] = max(largest[source], of[i]["size"])
    got = Counter()
    for r in kept.collect():
        got[r["source"]] += of[r["doc_id"]]["size"]
    assert all(abs(got[s] - words_[s]) <= largest[s] for s in words_) and abs(got["b"] - words_["b"]) <= 9
    assert corpus_pipeline.mixing_stage(spark, docs.limit(0), "").count() == 0


def test_pipeline_stages_take_clashing_columns_and_empty_tables(spark, odd):
    clash = odd.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(7).alias(c) for c in (
        "near_row", "copy_of", "gone_id", "mixed_times", "mixed_turn", "times", "turn", "doc", "row", "id")])
    for docs in (clash, clash.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            step = stage(spark, docs, SF)
            assert step.columns == docs.columns, name
            assert (step.count() > 0) == (docs is clash), name
        assert (corpus_pipeline.token_stage(spark, docs, SF).count() > 0) == (docs is clash)


def test_pipeline_stages_against_brute_force(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id is null or text is null"))
    sf, stages = SF, dict(corpus_pipeline.STAGES)
    ids = lambda frame: sorted((r["doc_id"] for r in frame.select("doc_id").collect()), key=str)
    step = stages["language_id"](spark, docs, sf)
    assert step.columns == docs.columns
    assert ids(step) == ids(docs.filter("text rlike '\\\\p{L}'"))
    near = stages["near_dedup"](spark, step, sf)
    sets = {r["doc_id"]: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if (w := r["text"].lower().split()) else set()
            for r in step.filter("doc_id is not null").collect()}
    home = {i: i for i in sets}
    for i in sorted(sets):
        for j in (j for j in sets if j > i and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) > 0):
            a, b = sorted((home[i], home[j]))
            home = {k: a if v == b else v for k, v in home.items()}
    assert ids(near.filter("doc_id is not null")) == sorted((i for i in home if home[i] == i), key=str) and near.filter("doc_id is null").count() == 1
    clean = stages["decontaminate"](spark, near, sf)
    judged = decontaminate.contamination(near, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert ids(clean) == ids(judged.filter("not contaminated"))
    mixed = stages["mixing"](spark, clean, sf)
    assert mixed.columns == docs.columns
    takes = [r.asDict() for r in mixing.mix(clean).collect() if r["taken"]]  # checked by its own SQL
    assert Counter(ids(mixed)) == Counter(copies_by_hand(takes))
    rows = sorted(((r["doc_id"], r["text"]) for r in mixed.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = stages["token_ids"](spark, mixed, sf).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == tokens_by_hand(rows)


THUE = ["".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(1024)) for flip in (0, 1)]


def test_words_that_polynomials_confuse_stay_apart(spark):
    """Two Thue-Morse words, whose polynomial hashes modulo 2**64 agree, in all operators that hash words."""
    a, b = THUE
    assert len(set(words(pa.array([f"{a} {b}"])).hash.tolist())) == 2
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert [r["component_id"] for r in neardup.near_duplicates(docs).orderBy("doc_id").collect()] == [1, 2]
    hits = decontaminate.contamination(docs, spark.createDataFrame([(1, b)], "item_id long, text string"))
    assert {r["doc_id"]: r["n_hit"] for r in hits.collect()} == {1: 0, 2: 1}
    many = spark.createDataFrame([(1, " ".join([a] + [f"w{i}" for i in range(34)])), (2, " ".join([b] + [f"w{i}" for i in range(34)]))],
                                 "doc_id long, text string")
    assert {r["n_removed"] for r in substrings.remove_repeats(many).collect()} == {0}
    got = tokenfiles.tokenised(docs, tokenfiles.default_tokenizer()).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == tokens_by_hand([(1, a), (2, b)])


def colliding_words():
    """Two words of 16 small letters, digits and signs whose unkeyed hashes agree:
    the last eight bytes are solved for what other first eight bytes leave."""
    def unmix(x):
        for shift, factor in ((31, 0x94D049BB133111EB), (27, 0xBF58476D1CE4E5B9), (30, 1)):
            x = (x ^ (x >> np.uint64(shift)) ^ (x >> np.uint64(2 * shift))) * np.uint64(pow(factor, -1, 1 << 64))
        return x

    base = np.uint64(textscan._BYTE_BASE)
    lane = textscan.mix(np.array([base]))[0]
    allowed = np.array([c for c in range(0x21, 0x7B) if not 0x41 <= c <= 0x5A], np.uint8)
    tried = np.random.default_rng(5).choice(allowed, (1 << 21, 8)).view("<u8").ravel()
    one = textscan.mix(tried[:1] + base) + textscan.mix(tried[1:2] + lane)
    last = unmix(one - textscan.mix(tried + base)) - lane
    fits = np.isin(last.view(np.uint8).reshape(-1, 8), allowed).all(axis=1) & (tried != tried[0])
    return [np.array(w, "<u8").tobytes().decode() for w in (tried[:2], (tried[fits][0], last[fits][0]))]


def test_words_made_to_collide_stay_apart(spark):
    """The key of a run parts words that were made to collide without one."""
    a, b = colliding_words()
    assert a != b and len(set(words(pa.array([f"{a} {b}"])).hash.tolist())) == 1
    assert len(set(words(pa.array([f"{a} {b}"]), key=3).hash.tolist())) == 2
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert [r["component_id"] for r in neardup.near_duplicates(docs).orderBy("doc_id").collect()] == [1, 2]
    many = spark.createDataFrame([(i, " ".join([w] + [f"w{i}" for i in range(34)])) for i, w in ((1, a), (2, b))],
                                 "doc_id long, text string")
    assert {r["n_removed"] for r in substrings.remove_repeats(many).collect()} == {0}
    got = tokenfiles.tokenised(docs, tokenfiles.default_tokenizer()).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == tokens_by_hand([(1, a), (2, b)])


def test_pieces_cover_their_texts():
    texts = ["One, two. <A>b. .", None, "", "3.5, x,", "  ", "é, Z."]
    found, first = tokenfiles.pieces(pa.array(texts))
    got = [[p.decode() for p in found.to_pylist()[a:b]] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [["one", ",", "two", ".", "<A>b", ".", "."], [], [], ["3.5", ",", "x", ","], [], ["é,", "z", "."]]
    found, first = tokenfiles.pieces(pa.array([None, ""], pa.string()))
    assert len(found) == 0 and first.tolist() == [0, 0, 0]


def test_files_of_lost_attempts_are_not_read(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    folder = tokenfiles.new_folder(spark, "lost")
    files = tokenfiles.write_tokens(docs, folder, tokenfiles.default_tokenizer())
    again = tokenfiles.write_tokens(docs.limit(1), folder, tokenfiles.default_tokenizer())  # another attempt's files beside them
    assert not {r["path"] for r in files.collect()} & {r["path"] for r in again.collect()}
    assert tokenfiles.read_tokens(spark, files).count() == 2
    pages = spark.createDataFrame([(1, "u", "x"), (2, "v", None)], "page_id long, url string, html string")
    folder = warc.new_folder(spark, "lost")
    kept = warc.write_archives(pages, folder)
    warc.write_archives(pages.limit(1), folder)
    assert warc.read_archives(kept).count() == 2


def test_equal_hashes_are_compared_word_by_word(monkeypatch):
    """With every word hashed alike only the comparison is left."""
    monkeypatch.setattr(textscan, "_word_hashes", lambda data, start, end, table: np.ones(len(start), np.uint64))
    items = words(pa.array(["one two three", "one two four", "one two three five"]), decontaminate.ALNUM_WORDS)
    table = decontaminate.tables(items, 3)[0]
    assert len(table.place) == 3 and table.owned[-1] == 4  # "one two three" is one pattern of two items
    found = words(pa.array(["zero One TWO three", "one two five"]), decontaminate.ALNUM_WORDS)
    start, pattern = decontaminate.occurrences(found, items, table)
    assert start.tolist() == [1] and sorted(table.owners[table.owned[pattern[0]]:table.owned[pattern[0] + 1]].tolist()) == [0, 2]


@pytest.mark.parametrize("size", [300, 16 << 20])
def test_decontamination_does_not_depend_on_the_benchmark_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(decontaminate, "PATTERN_BYTES", size)
    item, clean = " ".join(f"bench{i}" for i in range(14)), " ".join(f"clean{i}" for i in range(40))
    rows = [(7, item), (7, clean), (None, item + " tail"), (None, clean), (9, ""), (10, None), (11, clean + " " + item)]
    docs = spark.createDataFrame([(i, t, 1, 1, 1) for i, t in rows], "doc_id long, text string, gone_id int, row int, id int")
    bench_ = spark.createDataFrame([(i, item if i == 3 else f"other{i} words here") for i in range(60)], "item_id long, text string")
    got = decontaminate.decontaminated(docs, bench_)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(
        [(7, clean), (None, clean), (9, ""), (10, None)], key=repr)


def test_other_tokenizers_are_encoded_whole(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, "Two  words, and. MORE"), (2, None), (3, " a\n\nb ")]
    got = tokenfiles.tokenised(spark.createDataFrame(rows, "doc_id long, text string"), path).orderBy("doc_id").collect()
    want = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids + [tokenfiles.END_ID] for _, t in rows]
    assert [(r["n_tokens"], r["ids_crc32"]) for r in got] == [(len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in want]


def test_rows_that_share_an_id_are_spread_over_files(spark):
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = tokenfiles.write_tokens(docs.repartition(4), tokenfiles.new_folder(spark, "spread"), tokenfiles.default_tokenizer())
        assert files.count() == 8 and files.agg(F.max("docs")).first()[0] < 600
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def cut_files(spark):
    """The numbers of part files of the tables cut since, with 40 shuffle
    partitions that Spark doesn't join."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    cut = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "cut")
    there = set(cut.glob("*"))
    for k, v in held.items():
        spark.conf.set(k, v)
    yield lambda: [len(list(table.glob("part-*"))) for table in set(cut.glob("*")) - there]
    for k, v in before.items():
        spark.conf.set(k, v)


def test_near_dedup_writes_files_by_rows_not_by_shuffle_partitions(spark, cut_files):
    text = [f"w{i} " * 3 + " ".join(f"v{j}" for j in range(90 if i % 40 else 60)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string").coalesce(4)
    found = neardup.near_duplicates(docs)
    assert found.filter("kept").count() == 2 and found.count() == 400  # 60 of 90 words are too few
    assert max(cut_files()) <= spark.sparkContext.defaultParallelism
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_pipeline_stages_write_files_by_rows_not_by_shuffle_partitions(spark, cut_files):
    docs = spark.createDataFrame([(i, f"some words of {i} " * 5, f"s{i % 3}") for i in range(400)],
                                 "doc_id long, text string, source string").coalesce(4)
    cores = spark.sparkContext.defaultParallelism
    mixed = corpus_pipeline.mixing_stage(spark, docs, "")
    assert mixed.count() > 300
    made = tokenfiles.write_tokens(docs, tokenfiles.new_folder(spark, "tokens"), tokenfiles.default_tokenizer())
    read = tokenfiles.read_tokens(spark, made)
    assert made.count() > cores >= read.rdd.getNumPartitions() and read.count() == 400
    assert max(cut_files()) <= cores
