"""Centroid clustering, periodic runs and token counts: defined cases and
brute-force versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starweave.llm import centroids, periodic, tokencounts

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, id long, row long, crc long, cluster int, n_tokens string"
VECTORS = "vec_id long, embedding array<double>, vector string, cluster long, distance int, label int, dots int"


# ------------------------------------------------------------- centroids

def brute_clusters(rows, k, dims, rounds, seed):
    """(vec_id, cluster, distance) in input order, and the centroids, in Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and abs(x) < float("inf") for x in v)]
    whole = [[int(Fraction(x) * 256 // 1) for x in v] for _, v in kept]
    tag = [(i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept]
    first = sorted(range(len(kept)), key=lambda i: tag[i])[:k]
    centre = [whole[i] for i in first]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centre)) for v in whole]

    for _ in range(rounds):
        of = [j for _, j in nearest()]
        for j in range(len(centre)):
            mine = [v for v, c in zip(whole, of) if c == j]
            if mine:
                centre[j] = [sum(c) // len(mine) for c in zip(*mine)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, nearest(), strict=True)], centre


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 1, 1, 1) for i, v in rows], VECTORS).repartition(3)


def keyed(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("scale", [1.0, 1e-3, 3e5, 1e30, 1e307])
def test_clusters_equal_brute_force_at_every_size_of_number(spark, scale):
    rng = random.Random(7)
    rows = [(i, [scale * rng.choice([-1.5, -0.3, 0.0, 0.2, 1.1]) + scale * rng.random() for _ in range(3)]) for i in range(90)]
    rows += [(5, rows[5][1]), (5, [scale] * 3), (None, [scale / 3] * 3), (91, rows[4][1])]  # repeats, ties, no id
    rows += [(200, None), (201, [1.0]), (202, [1.0, None, 2.0]), (203, [float("nan")] * 3), (204, [float("inf"), 0.0, 0.0]), (205, [])]
    found, centre = centroids.cluster(vectors(spark, rows), k=6, dims=3, rounds=4)
    want, want_centre = brute_clusters(rows, 6, 3, 4, 2)
    limit = (1 << 63) - 1
    assert centre == want_centre
    assert keyed((r["vec_id"], r["cluster"], r["distance"]) for r in found.collect()) == keyed((i, j, min(d, limit)) for i, j, d in want)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5])]
    found, centre = centroids.cluster(vectors(spark, rows), k=5, dims=2)
    assert centre == [[128, 128]] * 2 and {(r["cluster"], r["distance"]) for r in found.collect()} == {(0, 0)}
    for rows in ([], [(1, None), (2, [1.0])]):
        found, centre = centroids.cluster(vectors(spark, rows), k=5, dims=2)
        assert found.count() == 0 and centre == [] and found.columns == ["vec_id", "vector", "cluster", "distance"]


def test_products_change_by_changed_components_only():
    rng = np.random.default_rng(3)
    v, old = rng.integers(-200, 200, (8, 50)).astype(float), rng.integers(-200, 200, (4, 8)).astype(float)
    new = old.copy()
    new[1, [2, 5]] += 3
    new[3] = -old[3]
    dots = old @ v
    before = dots.copy()
    centroids._update(dots, v, new - old)
    assert (dots == new @ v).all() and (dots[[0, 2]] == before[[0, 2]]).all()


def test_earlier_states_are_removed(spark):
    import glob
    folder = spark.conf.get("spark.checkpoint.dir") + "/cut/*"
    before = set(glob.glob(folder))
    found, _ = centroids.cluster(vectors(spark, [(i, [i / 10, 0.0]) for i in range(20)]), k=3, dims=2)
    assert found.count() == 20 and len(set(glob.glob(folder)) - before) == 1


def test_op11_columns(spark):
    out = centroids.op11_centroids(spark, SF)
    rows = out.collect()
    assert sum(r["distance"] for r in rows) == rows[0]["inertia"] and len({r["centroid_sha256"] for r in rows}) <= 40
    assert len(rows) == spark.read.parquet(f"{SF}/embeddings.parquet").count()


# ---------------------------------------------------------- periodic runs

def brute_runs(words, min_words=24, powers=3):
    found = {}
    for q in range(1, len(words) // powers + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(min_words, powers * q):
                found.setdefault((start, end), q)  # the smallest period comes first
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    letters = "abcd"[:rng.choice([1, 2, 2, 3, 4])]
    out = []
    for _ in range(rng.randrange(2, 7)):
        way = rng.randrange(4)
        if way == 0:
            out = out * rng.randrange(1, 6)
        elif way == 1:
            out = out + [rng.choice(letters) for _ in range(rng.randrange(0, 8))]
        elif way == 2:
            out = [rng.choice(letters)] * rng.randrange(1, 40) + out
        else:
            at = rng.randrange(len(out) + 1)
            out = out + out[at:] * rng.randrange(0, 5)
        out = out[:500]
    return out


def test_runs_equal_brute_force():
    rng, total = random.Random(11), 0
    for _ in range(600):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 4))]  # of one slice; runs stay within texts
        min_words, powers = rng.choice([(24, 3), (24, 3), (2, 3), (10, 4), (50, 3), (5, 5)])
        s = periodic.Scan(pa.array([" ".join(t) for t in texts]), min_words, powers)
        got = list(zip(s.text.tolist(), s.start.tolist(), s.length.tolist(), s.period.tolist(), strict=True))
        want = [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t, min_words, powers)]
        assert sorted(got) == sorted(want)
        total += len(want)
    assert total > 300


def test_words_that_share_a_hash_are_two_words():
    """Thue-Morse words of 1,024 letters, whose polynomial hashes modulo 2**64 agree."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    s = periodic.Scan(pa.array([" ".join([a, b] * 20), " ".join([a, a, b] * 20)]))
    assert list(zip(s.text.tolist(), s.start.tolist(), s.length.tolist(), s.period.tolist())) == [(0, 0, 40, 2), (1, 0, 60, 3)]


def brute_digest(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_op12_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    short = docs.filter(F.length("text") < 12_000).select("doc_id", "text")
    odd = [(None, "a b " * 30), (7, None), (8, ""), (9, " \t\n\x0b "), (10, "é x " * 50 + "end"), (11, "a b c " * 9), (11, "a b c " * 9),
           (12, "x" * 70_000 + " y"), (13, "long " * 30), (zlib_id(), "one two three four five six seven eight " * 9)]
    rows = short.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    rows.withColumns({c: F.lit(1) for c in ("id", "row", "crc", "start")}).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, periodic.op12_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    want = sorted((brute_digest(*r) for r in rows.collect()), key=repr)
    assert got == want and sum(r[1] > 0 for r in want) > 10


def zlib_id():
    return next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0)


def test_a_run_longer_than_a_slice(spark):
    words = [f"w{i}" for i in range(70_000)]
    text = "start " + " ".join(words * 3) + " end"  # over a megabyte
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    assert [tuple(r) for r in periodic.periodic_runs(docs).collect()] == [(1, 1, 210_000, 70_000)]
    kept = {r["doc_id"]: r["text"] for r in periodic.collapsed(docs).collect()}
    assert kept == {1: "start " + " ".join(words) + " end", 2: "short"}


def test_collapsed_keeps_columns_and_clean_texts(spark):
    rows = [(1, "a  b\tc", 1, 1, 1, 1, "x"), (2, "p q " * 20 + " r", 1, 1, 1, 1, "x"), (None, None, 1, 1, 1, 1, "x"), (3, "", 1, 1, 1, 1, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = periodic.collapsed(docs)
    assert got.schema == docs.schema
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "a  b\tc", 2: "p q r", None: None, 3: ""}
    empty = docs.limit(0)
    assert periodic.collapsed(empty).count() == periodic.periodic_runs(empty).count() == 0


def test_runs_need_three_powers():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(10, np.int64), 24, 2)


# ------------------------------------------------------------ token counts

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]
CHARACTERS = list("abcXYZ019 .,'!<|>_-") + ["  ", "\n", "\t ", "é", "é", " ́", "ß", "Σ", "ς", "я", "你", "好", " ", " ", "　", "‍",
                                           "😀", "\x00", "\x1c", "\x85", "'s ", " 's", "<|endoftext|>", " <|startoftext|> ", "ﬁ", "İ", "한", "가"]


def plain(name):
    """One text after another by the library itself."""
    import public_tokenizers
    path = str(public_tokenizers.path(name))
    if name.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return path, lambda text: len(model.encode(text or ""))
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(path)
    return path, lambda text: len(model.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("name", NAMES)
def test_counts_equal_the_library(spark, name):
    path, count = plain(name)
    rng = random.Random(name)
    texts = ["".join(rng.choice(CHARACTERS) for _ in range(rng.randrange(0, 60))) for _ in range(1500)]
    texts += [None, "", " ", " \n\t ", "a", "<|endoftext|>", "a<|endoftext|>b " * 40, "one two " * 9000]
    library = tokencounts.Library(path)
    assert library.divisible and library.wordwise == (name == "word_bpe_49k.json")
    want = [count(t) for t in texts]
    for size in (16, 200, tokencounts.BATCH_BYTES):  # small ones cut nearly every text
        assert tokencounts.count_tokens(pa.array(texts), library, size).tolist() == want


def test_a_tokenizer_that_joins_words_gets_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
    vocabulary = {"a": 0, " ": 1, "b": 2, "a b": 3, "a ": 4, "?": 5}
    model = Tokenizer(models.BPE(vocabulary, [("a", " "), ("a ", "b")], unk_token="?"))
    model.save(str(tmp_path / "joins.json"))
    library = tokencounts.Library(str(tmp_path / "joins.json"))
    assert not library.divisible and not library.wordwise
    assert tokencounts.count_tokens(pa.array(["a b", "a b" * 100, None]), library, 16).tolist() == [1, 100, 0]
    model.pre_tokenizer, model.normalizer = pre_tokenizers.Whitespace(), normalizers.Replace("q", " ")
    model.save(str(tmp_path / "odd.json"))
    assert not tokencounts.Library(str(tmp_path / "odd.json")).wordwise  # a normaliser that it can't judge


def test_parts_are_cut_at_single_spaces_and_balanced():
    text = ("ab  cd ef\n gh " * 400).encode()
    parts = tokencounts.safe_parts(text, 100)
    assert b"".join(parts) == text and max(map(len, parts)) <= 150
    assert all(p.startswith(b" ") and p[1:2].isalpha() for p in parts[1:]) and not any(p.endswith(b" ") for p in parts[:-1])
    assert tokencounts.safe_parts(b"x" * 1000, 100) == [b"x" * 1000]  # no safe place


def test_held_words_are_bounded(monkeypatch):
    path, count = plain("word_bpe_49k.json")
    library = tokencounts.Library(path)
    monkeypatch.setattr(tokencounts, "WORDS_HELD", 50)
    for i in range(6):
        texts = [" ".join(f"tok{j}" for j in range(i * 20, i * 20 + 30))]
        assert tokencounts.count_tokens(pa.array(texts), library).tolist() == [count(texts[0])]
        assert len(library.held) <= 50


def test_op13_equals_the_library_row_by_row(spark, tmp_path):
    _, count = plain("word_bpe_49k.json")
    long = "many words here " * 300_000  # longer than a slice
    odd = [(None, "no id"), (7, None), (8, ""), (9, "same"), (9, "same"), (10, long), (11, "tok " * 2048), (12, "tok " * 2049)]
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    rows.withColumns({c: F.lit("x") for c in ("id", "n_tokens", "n_bytes")}).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, tokencounts.op13_token_counts(spark, str(tmp_path)).collect()), key=repr)
    want = [(i, len((t or "").encode()), n := count(t), n > 2048) for i, t in map(tuple, rows.collect())]
    assert got == sorted(want, key=repr)
    assert tokencounts.token_counts(rows.limit(0), tokencounts.default_tokenizer()).count() == 0
