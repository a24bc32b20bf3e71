"""The quality classifier against plain versions: statistics, gradients, sample and fit."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from starweave.llm import quality
from starweave.llm.language import remainder

TEXTS = ["One two two, 3 three!\nTwo two", "", None, "é É ünï. x", "A" * 300 + " b", "same same same same", "\n\n \t", "1 2 3; 4."]


def plain_statistics(text):
    """The twelve statistics of a text, from 0 to about 1, one after the other."""
    data = (text or "").encode()
    found = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    lowered = [bytes(b + 32 if 0x41 <= b < 0x5B else b for b in w) for w in found]
    share = lambda ok: sum(map(ok, data)) / max(len(data), 1)
    sign = lambda b: 0x21 <= b < 0x7F and not chr(b).isalnum()
    n, per = len(found), max(len(found), 1)
    return [math.sqrt(share(lambda b: 0x41 <= b < 0x5B)), math.sqrt(share(lambda b: 0x30 <= b < 0x3A)),
            share(lambda b: b in b" \t\n\v\f\r"), math.sqrt(share(lambda b: b == 10)), math.sqrt(share(sign)),
            math.sqrt(share(lambda b: b >= 0x80)), math.log2(1 + n) / 16, min(1, len(data) / per / 24),
            len(set(lowered)) / per, max(Counter(lowered).values(), default=0) / per,
            sum(a == b for a, b in zip(lowered, lowered[1:])) / per, sum(sign(w[-1]) for w in found) / per]


def plain_meta(v):
    if v is None or math.isnan(v):
        return 0
    return 1 if v < 0 else 2 + int(math.log2(1 + min(v, 2 ** 21)))


def row_of(index, value, offsets, i):
    return index[offsets[i]:offsets[i + 1]], value[offsets[i]:offsets[i + 1]]


def test_statistics_and_metadata_steps():
    meta = [None, 0, 1, 5, -3, 1e30, float("inf"), 1000]
    numbers = np.array([math.nan if m is None else m for m in meta], float)
    index, value, offsets = quality.features(pa.array(TEXTS), [numbers])
    for i, text in enumerate(TEXTS):
        ix, x = row_of(index, value, offsets, i)
        own = [k - (1 << quality.BITS) for k in ix.tolist() if k >= 1 << quality.BITS]
        want = [min(quality.STEPS - 1, int(s * quality.STEPS + 1e-9)) for s in plain_statistics(text)] + [plain_meta(numbers[i])]
        assert own == [k * quality.STEPS + s for k, s in enumerate(want)], text
        words = Counter(w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        length = math.sqrt(sum((1 + math.log(n)) ** 2 for n in words.values()))
        if (text or "").isascii():
            assert sorted(x[:len(words)].tolist()) == pytest.approx(sorted((1 + math.log(n)) / length for n in words.values()))
    assert np.array_equal(quality.features(pa.array(TEXTS))[0], index[(index < (1 << quality.BITS) + quality.STATS * quality.STEPS)])


def loss(bias, w, v, rows, label):
    """Log loss with every pair's product written out, in double precision."""
    total = 0.0
    for (ix, x), y in zip(rows, label):
        m = bias + sum(w[i] * a for i, a in zip(ix, x))
        m += sum(sum(p * q for p, q in zip(v[ix[i]], v[ix[j]])) * x[i] * x[j] for i in range(len(ix)) for j in range(i))
        total += math.log1p(math.exp(m)) - y * m
    return total


def test_one_step_follows_the_gradient_of_the_loss():
    index, value, offsets = quality.features(pa.array(["a b b", "b c", ""]), [np.array([3.0, math.nan, 40.0])])
    label = np.array([1.0, 0.0, 1.0])
    start, done = quality.Machine(metas=1), quality.Machine(metas=1)
    done.fit(index, value, offsets, label, epochs=1)
    rows = [(ix.tolist(), x.astype(float).tolist()) for ix, x in (row_of(index, value, offsets, i) for i in range(3))]
    used = sorted({i for ix, _ in rows for i in ix})
    assert used[-1] >= (1 << quality.BITS) + quality.STATS * quality.STEPS  # metadata takes part
    bias = math.log(2 / 1)
    w, v = {i: float(start.w[i]) for i in used}, {i: start.v[i].astype(float).tolist() for i in used}
    h = 1e-5
    for i in used:
        w[i] += h
        up = loss(bias, w, v, rows, label)
        w[i] -= 2 * h
        g = (up - loss(bias, w, v, rows, label)) / (2 * h)
        w[i] += h
        g += quality.DECAY * start.w[i]
        assert done.w[i] == pytest.approx(start.w[i] - quality.RATE * g / math.sqrt(1e-6 + g * g), abs=2e-3)
        for f in (0, quality.FACTORS - 1):
            v[i][f] += h
            up = loss(bias, w, v, rows, label)
            v[i][f] -= 2 * h
            g = (up - loss(bias, w, v, rows, label)) / (2 * h)
            v[i][f] += h
            g += quality.DECAY * start.v[i, f]
            assert done.v[i, f] == pytest.approx(start.v[i, f] - quality.RATE / 2 * g / math.sqrt(1e-6 + g * g), abs=2e-3)
    still = np.setdiff1d(np.arange(len(done.w)), used)
    assert np.array_equal(done.v[still], start.v[still]) and not done.w[still].any()


@pytest.mark.parametrize("label, sure", [([1.0, 1.0], 1), ([0.0, 0.0], 0)])
def test_labels_of_one_class(label, sure):
    machine = quality.Machine()
    index, value, offsets = quality.features(pa.array(["a b", "c"]))
    margin, _ = machine.fit(index, value, offsets, np.array(label)).margin(index, value, offsets)
    assert all((m > 3) == bool(sure) and abs(m) > 3 for m in margin)


def test_sample_is_bounded_and_takes_one_row_of_each_id(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 5 + 1), float(i)) for i in range(100)] + [(7, "zz", None), (7, "zz", 3.0), (8, None, 1.0)],
                                 "id long, text string, meta_0 double")
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(0, 100)] + [(7, 0.0), (None, 1.0), (500, 1.0)], "id long, label double")
    every = quality.sample(docs, labels)
    assert sorted(every.column("id").to_pylist()) == list(range(100))
    rows = dict(zip(every.column("id").to_pylist(), every.to_pylist()))
    for id_, text, meta in ((7, "zz", 3.0), (8, "text 8 " * 4, 8.0)):
        index, value, _ = quality.features(pa.array([text]), [np.array([meta])])
        assert rows[id_]["index"] == index.tolist() and rows[id_]["value"] == value.tolist()
    assert rows[7]["label"] == 1.0  # the larger of two labels
    order = [r.id for r in labels.filter("id < 100").select("id").distinct().selectExpr("id", "xxhash64(id) as h").orderBy("h", "id").collect()]
    assert sorted(quality.sample(docs, labels, rows=10).column("id").to_pylist()) == sorted(
        i for i in [r.id for r in labels.filter("id is not null").select("id").distinct().selectExpr("id", "xxhash64(id) as h").orderBy("h", "id").limit(10).collect()] if i < 100)
    size = {i: 8 * len(rows[i]["index"]) for i in order}
    for limit in (0, 500, 5_000, 10 ** 6):
        total, want = 0, []
        for i in order:
            total += size[i]
            if total <= limit:
                want.append(i)
        assert sorted(quality.sample(docs, labels, max_bytes=limit).column("id").to_pylist()) == sorted(want)


def test_scores_are_those_of_the_machine_fitted_by_hand(spark):
    rows = [(i, None if i % 11 == 0 else f"word{i % 3} other{i % 7} " * (i % 4), [None, 5, -2, 900][i % 4]) for i in range(60)]
    docs = spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, n_chars int, lang string, meta_0 int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int")
    held = {r.doc_id for r in docs.filter(remainder(docs.doc_id, 3) == 1).collect()}
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    known = [r for r in rows if r[0] not in held]
    numbers = lambda some: np.array([math.nan if r[2] is None else r[2] for r in some], float)
    machine = quality.Machine(metas=1).fit(*quality.features(pa.array([r[1] for r in known]), [numbers(known)]),
                                           np.array([float(r[0] % 3 == 0) for r in known]))
    margin, _ = machine.margin(*quality.features(pa.array([r[1] for r in rows]), [numbers(rows)]))
    assert {i for i, r in got.items() if r.held_out} == held and held
    for r, m in zip(rows, margin):
        assert got[r[0]].score == pytest.approx(1 / (1 + math.exp(-float(m))), abs=1e-5)
    plain = quality.quality_scores(docs.drop("n_chars", "meta_0"), labels).collect()  # no such column: all without a number
    assert len(plain) == 60 and {r.doc_id for r in plain if r.held_out} == held
    as_text = docs.drop("n_chars").selectExpr("*", "case when doc_id % 2 = 0 then 'many' else '12' end as n_chars")
    assert quality.quality_scores(as_text, labels).count() == 60
