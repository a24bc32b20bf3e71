"""Language identification by rank-order profiles of letter n-grams.

A profile lists a text's n-grams (one to three letters, words padded with a
space) from the most frequent on, ties by code points. A language's profile
counts all its training texts. A document's distance to a language is the sum
over its own profile of how far each n-gram's rank is out of place, or a fixed
penalty where the language's profile lacks it; the least distance wins, ties go
to the name that sorts first.

Counting: tasks sum up their n-grams before they emit them, and each language's
first ranks alone reach the driver (languages times PROFILE rows).

Defined cases: null text and texts without a letter are ``und`` with score 0;
without any training row every text is ``und``; rows with a null id are never
learned from and not held out; rows that repeat an id are rows of their own; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textscan import keep_rows, map_texts, slices, tidy

PROFILE = 400
UNKNOWN = "und"
GRAMS_HELD = 1 << 21
SLICE_BYTES = 1 << 18
SPACE = 32


def remainder(id_: Column, divisor: int) -> Column:
    """CRC-32 of the id's text form, modulo the divisor."""
    return F.crc32(id_.cast("string").cast("binary")) % divisor


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of the 1-, 2- and 3-grams that begin at each place as rows, 0 where
    there is none; offsets of the texts' places; letters per text)."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in lowered])))
    present = np.flatnonzero(np.bincount(points))
    table = np.zeros(int(points.max()) + 1, bool)
    table[present] = [chr(c).isalpha() for c in present.tolist()]
    letter = table[points]
    after = np.concatenate(([False], letter[:-1]))
    keep = letter | after  # letters, and one space after each word
    kept = np.concatenate(([0], np.cumsum(keep)))[first]
    code = np.where(letter, points, SPACE)[keep]
    is_letter = letter[keep]
    letters = np.diff(np.concatenate(([0], np.cumsum(letter)))[first])
    n = len(code)
    out = np.zeros((5, n), np.int64)
    one = np.concatenate((code, [SPACE, SPACE]))
    ok = np.concatenate((is_letter, [False, False]))
    begins = is_letter & np.concatenate(([True], ~is_letter[:-1]))
    out[0] = np.where(is_letter, one[:n], 0)
    out[1] = np.where(is_letter, one[:n] << 21 | one[1:n + 1], 0)                               # ab, and a_ at a word's end
    out[2] = np.where(is_letter & ok[1:n + 1], one[:n] << 42 | one[1:n + 1] << 21 | one[2:n + 2], 0)
    out[3] = np.where(begins, SPACE << 21 | one[:n], 0)                                         # _a
    out[4] = np.where(begins, SPACE << 42 | one[:n] << 21 | one[1:n + 1], 0)                    # _ab, and _a_
    return out, kept, letters


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes[codes > 0])
    if not len(codes):
        return codes, codes
    new = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[new], np.diff(np.append(new, len(codes)))


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams in order, ties by code."""
    code, n = counted(codes)
    if not len(code):
        return code
    order = np.sort((n.max() - n) * len(code) + np.arange(len(code)))[:size]
    return code[order % len(code)]


def learn(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles by language from (text, lang)."""
    def count(batches):
        tidy()
        held: dict[str, list] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES, 4096):
                rows, first, _ = grams(part.column("text").to_pylist())
                langs = np.array(part.column("lang").to_pylist(), object)
                owner = np.repeat(langs, np.diff(first))
                for lang in sorted(set(langs)):
                    code, n = counted(rows[:, owner == lang].reshape(-1))
                    if lang in held:
                        held[lang] = _added(held[lang], code, n)
                    else:
                        held[lang] = [code, n]
            if sum(len(code) for code, _ in held.values()) > GRAMS_HELD:
                yield from emitted(held)
                held = {}
        yield from emitted(held)

    def emitted(held):
        for lang, (code, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n)], ["lang", "gram", "n"])

    counts = (docs.select("text", "lang").filter("text is not null and lang is not null")
              .mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    profiles: dict[str, list[int]] = {}
    for row in counts.withColumn("rank", rank).filter(F.col("rank") <= size).orderBy("lang", "rank").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def _added(held, code, n):
    both, which = np.unique(np.concatenate([held[0], code]), return_inverse=True)
    return [both, np.bincount(which, np.concatenate([held[1], n]), len(both)).astype(np.int64)]


def classifier(profiles: dict[str, list[int]], size: int = PROFILE):
    """A function from texts to (languages, scores)."""
    names = sorted(profiles)
    known = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
    place = np.full((len(names), len(known) + 1), -1)  # the last column: n-grams of no profile
    for i, name in enumerate(names):
        place[i, np.searchsorted(known, profiles[name])] = np.arange(len(profiles[name]))

    def classify(column: pa.Array) -> tuple[list[str], np.ndarray]:
        texts = [t or "" for t in column.to_pylist()]
        rows, first, _ = grams(texts)
        own = [ranked(rows[:, a:b].reshape(-1), size) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        n = np.array([len(o) for o in own])
        pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if names and n.sum():
            codes = np.concatenate(own)
            rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            at = np.where(known[at] == codes, at, len(known))
            live = np.flatnonzero(n)
            edges = (np.cumsum(n) - n)[live]
            distance = np.stack([np.add.reduceat(np.where(place[i][at] >= 0, np.abs(place[i][at] - rank), size), edges)
                                 for i in range(len(names))])
            best = distance.argmin(axis=0)
            score[live] = 1 - distance[best, np.arange(len(live))] / (n[live] * size)
            for doc, b in zip(live.tolist(), best.tolist(), strict=True):
                pred[doc] = names[b]
        return pred, score

    return classify


def predict(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for (id, held_out, text)."""
    classify = classifier(profiles)

    def label(part: pa.RecordBatch) -> pa.RecordBatch:
        pred, score = classify(part.column("text"))
        return pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), pa.array(pred), pa.array(score)],
                                          ["doc_id", "held_out", "lang_pred", "score"])

    return map_texts(docs, label, "doc_id long, held_out boolean, lang_pred string, score double", max_bytes=SLICE_BYTES)


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(text, lang) of the rows that may be learned from."""
    return docs.filter(remainder(F.col(id_col), 4) != 2).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))


def identified(docs: DataFrame, text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs``, as they are, whose language is known (not ``und``)."""
    classify = classifier(learn(training_rows(docs, text_col=text_col, **columns)))
    return keep_rows(docs, lambda texts: np.array([p != UNKNOWN for p in classify(texts)[0]], bool), text_col, SLICE_BYTES)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score): profiles from the rows that are not
    held out, a prediction for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       (remainder(F.col(id_col), 4) == 2).alias("held_out"))
    profiles = learn(training_rows(docs, id_col, text_col, lang_col))
    return predict(rows.select("id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out")), profiles)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
