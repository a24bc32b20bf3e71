"""Token counts of whole texts by batch encoding inside Arrow functions.

A task takes its texts in slices of a few megabytes, cuts them at safe
boundaries, deals the parts in order into batches of near equal bytes and has
the library encode one batch per call. Only lengths leave the function: no id is
kept or sent to Spark.

A boundary is safe where the counts of the parts add up to the count of the
whole. ``Library`` proves this from the tokenizer's own settings (normaliser
kinds, pre-tokenizer, added tokens; for sentencepiece, that no piece holds the
space mark behind another character) and from probes:

* where the tokenizer drops white space, every white-space word is a part; the
  distinct words of a slice, told apart byte for byte, are encoded once, and a
  worker holds the counts of up to ``WORDS_HELD`` words;
* where it keeps white space but never joins what a single space parts, texts
  above ``BATCH_BYTES`` are cut before such spaces into parts of near equal size;
* any other tokenizer gets its texts whole, whatever their size.

Defined cases: null and empty texts have 0 bytes and 0 tokens; rows without id
and rows that repeat an id are counted each; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import SPACE_WORDS, slices, tidy
from .tokenfiles import default_tokenizer
from .wordarrays import word_array

SLICE_BYTES = 4 << 20
BATCH_BYTES = 1 << 18
WORDS_HELD = 1 << 18
TOKEN_LIMIT = 2048
MARK = "▁"  # sentencepiece's space
# Normalisers that look at no more than neighbouring letters, or at runs of white space.
_LOCAL = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "BertNormalizer"}
_PROBES = ["ab cd", "Ab, cd. Ef", "x1 2y", "it 's", "a' s", "é ́a", "<|endoftext|> a", "你 好"]


class Library:
    """One tokenizer file: counts of a batch of texts, and how texts may be cut.
    ``divisible``: before single spaces, each cut leaving out ``cut_space``
    characters. ``wordwise``: at all white space, which has no tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.cut_space, drops_space = 0, False
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            self.cut_space = 1  # the mark that starts every text stands for the space
            local = not any(MARK in p.lstrip(MARK) for p in pieces)
        else:
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.counts = lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            local = _parts_at_spaces(model)
            drops_space = local and not model.pre_tokenizer.pre_tokenize_str(" \t\n\v\f\r ")
        self.divisible = local and all(self._adds_up(p) for p in _PROBES)
        self.wordwise = self.divisible and drops_space and all(
            sum(self.counts(p.split(" "))) == n for p, n in zip(_PROBES, self.counts(_PROBES), strict=True))
        self.held, self.held_counts = pa.array([], pa.large_binary()), np.empty(0, np.int64)

    def _adds_up(self, probe: str) -> bool:
        at = probe.index(" ")
        return sum(self.counts([probe[:at], probe[at + self.cut_space:]])) == self.counts([probe])[0]


def _parts_at_spaces(model) -> bool:
    """Whether a tokenizer's settings keep what stands on two sides of a space apart."""
    settings = json.loads(model.to_str())
    kinds, todo = [], [settings["normalizer"]]
    while todo:
        step = todo.pop()
        if step and step["type"] == "Sequence":
            todo += step["normalizers"]
        elif step:
            spaces = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
            kinds.append(spaces or step["type"] in _LOCAL)
    plain = [not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and " " not in t["content"]
             for t in settings["added_tokens"]]
    split = model.pre_tokenizer is not None and len(model.pre_tokenizer.pre_tokenize_str("ab cd")) == 2
    return all(kinds) and all(plain) and split


def worker_library(path: str) -> Library:
    """One per worker process; tasks bring their own copy of this module, so it
    is kept with pyarrow's."""
    held = pa.__dict__.setdefault("_starweave_token_libraries", {})
    if path not in held:
        held[path] = Library(path)
    return held[path]


def safe_parts(text: bytes, limit: int, cut_space: int = 0) -> list[bytes]:
    """The text in parts of near equal size, none above ``limit`` where its
    single spaces allow it."""
    if len(text) <= limit:
        return [text]
    data = np.frombuffer(text, np.uint8)
    other = SPACE_WORDS[data]
    cuts = np.flatnonzero((data[1:-1] == 0x20) & other[:-2] & other[2:]) + 1
    n = -(-len(data) // limit)  # parts
    wanted = np.arange(1, n) * len(data) // n
    at = np.searchsorted(cuts, wanted, "right") - 1  # the last safe place up to each wanted one
    at = np.unique(cuts[np.maximum(at, 0)]) if len(cuts) else cuts
    begin = [0, *(at + cut_space).tolist()]
    return [text[a:b] for a, b in zip(begin, [*at.tolist(), len(text)], strict=True)]


def _in_batches(parts: list[str], size: np.ndarray, library: Library, batch_bytes: int) -> np.ndarray:
    """Counts of all parts, encoded in batches of near equal bytes."""
    total = max(1, int(size.sum()))
    batches = -(-total // batch_bytes)
    batch = np.minimum((np.cumsum(size) - (size + 1) // 2) * batches // total, batches - 1)
    edges = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(parts)]
    return np.array([n for a, b in zip(edges, edges[1:]) for n in library.counts(parts[a:b])], np.int64)


def _by_words(column: pa.Array, library: Library, batch_bytes: int) -> np.ndarray:
    words, first = word_array(column)
    coded = words.dictionary_encode()
    known = pc.index_in(coded.dictionary, value_set=library.held)
    new = coded.dictionary.filter(known.is_null())
    if len(new):
        if len(library.held) + len(new) > WORDS_HELD:
            library.held, library.held_counts, new = new.slice(0, 0), library.held_counts[:0], coded.dictionary
        counts = _in_batches([w.decode() for w in new.to_pylist()], pc.binary_length(new).to_numpy(), library, batch_bytes)
        library.held = pa.concat_arrays([library.held, new])
        library.held_counts = np.concatenate([library.held_counts, counts])
        known = pc.index_in(coded.dictionary, value_set=library.held)
    counts = library.held_counts[known.to_numpy(zero_copy_only=False)][coded.indices.to_numpy(zero_copy_only=False)]
    return np.diff(np.concatenate(([0], np.cumsum(counts)))[first])


def _by_parts(column: pa.Array, library: Library, batch_bytes: int) -> np.ndarray:
    parts, length, owner = [], [], []
    for i, text in enumerate(column.to_pylist()):
        data = text.encode()
        cut = safe_parts(data, batch_bytes, library.cut_space) if library.divisible else [data]
        parts += [p.decode() for p in cut]
        length += [len(p) for p in cut]
        owner += [i] * len(cut)
    out = np.zeros(len(column), np.int64)
    np.add.at(out, np.array(owner, np.int64), _in_batches(parts, np.array(length, np.int64), library, batch_bytes))
    return out


def count_tokens(column: pa.Array, library: Library, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """The number of tokens of every text of a column."""
    way = _by_words if library.wordwise else _by_parts
    return way(pc.fill_null(column, ""), library, batch_bytes)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = TOKEN_LIMIT, id_col: str = "doc_id",
                 text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def count(batches):
        tidy()
        library = worker_library(tokenizer)
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES, 4096):
                texts = piece.column("text")
                size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                n = pa.array(count_tokens(texts, library, batch_bytes))
                yield pa.RecordBatch.from_arrays([piece.column("id"), size, n, pc.greater(n, limit)],
                                                 ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
