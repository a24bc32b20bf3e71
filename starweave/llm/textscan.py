"""Vectorised words of Arrow text batches: positions, 64-bit hashes, n-grams.

Tasks read Arrow batches and look at whole texts in slices of a few megabytes,
so a task's memory follows the slice (or its one longest text), not the
partition. Words are hashed by mixed lanes of eight bytes; hashes of n-grams are
polynomials modulo 2**64 over these, so that any n-gram's hash is one difference
of prefix sums. (Sequences that collide under such polynomials are a thousand
words long; no n-gram or span hashed here comes near.) A key drawn for a run
enters every lane, so that words which collide cannot be made beforehand.
"""

from __future__ import annotations

import gc
import secrets
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
_HASH_BLOCK = 1 << 19  # powers kept ahead

# Word rules as tables over byte values (all bytes of multi-byte characters
# are 0x80 and above, so byte rules equal the character rules).
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x41:0x5B] = ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_SAME = np.arange(256, dtype=np.uint8)
_LANE = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)  # the first n bytes of a lane


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, min(2 * len(self.up), _HASH_BLOCK))
            self.up = np.cumprod(np.concatenate(([U64(1)], np.full(size - 1, self.base, U64))), dtype=U64)
            self.down = np.cumprod(np.concatenate(([U64(1)], np.full(size - 1, self.inverse, U64))), dtype=U64)
        return self.up[:n], self.down[:n]


_WORDS = _Powers(_WORD_BASE)


@dataclass
class Words:
    """Words of a batch: byte range and hash of each, and ``first``, the index
    of each text's first word with the total at the end."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the texts' offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def run_key() -> int:
    """A key for the word hashes of one run."""
    return secrets.randbits(64)


def words(column: pa.Array, rule: np.ndarray = SPACE_WORDS, lower: bool = True, key: int = 0) -> Words:
    """Words of every text by a byte rule, A-Z lowered before hashing on request."""
    data, offsets = utf8(column)
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.empty(0, U64), np.zeros(len(offsets), np.int64))
    inside = rule[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[edge] = False
    start = np.flatnonzero(inside & ~before)
    before[-1], before[:-1] = False, inside[1:]
    before[edge - 1] = False
    end = np.flatnonzero(inside & ~before) + 1
    table = _LOWER if lower else _SAME
    hashes = _word_hashes(data, start, end, table, key) if key else _word_hashes(data, start, end, table)
    return Words(data, start, end, hashes, np.searchsorted(start, offsets))


def _word_hashes(data, start, end, table, key: int = 0) -> np.ndarray:
    """Sum over the words' lanes of eight bytes, each mixed with its place and
    the key. The mixing is not linear, so words built to collide under
    polynomials don't."""
    bytes_ = np.zeros(len(data) + 8, np.uint8)
    bytes_[:len(data)] = table[data]
    lane_at = np.ndarray((len(data) + 1,), "<u8", bytes_, strides=(1,))  # the eight bytes from each place on
    size = end - start
    out = mix((lane_at[start] & _LANE[np.minimum(size, 8)]) + U64((_BYTE_BASE + key) % (1 << 64)))
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] + 7) // 8 - 1
        word, lane = np.repeat(long, more), ranges(np.ones(len(long), np.int64), more)
        value = lane_at[start[word] + 8 * lane] & _LANE[np.minimum(size[word] - 8 * lane, 8)]
        out[long] += np.add.reduceat(mix(value + mix(lane.astype(U64) * U64(_BYTE_BASE) + U64(key))), np.cumsum(more) - more)
    return mix(out ^ (size.astype(U64) * U64(_WORD_BASE)))


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray, lower: bool = True) -> np.ndarray:
    """Whether word i of one batch is word j of another, byte for byte."""
    size = a.end[i] - a.start[i]
    out = size == b.end[j] - b.start[j]
    at = np.flatnonzero(out)
    if len(at):
        table = _LOWER if lower else _SAME
        left, right = (table[w.data[ranges(w.start[k[at]], size[at])]] for w, k in ((a, i), (b, j)))
        out[at] = np.logical_and.reduceat(left == right, np.cumsum(size[at]) - size[at])
    return out


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (across text borders too)."""
    if len(hashes) < n:
        return np.empty(0, U64)
    up, down = _WORDS.to(len(hashes) + 1)
    sums = np.concatenate(([U64(0)], np.cumsum(hashes * up[:-1], dtype=U64)))
    return mix((sums[n:] - sums[:-n]) * down[:len(hashes) - n + 1])


def spans(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words in each range [start, end)."""
    up, down = _WORDS.to(len(hashes) + 1)
    sums = np.concatenate(([U64(0)], np.cumsum(hashes * up[:-1], dtype=U64)))
    return mix((sums[end] - sums[start]) * down[start] ^ (end - start).astype(U64))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The integers start, start+1, ... (count of them) of every row, in a row."""
    total = int(count.sum())
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(total)


def slices(batch: pa.RecordBatch, text: str, max_bytes: int, max_rows: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most so many text bytes (one text
    alone may hold more)."""
    column = batch.column(batch.schema.get_field_index(text))
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        done = size[i - 1] if i else 0
        j = min(max(i + 1, int(np.searchsorted(size, done + max_bytes, "right"))), i + max_rows)
        yield batch.slice(i, j - i)
        i = j


def tidy() -> None:
    """Free what earlier tasks of this worker left: their copies of these
    modules are cycles, and Arrow keeps what it has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def map_texts(df, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text",
              max_bytes: int = 1 << 20, max_rows: int = 4096):
    """``mapInArrow`` over slices of the frame's batches."""
    def run(batches):
        tidy()
        for batch in batches:
            for part in slices(batch, text, max_bytes, max_rows):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def keep_rows(df, mask: Callable[[pa.Array], np.ndarray], text: str = "text", max_bytes: int = 1 << 20):
    """The rows, with all their columns, whose texts a function of a text column keeps."""
    def run(batches):
        tidy()
        for batch in batches:
            for part in slices(batch, text, max_bytes, 4096):
                out = part.filter(pa.array(mask(part.column(part.schema.get_field_index(text)))))
                if out.num_rows:
                    yield out
    return df.mapInArrow(run, df.schema)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
