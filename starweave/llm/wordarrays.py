"""White-space words of Arrow text columns as Arrow arrays, byte for byte."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .textscan import SPACE_WORDS, utf8


def word_array(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of a column of texts in a row, and the
    index of each text's first word with the total at the end. Null has none."""
    data, offsets = utf8(column)
    inside = SPACE_WORDS[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    border = offsets[(offsets > 0) & (offsets < len(data))]
    opens[border] = inside[border]
    start = np.flatnonzero(opens)
    before = np.concatenate(([0], np.cumsum(inside)))  # word bytes before each byte
    ends = np.concatenate((before[start], before[-1:]))
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    return words, np.searchsorted(start, offsets)


def word_ids(words: pa.Array) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
