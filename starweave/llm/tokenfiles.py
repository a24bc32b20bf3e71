"""Token ids in length-delimited binary files with an offset index.

Documents are sorted by id across files; a task encodes its range and writes

* ``part-N-A.tok``: an 8-byte head (``SWTOK1``, id width in bytes, 0), then one
  record per document: payload length (u64), its masked checksum (u32), the ids
  in little-endian order, their masked checksum (u32);
* ``part-N-A.idx``: per record the document id, whether it is null, the record's
  offset and its number of ids, so that readers can take records in any order.

Checksums are CRC-32, rotated right by 15 bits and offset by a constant, so
that a checksum of data that holds checksums stays sound. Ids are stored in two
bytes where the vocabulary allows it.

Texts are encoded by the tokenizers library. Where its normaliser and
pre-tokenizer never join what white space parts, nor a letter and a full stop, and
ignore case, each distinct piece of a task's texts, told by its bytes, is encoded once
and the ids are gathered; texts of other tokenizers are encoded whole.

A file's name holds the attempt that wrote it, and only files named in the rows
that the finished tasks return are read: what lost or repeated attempts leave is not.

Defined cases: null and empty texts hold the end id alone; rows without id come
first; rows that repeat an id keep a record each, ordered by text; an empty
table gives no files and no rows; further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, files_for
from .files import located, new_folder
from .textscan import ALNUM_WORDS, ranges, slices, tidy
from .wordarrays import word_array

HEAD = b"SWTOK1"
INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("n", "<u4")])
END_ID = 1
MASK_DELTA = 0xA282EAD8
WORDS_HELD = 3 << 18
READ_BYTES = 8 << 20
READ_IDS = 1 << 22  # in the files of one reading task
_LETTERS = ALNUM_WORDS & (np.arange(256) < 0x80)


def masked(data: bytes) -> int:
    """Masked CRC-32 of the bytes."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts in a row, and the index of each text's first with
    the total at the end. A piece is a word; the last comma or full stop of one
    is a piece of its own where it follows an ASCII letter or digit, as the
    tokenizer parts them there as well. It lowers all text but its own special
    tokens, so A-Z are lowered here in pieces without ``<``."""
    found, first = word_array(column)
    at = np.frombuffer(found.buffers()[1], np.int64)
    data = np.frombuffer(found.buffers()[2], np.uint8)
    if not len(data):
        return found, first
    end = at[1:]
    last = data[end - 1]
    cut = ((last == 0x2C) | (last == 0x2E)) & (np.diff(at) > 1) & _LETTERS[data[end - 2]]
    parted = np.sort(np.concatenate((at, end[cut] - 1)))
    lowered = data + 0x20 * ((data >= 0x41) & (data <= 0x5A)).astype(np.uint8)
    angled = np.unique(np.searchsorted(parted, np.flatnonzero(data == 0x3C), "right") - 1)
    own = ranges(parted[angled], parted[angled + 1] - parted[angled])
    lowered[own] = data[own]
    out = pa.Array.from_buffers(pa.large_binary(), len(parted) - 1, [None, pa.py_buffer(parted), pa.py_buffer(lowered)])
    return out, np.searchsorted(parted[:-1], at[first])


class Encoder:
    """Encodes columns of texts, each distinct word once while it is held."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.by_pieces = self._parts_pieces(path)
        self._forget()

    def _parts_pieces(self, path: str) -> bool:
        """Whether the tokenizer drops white space, ignores case and parts a comma
        or full stop from what it follows, as ``pieces`` assumes."""
        from .tokencounts import Library
        if not Library(path).wordwise:
            return False
        lower = self.library.normalizer is not None and self.library.normalizer.normalize_str("AZ") == "az"
        return lower and all(len(self.library.pre_tokenizer.pre_tokenize_str(p)) == 2 for p in ("b,", "b.", "1,", "1."))

    def _forget(self):
        self.held: dict[bytes, int] = {}
        self.at, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, new: list[bytes]) -> None:
        encoded = [e.ids for e in self.library.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)]
        n = np.array([len(e) for e in encoded], np.int64)
        self.held.update(zip(new, range(len(self.held), len(self.held) + len(new)), strict=True))
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(n) - n])
        self.n = np.concatenate([self.n, n])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(encoded), np.uint32)])

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each ended, and their counts."""
        if not self.by_pieces:
            texts = [t or "" for t in column.to_pylist()]
            ids = [e.ids + [end_id] for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for e in ids for i in e], np.uint32), np.array([len(e) for e in ids], np.int64)
        found, first = pieces(column)
        distinct = found.dictionary_encode()
        if len(self.held) > WORDS_HELD:
            self._forget()
        own = distinct.dictionary.to_numpy(zero_copy_only=False)
        place = np.fromiter(map(self.held.get, own, repeat(-1)), np.int64, len(own))
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = np.arange(len(new)) + len(self.held)
            self._learn(own[new].tolist())
        place = place[distinct.indices.to_numpy()]
        n = self.n[place]
        ids = self.ids[ranges(self.at[place], n)]
        ends = np.concatenate(([0], np.cumsum(n)))[first]
        return np.insert(ids, ends[1:], end_id), np.diff(ends) + 1


def worker_encoder(path: str) -> Encoder:
    """One encoder per worker process, whose pieces serve all its tasks. Tasks
    bring their own copy of this module, so it is kept with the library."""
    import tokenizers
    held = tokenizers.__dict__.setdefault("_starweave_encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files; returns (part, path, docs, ids), one row per file."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # the beginnings of texts spread rows that share an id, or have none
    rows = rows.repartitionByRange("id", F.substring("text", 1, 64)).sortWithinPartitions("id", "text")

    def write(batches):
        tidy()
        encoder = worker_encoder(tokenizer)
        width = 2 if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else 4
        kind = np.dtype(f"<u{width}")
        system, root = located(folder)
        part = TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()
        name = f"part-{part:06d}-{attempt}"
        out = index = None
        total = count = 0
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20, 4096):
                if out is None:
                    out, index = [system.open_output_stream(f"{root}/{name}.{end}") for end in ("tok", "idx")]
                    out.write(HEAD + bytes([width, 0]))
                    offset = len(HEAD) + 2
                ids, n = encoder.encode(piece.column("text"), end_id)
                data = ids.astype(kind).tobytes()
                entries = np.zeros(len(n), INDEX)
                entries["id"] = piece.column("id").fill_null(0).to_numpy()
                entries["null"] = piece.column("id").is_null().to_numpy(zero_copy_only=False)
                entries["n"] = n
                end = np.cumsum(n) * width
                frames = []
                for a, b in zip((end - n * width).tolist(), end.tolist(), strict=True):
                    length = (b - a).to_bytes(8, "little")
                    frames += [length, masked(length).to_bytes(4, "little"), data[a:b], masked(data[a:b]).to_bytes(4, "little")]
                size = n * width + 16
                entries["offset"] = offset + np.cumsum(size) - size
                offset += int(size.sum())
                out.write(b"".join(frames))
                index.write(entries.tobytes())
                total, count = total + int(n.sum()), count + len(n)
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/{name}"], "docs": [count], "ids": [total]})

    # dealt by the part, so that a part that is written again still has one row
    written = rows.mapInArrow(write, "part long, path string, docs long, ids long").repartition("part")
    return cut_lineage(written, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_record(stream, offset: int, n: int, width: int) -> np.ndarray:
    """The ids of one record, its frame checked."""
    data = stream.read_at(16 + n * width, offset)
    return _checked(data, n, width)


def _checked(data: bytes, n: int, width: int) -> np.ndarray:
    length, body = data[:8], data[12:12 + n * width]
    if (int.from_bytes(length, "little") != n * width or int.from_bytes(data[8:12], "little") != masked(length)
            or int.from_bytes(data[12 + n * width:16 + n * width], "little") != masked(body)):
        raise ValueError("a token record does not match its checksums")
    return np.frombuffer(body, f"<u{width}")


def read_tokens(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record of the files."""
    listed = files.orderBy("part").collect()  # one row per written file
    manifest, start = [], 0
    for f in listed:
        manifest.append((f["path"], start))
        start += f["ids"]

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                system, name = located(path)
                with system.open_input_stream(f"{name}.idx") as f:
                    entries = np.frombuffer(f.read(), INDEX)
                starts = base + np.cumsum(entries["n"].astype(np.int64)) - entries["n"]
                with system.open_input_stream(f"{name}.tok") as f:
                    head = f.read(len(HEAD) + 2)
                    if head[:len(HEAD)] != HEAD:
                        raise ValueError(f"{path} is no token file")
                    width = head[len(HEAD)]
                    size = entries["n"].astype(np.int64) * width + 16
                    until = np.cumsum(size)
                    i = 0
                    while i < len(entries):
                        done = until[i - 1] if i else 0
                        j = max(i + 1, int(np.searchsorted(until, done + READ_BYTES, "right")))
                        data = f.read(int(until[j - 1] - done))
                        crc = []
                        for k in range(i, j):
                            a = int(until[k] - size[k] - done)
                            if int(entries["offset"][k]) != len(HEAD) + 2 + done + a:
                                raise ValueError(f"{path}: the index does not match the records")
                            ids = _checked(data[a:a + int(size[k])], int(entries["n"][k]), width)
                            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(entries["id"][i:j].astype(np.int64), mask=entries["null"][i:j].astype(bool)),
                             pa.array(starts[i:j]), pa.array(entries["n"][i:j].astype(np.int64)), pa.array(crc, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])
                        i = j

    tasks = max(1, min(len(manifest), max(files_for(spark, 0), -(-start // READ_IDS))))
    frame = spark.createDataFrame(manifest, "path string, start long").repartition(tasks)
    return frame.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = END_ID, **columns) -> DataFrame:
    """Write the documents' tokens into the shared folder and read them back."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, new_folder(spark, "tokens"), tokenizer, end_id, **columns))


def default_tokenizer() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op9_token_ids(spark, sf_dir: str) -> DataFrame:
    return tokenised(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
