"""WARC archives written and read in parallel, with boundary-chain verification.

Writing: pages of equal payload (SHA-256 and length) of at least 1000 bytes are
stored once, as the response with the largest page id; the others become
revisit records. Each task writes one archive of uncompressed records, named
after its attempt; only archives in the rows of finished tasks are read, so what
lost or repeated attempts leave is not.

Reading: archives are cut into byte ranges. A task looks for record magic in
its range; every place whose head can be parsed is a candidate, and its length
gives the place where the next record must begin. Magic inside payloads makes
false candidates. Within a range, pointer jumping finds where each candidate's
chain leaves the range; between ranges, Spark joins double the chains from the
start of the file until nothing new is reached. Only reachable records are
read, and the digests of their payloads are checked.

Defined cases: null html is an empty payload; a null url is ``about:blank``, one
of over 32 KiB the URN of its SHA-256; a
page without id is written without one and refers to its group's response if
there is one; rows that repeat the response's id are responses too; an empty
table gives no archives and no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .files import located, new_folder

MAGIC = b"WARC/1.1\r\n"
REVISIT_BYTES = 1000
RANGE_BYTES = 4 << 20
HEAD_BYTES = 1 << 16
URI_BYTES = 1 << 15
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)(?:\r\n|$)")


def _urn(page) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def record(page, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: a response with its payload, or a revisit of another page."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    if len(uri.encode()) > URI_BYTES:  # heads stay within HEAD_BYTES
        uri = f"urn:sha256:{hashlib.sha256(uri.encode()).hexdigest()}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Payload-Length: {len(payload)}"]
    if page is not None:
        head.append(f"Page-ID: {page}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages' archives; returns (path, size), one row per file."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.withColumn("large", F.when(F.octet_length("html") >= REVISIT_BYTES, F.sha2("html", 256)))
    kept = (rows.filter("large is not null").groupBy(F.col("large").alias("group"))
            .agg(F.max("page").alias("response"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    rows = rows.join(cut_lineage(kept), F.col("large") == F.col("group"), "left").select(
        "page", "url", "html", F.sha1("html").alias("digest"),
        F.when(~F.col("page").eqNullSafe(F.col("response")), F.col("response")).alias("refers_to"))

    def write(batches):
        system, root = located(folder)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        name, out, size = f"part-{part:06d}-{attempt}.warc", None, 0
        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("page", "url", "html", "digest", "refers_to")], strict=True):
                if out is None:
                    out = system.open_output_stream(f"{root}/{name}")
                data = record(*[v.as_py() for v in row])
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [size]})

    return cut_lineage(rows.mapInArrow(write, "path string, size long"))


def _head(data: bytes, at: int) -> tuple[int, int] | None:
    """(end of the head, length of the block) of the record at a place, if it is one."""
    end = data.find(b"\r\n\r\n", at, at + HEAD_BYTES)
    found = _LENGTH.search(data, at, end) if end >= 0 else None
    return (end + 4, int(found[1])) if found else None


def _candidates(batches):
    """(path, offset, exit): where the chain of each candidate leaves its range."""
    for batch in batches:
        for path, begin, stop in zip(*[batch.column(c).to_pylist() for c in ("path", "begin", "stop")], strict=True):
            system, name = located(path)
            with system.open_input_file(name) as f:
                data = f.read_at(stop - begin + HEAD_BYTES, begin)
            offset, following = [], []
            for m in re.finditer(re.escape(MAGIC), data[:stop - begin + len(MAGIC) - 1]):
                if head := _head(data, m.start()):
                    offset.append(begin + m.start())
                    following.append(begin + head[0] + head[1] + 4)
            if offset:
                offset, following = np.array(offset), np.array(following)
                at = np.searchsorted(offset, following)
                inside = (at < len(offset)) & (offset[np.minimum(at, len(offset) - 1)] == following)
                jump = np.where(inside, at, np.arange(len(offset)))
                while (further := jump[jump]).tolist() != jump.tolist():
                    jump = further
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(offset)), pa.array(offset), pa.array(following[jump])], ["path", "offset", "exit"])


def _records(batches):
    """The records of each range from its first reachable one on."""
    for batch in batches:
        for path, at, stop in zip(*[batch.column(c).to_pylist() for c in ("path", "offset", "stop")], strict=True):
            system, name = located(path)
            rows = []
            with system.open_input_file(name) as f:
                data, base = b"", at
                while at < stop:
                    if at + HEAD_BYTES > base + len(data):
                        data, base = f.read_at(RANGE_BYTES, at), at
                    end, length = _head(data, at - base)
                    head = data[at - base:end].decode()
                    block = data[end:end + length] if end + length <= len(data) else f.read_at(length, base + end)
                    rows.append(_parsed(head, block, path))
                    at = base + end + length + 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def _parsed(head: str, block: bytes, path: str):
    fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:] if line)
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4:]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"{path}: a payload does not match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("Page-ID"), size, digest, fields["WARC-Type"], number("Refers-To-Page-ID")


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each
    record that is reachable from its file's start."""
    width = F.lit(range_bytes).cast("long")
    ranges_ = archives.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / width))).alias("i"))
    ranges_ = ranges_.select("path", (F.col("i") * width).alias("begin"), F.least((F.col("i") + 1) * width, "size").alias("stop"))
    links = cut_lineage(ranges_.repartition(F.col("path"), F.col("begin")).mapInArrow(_candidates, "path string, offset long, exit long"))
    # only places where a chain enters a range can link one range to another
    starts = archives.select("path", F.lit(0).cast("long").alias("offset"))
    entries = links.select("path", F.col("exit").alias("offset")).unionByName(starts).distinct()
    jumps = cut_lineage(links.join(entries, ["path", "offset"], "left_semi"))
    reached = cut_lineage(starts)
    known = 0
    while (n := reached.count()) > known:
        known = n
        further = reached.join(jumps, ["path", "offset"]).select("path", F.col("exit").alias("offset"))
        reached = cut_lineage(reached.unionByName(further).distinct())
        twice = jumps.select("path", F.col("offset").alias("from"), F.col("exit").alias("offset")).join(jumps, ["path", "offset"], "left")
        jumps = cut_lineage(twice.select("path", F.col("from").alias("offset"), F.coalesce("exit", "offset").alias("exit")))
    size = archives.select("path", "size")
    live = reached.join(size, "path").filter("offset < size").select(
        "path", "offset", F.least((F.floor(F.col("offset") / width) + 1) * width, "size").alias("stop"))
    return live.repartition(F.col("path"), F.col("offset")).mapInArrow(
        _records, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame, **columns) -> DataFrame:
    """Write the pages into the shared folder as archives and read them back."""
    return read_archives(write_archives(pages, new_folder(pages.sparkSession, "warc"), **columns))


def op7_warc(spark, sf_dir: str) -> DataFrame:
    return archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP7_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN octet_length(encode(html)) >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM q
"""
