"""WARC archives: one gzip member per record, written by tasks and read back as streams.

Payloads are deduplicated by digest before writing: of equal payloads of at least ``MIN_REVISIT`` bytes the
least page id is the response and the others are revisits without a body. The digests travel alone; a group
of copies, however large, collapses in a partial aggregation, and its rows are split by adaptive execution
where they join their response id.

Writers roll to a new file at ``file_bytes``. A file name carries the attempt's own random part and the
manifest, which is stored, lists only files of committed attempts, so lost executors and repeated tasks
leave unlisted files behind but never a wrong result. Files go through the Arrow file system of the shared
folder; nothing touches a local disk.

The reader walks a file forward only: compressed blocks are inflated as they come, members follow each
other, headers end at an empty line, ``Content-Length`` frames the block, and digests are computed on the fly.
Memory is one block of input plus one record.

Defined results
---------------
* Null or empty html is an empty payload. An empty table gives no file and an empty result.
* Repeated page ids: each row is written. Rows that repeat both id and payload of a response are responses too.
* Null page ids count as larger than all others; a payload that only they share is never revisited.
* A record whose digest, length or gzip member is broken raises ``ValueError``; with ``strict=False`` its row
  has ``verified`` false and reading goes on behind a broken digest, and ends the file at a broken member.
* Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomart.operators.staging import checkpoint_root, stage

MIN_REVISIT = 100
# Rows of some 100 bytes; more shared payloads are joined through the shuffle.
BROADCAST_ROWS = 500_000
# Compressed bytes that one reading task takes once there are more files than tasks.
TASK_BYTES = 256 << 20
FILE_BYTES = 64 << 20
READ_BYTES = 1 << 16
WARC_DATE = "2024-01-01T00:00:00Z"

RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
           "verified boolean, payload binary")
_MANIFEST = "path string, records long, bytes long"


def _filesystem(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:/") else f"file://{path}")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, html, digest, first): ``first`` is the response of the payload, null if not shared."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    digest = F.sha2(F.encode("html", "UTF-8"), 256)
    large = F.octet_length("html") >= MIN_REVISIT
    narrow = rows.filter(large).select("page_id", digest.alias("_digest"))
    # One row per payload that occurs more than once.
    shared = narrow.groupBy("_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    shared = stage(shared.drop("_n"), "warc-shared")
    rows = rows.withColumn("digest", digest)
    same = (F.col("digest") == F.col("_digest")) & (F.octet_length("html") >= MIN_REVISIT)
    # Payloads stay where they are unless too many of them are shared for a broadcast.
    shared = F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared
    return rows.join(shared, same, "left").drop("_digest")


def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: an HTTP response, or a revisit whose block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    # A target with line ends could forge headers; they are percent-encoded.
    target = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    name = "null" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Target-URI: {target}", f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha256:{digest}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        out, path, records, size, done = None, None, 0, 0, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first", "answers")]
            for page_id, url, html, digest, first, answers in zip(*columns):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, records, size = fs.open_output_stream(path), 0, 0
                refers_to = None if first is None or answers else first
                data = member(record(page_id, url, html.encode(), digest, refers_to))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                 pa.array([d[2] for d in done], pa.int64())], names=["path", "records", "bytes"])
    return run


def write(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES, **columns) -> tuple[DataFrame, str]:
    """Write archives below ``folder`` (default: the shared folder); returns the stored manifest and the folder."""
    planned = plan_records(pages, **columns)
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_root(spark)}/warc/{uuid.uuid4().hex}"
    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)
    return stage(planned.withColumn("answers", F.col("page_id") == F.col("first"))
                 .mapInArrow(_writer(folder, file_bytes), _MANIFEST), "warc-manifest"), folder


class Inflated(io.RawIOBase):
    """Forward-only view of concatenated gzip members, inflated block by block."""

    def __init__(self, raw, read_bytes: int = READ_BYTES):
        self.raw, self.read_bytes = raw, read_bytes
        self.buffer, self.at, self.inflater, self.left = b"", 0, None, b""

    def _more(self) -> bool:
        """Append the next piece of inflated data; False at the end of the file."""
        while True:
            data = self.left or self.raw.read(self.read_bytes)
            self.left = b""
            if not data:
                if self.inflater is not None:
                    raise ValueError("gzip member ends early")
                return False
            if self.inflater is None:
                self.inflater = zlib.decompressobj(31)
            try:
                out = self.inflater.decompress(data, self.read_bytes * 8)
            except zlib.error as broken:
                raise ValueError(f"broken gzip member: {broken}") from None
            if self.inflater.eof:
                self.left, self.inflater = self.inflater.unused_data, None
            else:
                self.left = self.inflater.unconsumed_tail
            if out:
                self.buffer, self.at = self.buffer[self.at:] + out, 0
                return True

    def line(self) -> bytes:
        while True:
            end = self.buffer.find(b"\n", self.at)
            if end >= 0:
                out, self.at = self.buffer[self.at:end + 1], end + 1
                return out
            if not self._more():
                out, self.at = self.buffer[self.at:], len(self.buffer)
                return out

    def take(self, n: int) -> bytes:
        pieces, need = [], n
        while need:
            piece = self.buffer[self.at:self.at + need]
            self.at += len(piece)
            need -= len(piece)
            pieces.append(piece)
            if need and not self._more():
                raise ValueError("record ends early")
        return b"".join(pieces)


def _headers(source) -> dict[str, str]:
    found = {}
    while True:
        line = source.line() if isinstance(source, Inflated) else source.readline()
        text = line.rstrip(b"\r\n")
        if not text:
            return found
        name, _, value = text.partition(b":")
        found[name.decode().strip().lower()] = value.decode().strip()


def _page(urn: str):
    name = urn.strip("<>").rpartition(":")[2]
    return None if name in ("null", "") else int(name)


def read_stream(raw, strict: bool = True) -> Iterator[tuple]:
    """Records of one archive in order."""
    source = Inflated(raw)
    while True:
        try:
            line = source.line()
            while line in (b"\r\n", b"\n"):
                line = source.line()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                raise ValueError("no WARC record where one should begin")
            head = _headers(source)
            block = source.take(int(head["content-length"]))
        except ValueError:
            if strict:
                raise
            yield None, None, None, None, None, None, False, None
            return
        body = io.BytesIO(block)
        body.readline()
        http = _headers(body)
        payload, revisit = body.read(), head["warc-type"] == "revisit"
        digest = head["warc-payload-digest"].partition(":")[2]
        good = hashlib.sha256(block).hexdigest() == head["warc-block-digest"].partition(":")[2]
        good &= revisit or (hashlib.sha256(payload).hexdigest() == digest and len(payload) == int(http["content-length"]))
        if strict and not good:
            raise ValueError(f"digest of record {head['warc-record-id']} does not hold")
        url = head.get("warc-target-uri", "").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        yield (_page(head["warc-record-id"]), url, head["warc-type"], int(http["content-length"]), digest,
               _page(head["warc-refers-to"]) if revisit else None, good, None if revisit else payload)


_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("verified", pa.bool_()), ("payload", pa.binary())])


def _reader(folder: str, strict: bool, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(path) as raw:
                    for row in read_stream(raw, strict):
                        rows.append(row if with_payload else row[:-1] + (None,))
                        size += len(row[-1] or b"") if with_payload else 200
                        if size >= 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)
    return run


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def read(manifest: DataFrame, folder: str, strict: bool = True, with_payload: bool = True) -> DataFrame:
    """Records of all archives of a manifest; payloads are null for revisits or where not asked for."""
    files, size = manifest.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    parallel = manifest.sparkSession.sparkContext.defaultParallelism
    # Rows are paths, so their number says nothing of the work: a task a file, or by bytes where files are many.
    tasks = max(1, min(files, max(parallel, -(-(size or 0) // TASK_BYTES))))
    return manifest.select("path").repartition(tasks).mapInArrow(_reader(folder, strict, with_payload), RECORDS)
