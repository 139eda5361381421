"""WARC archives and a chunked record table.

Writing: each row is a record, a gzip member of its own, in files of bounded
size; of rows with equal payloads the one with the smallest id is a response
and the others are revisit records that refer to it. Tasks write files under
names of their own attempt; only files named in the manifest, a table that
Spark commits once per task, belong to the archive.

Reading: files are decompressed in a stream and a payload is cut into chunk
rows (record number, chunk number), each with the digest of the payload up to
its end. No record is held whole: the last chunk's digest is the payload's.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import open_fs, small_batches, stored, workspace

FILE_BYTES = 64 << 20
CHUNK_BYTES = 1 << 20
READ_BYTES = 1 << 20
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_URI_CHARS = ":/?#[]@!$&'()*+,;=%~"


def bare_digest(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


def record_head(key: str | None, url: str | None, size: int, digest: str, refers_to: str | None,
                refers_url: str | None = None) -> bytes:
    """WARC and HTTP headers of a record; the payload follows a response's.

    Every record has an id of its own, also rows that repeat an id. The row's
    id, and that of the row a revisit refers to, stand in ``X-Row-ID`` fields;
    the standard's fields name the referred record by target and date. A url
    that is a plain URI stands as it is; any other is percent-encoded whole
    and marked by ``X-Target-Encoding``, so both are read back unchanged."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    revisit = refers_to is not None
    target, coded = _target(url)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{uuid.uuid4().urn}>",
            f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if coded:
        head.append("X-Target-Encoding: percent")
    if key is not None:
        head.append(f"X-Row-ID: {quote(key, safe='')}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Target-URI: {_target(refers_url)[0]}",
                 f"WARC-Refers-To-Date: {DATE}", f"X-Refers-To-Row-ID: {quote(refers_to, safe='')}"]
    head += ["Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(http) + (0 if revisit else size)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http


def _target(url: str | None) -> tuple[str, bool]:
    """The url as a header field, and whether it had to be encoded."""
    url = url or "about:blank"
    if quote(url, safe=_URI_CHARS) == url:
        return url, False
    return quote(url, safe=""), True


def _key(coded: str | None) -> str | None:
    return None if coded is None else unquote(coded)


_MANIFEST = "part int, file string, records bigint, bytes bigint"


def _write_task(root: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        fs, base = open_fs(root)
        out, name, records, size = None, None, 0, 0

        def close():
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]), pa.array([records], pa.int64()),
                 pa.array([size], pa.int64())], ["part", "file", "records", "bytes"])

        for b in batches:
            cols = [b.column(k).to_pylist() for k in (0, 1, 3, 4, 5)]
            payloads = b.column(2).cast(pa.binary())
            for i, (key, url, sha1, refers, refers_url) in enumerate(zip(*cols)):
                if out is None:
                    name, records, size = f"part-{part:05d}-{uuid.uuid4().hex[:8]}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}")
                payload = memoryview(payloads[i].as_buffer())
                gz = zlib.compressobj(4, zlib.DEFLATED, 31)
                parts = [record_head(key, url, len(payload), bare_digest(bytes.fromhex(sha1)), refers,
                                     refers_url)]
                if refers is None:
                    parts += [payload[lo:lo + CHUNK_BYTES] for lo in range(0, len(payload), CHUNK_BYTES)]
                for p in (*parts, b"\r\n\r\n"):
                    packed = gz.compress(p)
                    out.write(packed)
                    size += len(packed)
                packed = gz.flush()
                out.write(packed)
                size += len(packed)
                records += 1
                if size >= file_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return run


def write_archives(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", root: str | None = None, min_revisit_bytes: int = 0,
                   file_bytes: int = FILE_BYTES) -> tuple[DataFrame, str]:
    """Write a record per row; returns (manifest, root).

    A null payload is empty. Of rows with equal payloads of at least
    ``min_revisit_bytes``, those with the smallest id are responses (rows that
    repeat an id and payload are one capture written twice), the rest revisit
    it; rows without an id are always responses. Every row is a record with a
    record id of its own. A null or empty url is written as ``about:blank``;
    others are read back as they are; an empty table writes no file; further columns are ignored.
    """
    small_batches(spark)
    root = root or workspace(spark, "warc")
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    src = src.withColumn("sha1", F.sha1(F.encode("payload", "UTF-8")))
    narrow = src.filter((F.octet_length("payload") >= min_revisit_bytes) & F.col("id").isNotNull()).select("id", "sha1", "url")
    first = (narrow.groupBy("sha1").agg(F.min(F.struct("id", "url")).alias("f"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("sha1", F.col("f.id").alias("first"), F.col("f.url").alias("first_url")))
    refers = (narrow.select("id", "sha1").join(first, "sha1").filter("id <> first")
              .select("id", "sha1", "first", "first_url").distinct().withColumnRenamed("id", "rid").withColumnRenamed("sha1", "rsha1"))
    rows = (src.join(refers, (F.col("id") == F.col("rid")) & (F.col("sha1") == F.col("rsha1")), "left")
            .select(F.col("id").cast("string").alias("key"), "url", "payload", "sha1",
                    F.when(F.octet_length("payload") >= min_revisit_bytes, F.col("first")).cast("string").alias("refers"),
                    "first_url"))
    return stored(spark, rows.mapInArrow(_write_task(root, file_bytes), _MANIFEST), "warc-manifest"), root


class _Stream:
    """Decompressed bytes of a file of gzip members, a bounded piece at a time."""

    def __init__(self, f):
        self.f, self.raw, self.buf, self.at = f, b"", bytearray(), 0
        self.gz = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.gz.eof:
                self.raw = self.gz.unused_data + self.raw
                self.gz = zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.f.read(READ_BYTES)
                if not self.raw:
                    return False
            got = self.gz.decompress(self.raw, READ_BYTES)
            self.raw = self.gz.unconsumed_tail
            if got:
                del self.buf[:self.at]
                self.at = 0
                self.buf += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.buf.find(mark, self.at)) < 0:
            if not self.more():
                if self.buf[self.at:].strip():
                    raise ValueError("cut record")
                return None
        out = bytes(self.buf[self.at:at])
        self.at = at + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) - self.at < n:
            if not self.more():
                raise ValueError("cut record")
        out = bytes(self.buf[self.at:self.at + n])
        self.at += n
        return out


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in
            (line.partition(":") for line in head.decode().split("\r\n")[1:])}


_CHUNK = ("file string, record bigint, record_id string, url string, record_type string, refers_to string, "
          "payload_bytes bigint, payload_digest string, chunk bigint, chunk_bytes bigint, digest_so_far string, "
          "data binary")


def records_of(f, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk tuples (record number, id, url, type, refers to, payload bytes
    and digest as declared, chunk number, chunk bytes, digest so far)."""
    s, number = _Stream(f), 0
    while (head := s.until(b"\r\n\r\n")) is not None:
        warc = _fields(head)
        http_head = s.until(b"\r\n\r\n")
        http = _fields(http_head)
        left = int(warc["content-length"]) - len(http_head) - 4
        target = warc["warc-target-uri"]
        fixed = (number, _key(warc.get("x-row-id")), unquote(target) if "x-target-encoding" in warc else target,
                 warc["warc-type"], _key(warc.get("x-refers-to-row-id")), int(http["content-length"]),
                 warc["warc-payload-digest"].removeprefix("sha1:"))
        sha, chunk = hashlib.sha1(), 0
        if fixed[3] == "revisit":
            yield (*fixed, 0, b"", None)
        else:
            while left or not chunk:
                data = s.take(min(left, chunk_bytes))
                left -= len(data)
                sha.update(data)
                yield (*fixed, chunk, data, bare_digest(sha.digest()))
                chunk += 1
            if bare_digest(sha.digest()) != fixed[6]:
                raise ValueError(f"record {fixed[1]} fails its payload digest")
        if s.take(4) != b"\r\n\r\n":
            raise ValueError("record without its end")
        number += 1


def _read_task(root: str, chunk_bytes: int, with_data: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        schema = pa.schema([("file", pa.string()), ("record", pa.int64()), ("record_id", pa.string()),
                            ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("chunk", pa.int64()),
                            ("chunk_bytes", pa.int64()), ("digest_so_far", pa.string()), ("data", pa.binary())])

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                              schema=schema)

        for b in batches:
            for name in b.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}") as f:
                    for *fixed, chunk, data, sofar in records_of(f, chunk_bytes):
                        rows.append((name, *fixed, chunk, len(data), sofar, data if with_data else None))
                        held += len(data) if with_data else 256
                        if held >= 4 * CHUNK_BYTES:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)
    return run


def read_chunks(spark: SparkSession, manifest: DataFrame, root: str, chunk_bytes: int = CHUNK_BYTES,
                with_data: bool = True) -> DataFrame:
    """The chunk table of an archive: (file, record, record_id, url,
    record_type, refers_to, payload_bytes, payload_digest, chunk, chunk_bytes,
    digest_so_far, data). A response has at least one chunk (an empty payload
    one of 0 bytes), a revisit one without data or digest; ``with_data=False``
    leaves the payload out. Raises where a payload fails its digest."""
    n = manifest.count()
    files = manifest.select("file").repartition(max(1, min(n, 8 * spark.sparkContext.defaultParallelism)))
    return files.mapInArrow(_read_task(root, chunk_bytes, with_data), _CHUNK)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record, from its chunks: for a response the bytes and the
    last digest of its chunks, for a revisit those of the record it refers to
    as its headers state them."""
    last = F.max_by("digest_so_far", "chunk")
    got = chunks.groupBy("file", "record").agg(
        *[F.first(c).alias(c) for c in ("record_id", "url", "record_type", "refers_to")],
        F.first("payload_bytes").alias("stated_bytes"), F.first("payload_digest").alias("stated_digest"),
        F.sum("chunk_bytes").alias("read_bytes"), last.alias("read_digest"))
    revisit = F.col("record_type") == "revisit"
    return got.select("file", "record", "record_id", "url", "record_type", "refers_to",
                      F.when(revisit, F.col("stated_bytes")).otherwise(F.col("read_bytes")).alias("payload_bytes"),
                      F.when(revisit, F.col("stated_digest")).otherwise(F.col("read_digest")).alias("payload_digest"))
