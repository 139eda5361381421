"""Length-delimited binary records with masked checksums and an offset index.

A shard file is a run of frames::

    uint64 length | uint32 masked crc32c of those 8 bytes
    payload       | uint32 masked crc32c of the payload

all little-endian; the mask rotates right by 15 bits and adds 0xA282EAD8. A
payload is ``uint8 id width (2 or 4) | uint8 zero | uint16 key length | key
(UTF-8) | token ids``; key length 0xFFFF stands for a null key. Beside each shard lies an
index of 20-byte entries (uint64 frame offset, uint64 frame length, uint32
number of ids), from which frames are read in any order.

Tasks write whole shards under names of their own attempt; only the files
named in the manifest (a table written by Spark, which commits one attempt
per task) belong to the data set, so a retried task leaves nothing in it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import crc_u32, open_fs, small_batches, stored, workspace
from strata.llm.tokens import encoder, tokenizer_path

SHARD_BYTES = 64 << 20
READ_BYTES = 8 << 20
INDEX_ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8"), ("tokens", "<u4")])
_NULL_KEY = 0xFFFF
_CHUNK = 512


# --- crc32c, many messages at once ------------------------------------------------------

def _tables() -> np.ndarray:
    t = np.zeros((8, 256), np.uint32)
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        t[0, i] = c
    for k in range(1, 8):
        t[k] = (t[k - 1] >> np.uint32(8)) ^ t[0][t[k - 1] & np.uint32(255)]
    return t


_T = _tables()


def _bytes4(x: np.ndarray, tables: np.ndarray) -> np.ndarray:
    u = np.uint32
    return (tables[3][x & u(255)] ^ tables[2][(x >> u(8)) & u(255)]
            ^ tables[1][(x >> u(16)) & u(255)] ^ tables[0][x >> u(24)])


def _run(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    for k in range(0, words.shape[1], 2):
        state = _bytes4(state ^ words[:, k], _T[4:]) ^ _bytes4(words[:, k + 1], _T[:4])
    return state


def _shift_tables() -> np.ndarray:
    """State after _CHUNK zero bytes, for each byte of a state, top byte first."""
    out = np.zeros((4, 256), np.uint32)
    zeros = np.zeros((256, _CHUNK // 4), np.uint32)
    for k in range(4):
        out[3 - k] = _run(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), zeros)
    return out


_SHIFT = _shift_tables()


def crc32c_words(lengths: np.ndarray) -> np.ndarray:
    """crc32c of each 8-byte little-endian integer."""
    state = np.full(len(lengths), 0xFFFFFFFF, np.uint32)
    return _run(state, lengths.astype("<u8").view("<u4").reshape(-1, 2)) ^ np.uint32(0xFFFFFFFF)


def crc32c(messages: list[bytes]) -> np.ndarray:
    """crc32c of each message; messages of 4 bytes or more."""
    lengths = np.array([len(m) for m in messages], np.int64)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    chunks = -(-lengths // _CHUNK)
    pad = chunks * _CHUNK - lengths
    zeros = bytes(_CHUNK)
    parts: list[bytes] = []
    for i, n in zip(order.tolist(), pad.tolist()):      # zeros ahead of a message leave a zero state
        parts += (zeros[:n], messages[i])
    flat = np.frombuffer(bytearray(b"".join(parts)), np.uint8)
    first = np.cumsum(chunks) - chunks
    for k in range(4):                                  # initial state of all ones
        flat[first * _CHUNK + pad + k] ^= 0xFF
    words = np.ascontiguousarray(flat.view("<u4").reshape(-1, _CHUNK // 4).T)
    part = _run(np.zeros(words.shape[1], np.uint32), words.T)
    state = np.zeros(len(messages), np.uint32)
    for j in range(int(chunks.max(initial=0))):
        live = int(np.searchsorted(-chunks, -j, side="left"))
        state[:live] = _bytes4(state[:live], _SHIFT) ^ part[first[:live] + j]
    out = np.empty(len(messages), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


# --- frames --------------------------------------------------------------------------------

def frames(payloads: list[bytes]) -> tuple[bytes, np.ndarray]:
    """Framed payloads and the length of each frame."""
    lengths = np.array([len(p) for p in payloads], np.int64)
    out: list[bytes] = []
    for n, hc, p, bc in zip(lengths.tolist(), masked(crc32c_words(lengths)).tolist(), payloads,
                            masked(crc32c(payloads)).tolist()):
        out += (n.to_bytes(8, "little"), hc.to_bytes(4, "little"), p, bc.to_bytes(4, "little"))
    return b"".join(out), lengths + 16


def unframe(buf: bytes, whole: bool = True) -> tuple[list[bytes], int]:
    """Payloads of the complete frames in ``buf`` and the bytes used; raises on
    a wrong checksum, or with ``whole`` on a cut frame."""
    at, sizes, heads, found, sums = 0, [], [], [], []
    while len(buf) - at >= 16:
        n = int.from_bytes(buf[at:at + 8], "little")
        sizes.append(n)
        heads.append(int.from_bytes(buf[at + 8:at + 12], "little"))
        if len(buf) - at < 16 + n:
            break
        found.append(buf[at + 12:at + 12 + n])
        sums.append(int.from_bytes(buf[at + 12 + n:at + 16 + n], "little"))
        at += 16 + n
    if (masked(crc32c_words(np.array(sizes, np.uint64))) != np.array(heads, np.uint32)).any():
        raise ValueError("record length fails its checksum")
    if (masked(crc32c(found)) != np.array(sums, np.uint32)).any():
        raise ValueError("record payload fails its checksum")
    if whole and at != len(buf):
        raise ValueError("cut record")
    return found, at


def payload(key: str | None, ids: np.ndarray) -> bytes:
    raw = b"" if key is None else key.encode()
    size = _NULL_KEY if key is None else len(raw)
    if size >= _NULL_KEY and key is not None:
        raise ValueError("key too long")
    return bytes([ids.dtype.itemsize, 0]) + size.to_bytes(2, "little") + raw + ids.tobytes()


def parse(p: bytes) -> tuple[str | None, np.ndarray]:
    size = int.from_bytes(p[2:4], "little")
    raw = 0 if size == _NULL_KEY else size
    key = None if size == _NULL_KEY else p[4:4 + raw].decode()
    return key, np.frombuffer(p[4 + raw:], "<u2" if p[0] == 2 else "<u4")


# --- Spark jobs ------------------------------------------------------------------------------

_MANIFEST = "part int, shard int, file string, records bigint, tokens bigint, bytes bigint"


def _write_task(root: str, path: str, end_id: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder(path)
        fs, base = open_fs(root)
        shard, out, name, index, size, tokens = 0, None, None, [], 0, 0

        def close():
            out.close()
            with fs.open_output_stream(f"{base}/{name}.idx") as f:
                f.write(np.concatenate(index).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([name]),
                 pa.array([sum(len(x) for x in index)], pa.int64()), pa.array([tokens], pa.int64()),
                 pa.array([size], pa.int64())], ["part", "shard", "file", "records", "tokens", "bytes"])

        for b, encoded in enc.batches(batches, 1):
            ids = [np.append(x, enc.dtype.type(end_id)) for x in encoded]
            if not ids:
                continue
            if out is None:
                name = f"shard-{part:05d}-{shard:04d}-{uuid.uuid4().hex[:8]}.rec"
                out, index, size, tokens = fs.open_output_stream(f"{base}/{name}"), [], 0, 0
            raw, lengths = frames([payload(k, x) for k, x in zip(b.column(0).to_pylist(), ids)])
            entry = np.zeros(len(ids), INDEX_ENTRY)
            entry["length"], entry["tokens"] = lengths, [len(x) for x in ids]
            entry["offset"] = size + np.cumsum(lengths) - lengths
            out.write(raw)
            index.append(entry)
            size += len(raw)
            tokens += int(entry["tokens"].sum())
            if size >= shard_bytes:
                yield close()
                out, shard = None, shard + 1
        if out is not None:
            yield close()
    return run


def write_records(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str | None = None, end_id: int = 2, root: str | None = None,
                  shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, str]:
    """Encode and write all rows in ascending id order; returns (manifest, root).

    The manifest has one row per shard: (part, shard, file, records, tokens,
    bytes); shards in (part, shard) order hold the rows in id order. A null or
    empty text is the end id alone, null ids come first, rows with one id are
    ordered by a hash of their text; further columns are ignored; an empty
    table writes no shard.
    """
    small_batches(spark)
    root = root or workspace(spark, "records")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    rows = (src.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
            .select(F.col("id").cast("string").alias("key"), "text"))
    made = rows.mapInArrow(_write_task(root, tokenizer or tokenizer_path(), end_id, shard_bytes), _MANIFEST)
    return stored(spark, made, "records-manifest"), root


def _read_task(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        for b in batches:
            for name in b.column(0).to_pylist():
                row, start = 0, 0
                with fs.open_input_stream(f"{base}/{name}") as f:
                    buf = b""
                    while True:
                        more = f.read(READ_BYTES)
                        got, used = unframe(buf + more, whole=not more)
                        buf = (buf + more)[used:]
                        if got:
                            recs = [parse(p) for p in got]
                            size = np.array([len(x) for _, x in recs], np.int64)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([name] * len(recs)), pa.array(np.arange(row, row + len(recs))),
                                 pa.array([k for k, _ in recs], pa.string()),
                                 pa.array(start + np.cumsum(size) - size), pa.array(size),
                                 pa.array([crc_u32(x) for _, x in recs], pa.int64()),
                                 pa.array([x.astype("<u4").tobytes() for _, x in recs], pa.binary())],
                                ["file", "row", "key", "start", "n_tokens", "ids_crc32", "ids"])
                            row += len(recs)
                            start += int(size.sum())
                        if not more:
                            break
    return run


def _spread(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Shards dealt evenly to tasks, one shard to a task where there are enough."""
    n = manifest.count()
    return manifest.repartition(max(1, min(n, 8 * spark.sparkContext.defaultParallelism)))


def read_records(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32, ids, file, row): every record in
    file order positions, checksums verified; ``start`` counts the ids of all
    records before it over all shards in order."""
    first = manifest.select("file", F.coalesce(F.sum("tokens").over(
        Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rows = _spread(spark, manifest.select("file")).mapInArrow(
        _read_task(root), "file string, row bigint, key string, start bigint, n_tokens bigint, ids_crc32 bigint, "
                          "ids binary")
    return rows.join(F.broadcast(first) if manifest.count() <= 100_000 else first, "file").select(
        "key", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "ids", "file", "row")


def _index_task(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        for b in batches:
            for name in b.column(0).to_pylist():
                with fs.open_input_stream(f"{base}/{name}.idx") as f:
                    e = np.frombuffer(f.read(), INDEX_ENTRY)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(e)), pa.array(e["offset"].astype(np.int64)),
                     pa.array(e["length"].astype(np.int64))], ["file", "offset", "length"])
    return run


def _fetch_task(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        open_files: dict = {}
        for b in batches:
            got = []
            for name, offset, length in zip(*(b.column(k).to_pylist() for k in range(3))):
                if name not in open_files:
                    if len(open_files) >= 64:
                        open_files.pop(next(iter(open_files))).close()
                    open_files[name] = fs.open_input_file(f"{base}/{name}")
                f = open_files[name]
                f.seek(offset)
                got.append(parse(unframe(f.read(length))[0][0]))
            yield pa.RecordBatch.from_arrays(
                [b.column(3), pa.array([k for k, _ in got], pa.string()),
                 pa.array([x.astype("<u4").tobytes() for _, x in got], pa.binary())], ["order", "key", "ids"])
    return run


def read_shuffled(spark: SparkSession, manifest: DataFrame, root: str, seed: int = 0) -> DataFrame:
    """(order, key, ids): all records in a random order fixed by ``seed``,
    fetched by the offset index; partitions follow the order."""
    index = _spread(spark, manifest.select("file")).mapInArrow(
        _index_task(root), "file string, offset bigint, length bigint")
    dealt = index.withColumn("order", F.xxhash64(F.lit(seed), "file", "offset"))
    return (dealt.repartitionByRange("order").sortWithinPartitions("order")
            .mapInArrow(_fetch_task(root), "order bigint, key string, ids binary"))
