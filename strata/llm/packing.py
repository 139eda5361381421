"""Hierarchical multi-length packing.

Documents are routed to context-size tiers: a document of at least one long
window gives full windows and a rest, and a rest or shorter document goes to
the smallest tier that holds it. From the longest tier down, each piece opens
a window of its tier, and the gap is filled from shorter tiers, longest fit
first; only when nothing fits is a shorter piece cut. Windows are thus full
at their tier's (power-of-two) size; what is left at the end of a task is cut
to smaller tiers, and less than the smallest tier stays as one padded
sequence. Sequences are then dealt to step groups so that all groups hold
alike numbers of each tier.

A task packs its own partition in a stream with a pool of bounded size: no
shuffle, no group. Pieces are written to the shared folder before ids of
sequences and groups are given, so a lost executor cannot change them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import crc_u32, small_batches, stored
from strata.llm.tokens import encoder, tokenizer_path

TIERS = (64, 128, 256, 512, 1024)
# Tokens held by a task before it packs them.
POOL_TOKENS = 1 << 20
# Tokens of one step group.
STEP_TOKENS = 64 * 1024


class Packer:
    """Packs pieces (key, start, ids) given by ``add``; ``take`` returns the
    finished windows: lists of pieces with their tier."""

    def __init__(self, tiers=TIERS):
        self.tiers = sorted(tiers)
        self.window = self.tiers[-1]
        self.pool: list[list] = [[] for _ in range(self.window + 1)]
        self.mask = 0           # bit n: a piece of n ids is in the pool
        self.held = 0
        self.done: list[tuple[int, list]] = []

    def _put(self, piece) -> None:
        n = len(piece[2])
        self.pool[n].append(piece)
        self.mask |= 1 << n
        self.held += n

    def _pop(self, n: int):
        piece = self.pool[n].pop()
        if not self.pool[n]:
            self.mask &= ~(1 << n)
        self.held -= n
        return piece

    def _cut(self, piece, n: int):
        key, start, ids = piece
        self._put((key, start + n, ids[n:]))
        return (key, start, ids[:n])

    def add(self, key, ids: np.ndarray) -> None:
        w = self.window
        full = len(ids) // w * w
        for lo in range(0, full, w):
            self.done.append((w, [(key, lo, ids[lo:lo + w])]))
        if full < len(ids):
            self._put((key, full, ids[full:].copy()))
        if self.held > POOL_TOKENS:
            self.pack(last=False)

    def pack(self, last: bool) -> None:
        for k in range(len(self.tiers) - 1, -1, -1):
            tier, lower = self.tiers[k], self.tiers[k - 1] if k else 0
            while True:
                top = (self.mask & ((1 << (tier + 1)) - 1)).bit_length() - 1
                if top <= lower:
                    break
                if not last and self.held < tier:
                    return
                self._fill(tier, [self._pop(top)], last)

    def _fill(self, tier: int, pieces: list, last: bool) -> None:
        gap = tier - sum(len(p[2]) for p in pieces)
        while gap:
            n = (self.mask & ((1 << (gap + 1)) - 1)).bit_length() - 1
            if n > 0:
                piece = self._pop(n)
            elif self.mask:     # nothing fits: cut the shortest piece that is longer than the gap
                above = self.mask >> (gap + 1)
                piece = self._cut(self._pop(gap + (above & -above).bit_length()), gap)
            else:
                break
            pieces.append(piece)
            gap -= len(piece[2])
        if not gap:
            self.done.append((tier, pieces))
        elif not last:
            for p in pieces:
                self._put(p)
        else:
            self._finish(pieces)

    def _finish(self, pieces: list) -> None:
        """The last rest of a task: full smaller windows, then one padded."""
        left = sum(len(p[2]) for p in pieces)
        for tier in [*reversed(self.tiers), self.window]:
            while left >= tier or (left and tier == self.window and left < self.tiers[0]):
                want, window = min(tier, left), []
                while want:
                    key, start, ids = pieces.pop(0)
                    if len(ids) > want:
                        pieces.insert(0, (key, start + want, ids[want:]))
                        ids = ids[:want]
                    window.append((key, start, ids))
                    want -= len(ids)
                    left -= len(ids)
                self.done.append((tier, window))

    def take(self) -> list[tuple[int, list]]:
        out, self.done = self.done, []
        return out


def _pack_task(path: str, end_id: int, tiers, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, packer = encoder(path), Packer(tiers)
        part = TaskContext.get().partitionId()
        seq, ranks = 0, dict.fromkeys(tiers, 0)
        kind = None

        def rows():
            nonlocal seq
            cols: list[list] = [[] for _ in range(10 + with_ids)]
            for tier, pieces in packer.take():
                offset = 0
                for (doc, total), start, ids in pieces:
                    row = (doc, start, len(ids), crc_u32(ids), total, part, seq, offset, tier, ranks[tier])
                    for c, v in zip(cols, row + ((ids.astype("<u4").tobytes(),) if with_ids else ())):
                        c.append(v)
                    offset += len(ids)
                seq += 1
                ranks[tier] += 1
            if cols[0]:
                types = [kind, *[pa.int64()] * 4, pa.int32(), *[pa.int64()] * 2, pa.int32(), pa.int64(),
                         *[pa.binary()] * with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 _COLUMNS[:len(cols)])

        for b, encoded in enc.batches(batches, 1):
            kind = b.column(0).type
            for doc, ids in zip(b.column(0).to_pylist(), encoded):
                ids = np.append(ids, enc.dtype.type(end_id))
                packer.add((doc, len(ids)), ids)
            yield from rows()
        packer.pack(last=True)
        yield from rows()
    return run


_COLUMNS = ["doc", "start", "length", "ids_crc32", "doc_tokens", "part", "seq", "offset", "tier", "rank", "ids"]


def pack(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None, end_id: int = 0, tiers: tuple[int, ...] = TIERS,
         step_tokens: int = STEP_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier, step_group[, ids]).

    Every document's ids are followed by ``end_id``; a null or empty text is
    that one id. Each id lies in exactly one piece. A null id_col value and
    repeated rows are packed like any other; further columns are ignored; an
    empty table gives no pieces. ``with_ids`` adds the ids as little-endian
    unsigned 32-bit integers.
    """
    small_batches(spark)
    path = tokenizer or tokenizer_path()
    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    schema = (f"doc {src.schema['doc'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, "
              "doc_tokens bigint, part int, seq bigint, offset bigint, tier int, rank bigint"
              + ", ids binary" * with_ids)
    pieces = stored(spark, src.mapInArrow(_pack_task(path, end_id, tuple(tiers), with_ids), schema), "packed")
    # A few numbers per task: first sequence id of a task, first rank of a task within each tier.
    per = pieces.groupBy("part", "tier").agg(F.max("rank").alias("top"), F.max("seq").alias("last"),
                                             F.sum("length").alias("tokens"))
    before = Window.partitionBy("tier").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("part", "tier", F.coalesce(F.sum(F.col("top") + 1).over(before), F.lit(0)).alias("rank0"))
    task = (per.groupBy("part").agg((F.max("last") + 1).alias("n"))
            .select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
                Window.unboundedPreceding, -1)), F.lit(0)).alias("seq0")))
    total = per.agg(F.sum("tokens")).first()[0] or 0
    groups = max(1, -(-total // step_tokens))
    return (pieces.join(base, ["part", "tier"]).join(task, "part")
            .select("doc", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("seq0") + F.col("seq")).alias("sequence_id"), "offset", "tier",
                    F.pmod(F.col("rank0") + F.col("rank"), F.lit(groups)).alias("step_group"),
                    *(["ids"] if with_ids else [])))
