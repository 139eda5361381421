"""Benchmark decontamination by the q-gram lemma.

Benchmark items and documents are normalised alike (lower case; runs of
characters other than letters, digits and bytes beyond ASCII become one
space). A long item is cut into overlapping windows, so a passage of an item
is found as well as a whole item: any run of ``WINDOW + STEP - 1`` normalised
bytes of an item (about 16 words) holds a whole window. Items of fewer than
``Q`` bytes match the documents that are equal to them. For a window of m characters and an
edit budget of e, a region within e edits shares at least ``m + 1 - q - q e``
of its character q-grams, all on diagonals within e of one another. Shared
q-grams are counted in overlapping diagonal bands (width 2 (e + 1), step
e + 1: any such set of diagonals lies in one band); bands that reach the
bound are kept and verified by banded alignment of the window against the
document region, all candidates of a block of text at once.

The benchmark is looked up in blocks of at most ``BLOCK_CHARS`` characters:
one pass over the documents per block, each block sent to the tasks, whose
size is thus bounded. Documents are worked through whole, in pieces that
overlap by more than the longest window; shared grams of a piece are counted
``PAIRS`` at a time, however often the texts repeat themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm.common import small_batches

Q = 12                  # characters of a gram
WINDOW = 80             # characters of a window of an item
STEP = 24
EDIT_SHARE = 0.06       # edit budget as a share of the window's characters
MIN_SHARED = 0.2        # share of a window's grams that the bound must leave
SHORTEST = 40           # items with fewer characters must match exactly
BLOCK_CHARS = 1 << 20   # of benchmark text per pass
PIECE = 1 << 20         # bytes of documents worked through at once
PAIRS = 1 << 21         # pairs of equal grams counted at once

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str | None) -> bytes:
    """Lower-cased text with runs of other characters folded to one space."""
    raw = _FOLD[np.frombuffer((text or "").lower().encode(), np.uint8)]
    if not len(raw):
        return b""
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    return raw[keep].tobytes().strip(b" ")


def budget(m: int) -> int:
    """Edits allowed in a window of m characters: the share, as far as the
    bound leaves ``MIN_SHARED`` of the window's grams; none if it is short."""
    if m < SHORTEST:
        return 0
    grams = m + 1 - Q
    return max(0, min(int(EDIT_SHARE * m), int(grams * (1 - MIN_SHARED)) // Q))


def windows(item: bytes) -> list[tuple[int, bytes]]:
    """(offset, window) of an item: the whole item, or overlapping windows
    whose last one ends with the item."""
    if len(item) <= WINDOW + STEP // 2:
        return [(0, item)] if len(item) >= Q else []
    at = list(range(0, len(item) - WINDOW, STEP)) + [len(item) - WINDOW]
    return [(a, item[a:a + WINDOW]) for a in at]


def grams(data: np.ndarray) -> np.ndarray:
    """Hash of the Q bytes at each place (Q = 12: two overlapping 8-byte words,
    exact up to 64-bit hashing; matches are verified)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    word = np.zeros(len(data) - 7, np.uint64)
    for k in range(8):
        word |= data[k:len(data) - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    return ((word[:n] * _GOLD) ^ word[Q - 8:Q - 8 + n]) * _GOLD


class Index:
    """Windows of a block of the benchmark and their sorted grams."""

    def __init__(self, items: list[tuple[object, str]]):
        self.items, self.offset, self.text = [], [], []
        self.short: dict[bytes, list] = {}
        for item, text in items:
            whole = normalise(text)
            if 0 < len(whole) < Q:
                self.short.setdefault(whole, []).append(item)
            for at, w in windows(whole):
                self.items.append(item)
                self.offset.append(at)
                self.text.append(w)
        self.length = np.array([len(w) for w in self.text], np.int64)
        self.edits = np.array([budget(len(w)) for w in self.text], np.int64)
        self.need = self.length + 1 - Q - Q * self.edits
        g = [grams(np.frombuffer(w, np.uint8)) for w in self.text]
        value = np.concatenate(g) if g else np.zeros(0, np.uint64)
        win = np.repeat(np.arange(len(g)), [len(x) for x in g])
        pos = np.concatenate([np.arange(len(x)) for x in g]) if g else np.zeros(0, np.int64)
        order = np.argsort(value, kind="stable")
        self.win, self.pos = win[order], pos[order]
        self.value, self.first, self.count = np.unique(value[order], return_index=True, return_counts=True)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.value >> np.uint64(42)).astype(np.int64)] = True

    def hits(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in data, window, place in window) of every shared gram, in
        slices of about ``PAIRS``."""
        g = grams(data)
        at = np.flatnonzero(self.bits[(g >> np.uint64(42)).astype(np.int64)])
        g = g[at]
        if not len(self.value) or not len(g):
            return
        k = np.minimum(np.searchsorted(self.value, g), len(self.value) - 1)
        ok = self.value[k] == g
        at, k = at[ok], k[ok]
        upto = np.cumsum(self.count[k])
        lo = 0
        while lo < len(k):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
            n = self.count[k[lo:hi]]
            entry = np.repeat(self.first[k[lo:hi]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            yield np.repeat(at[lo:hi], n), self.win[entry], self.pos[entry]
            lo = hi

    def bands(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, band start, shared grams) of the bands that reach the bound;
        a band covers diagonals [start, start + 2 (edits + 1))."""
        span = len(data) + 2 * (WINDOW + STEP) + 2
        keys, counts = [], []
        for at, win, pos in self.hits(data):
            low = (at - pos + WINDOW + STEP) // (self.edits[win] + 1)       # diagonals shifted to be positive
            key, n = np.unique(np.concatenate((win * span + low, win * span + low - 1)), return_counts=True)
            keys.append(key)                                # bands [low] and [low - 1] hold a gram
            counts.append(n)
        if not keys:
            return []
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        shared = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        w = key // span
        keep = shared >= self.need[w]
        w, b, shared = w[keep], (key % span)[keep], shared[keep]
        return list(zip(w.tolist(), (b * (self.edits[w] + 1) - (WINDOW + STEP)).tolist(), shared.tolist()))

    def align(self, data: np.ndarray, found: list[tuple[int, int, int]]) -> np.ndarray:
        """Least edits between each found window and any region of ``data`` on
        the band's diagonals (free ends in the document), and the region's end."""
        w = np.array([f[0] for f in found])
        start = np.array([f[1] for f in found])
        width = 2 * (int(self.edits[w].max()) + 1) + 2 * int(self.edits[w].max()) + 1
        left = start - self.edits[w]                        # alignments may leave the band by their edits
        m = self.length[w]
        rows = int(m.max())
        text = np.zeros((len(found), rows), np.int16)
        for i, k in enumerate(w):
            text[i, :m[i]] = np.frombuffer(self.text[k], np.uint8)
        col = np.arange(width)
        cost = np.zeros((len(found), width), np.int32)
        best = np.where(m == 0, 0, 1 << 20)
        end = np.zeros(len(found), np.int64)
        for i in range(rows):
            place = left[:, None] + col + i
            inside = (place >= 0) & (place < len(data))
            char = np.where(inside, data[np.clip(place, 0, len(data) - 1)], -1)
            new = cost + (char != text[:, i:i + 1])
            new = np.where(inside, new, 1 << 19)
            up = np.full_like(new, 1 << 19)
            up[:, :-1] = cost[:, 1:] + 1                    # a window character without a partner
            new = np.minimum(new, up)
            new = np.minimum.accumulate(new - col, axis=1) + col    # document characters without a partner
            cost = new
            last = m == i + 1
            if last.any():
                best[last] = cost[last].min(axis=1)
                end[last] = left[last] + cost[last].argmin(axis=1) + i + 1
        return np.column_stack((best, end))


def search(idx: Index, texts: list[str | None]) -> list[tuple]:
    """(text number, item, item start, length, edits, shared, end) of every
    verified window."""
    out: list[tuple] = []
    gap = b"\x00" * (WINDOW + STEP)                         # keeps matches from crossing documents

    def block(held: list[bytes], owner: list[tuple[int, int]]) -> None:
        data = np.frombuffer(gap.join(held), np.uint8)
        first = np.cumsum([0] + [len(h) + len(gap) for h in held[:-1]])
        found = idx.bands(data)
        for lo in range(0, len(found), 4096):
            part = found[lo:lo + 4096]
            for (w, _, shared), (edits, end) in zip(part, idx.align(data, part).tolist()):
                if edits <= idx.edits[w]:
                    k = int(np.searchsorted(first, end - 1, side="right")) - 1
                    row, shift = owner[k]
                    out.append((row, idx.items[w], idx.offset[w], int(idx.length[w]), edits, shared,
                                int(end - first[k]) + shift))

    held, owner, size = [], [], 0
    for row, text in enumerate(texts):
        raw = normalise(text)
        out += [(row, item, 0, len(raw), 0, 0, len(raw)) for item in idx.short.get(raw, ())]
        for lo in range(0, len(raw), PIECE):
            part = raw[lo:lo + PIECE + 2 * WINDOW]
            held.append(part)
            owner.append((row, lo))
            size += len(part)
            if size >= PIECE:
                block(held, owner)
                held, owner, size = [], [], 0
    if held:
        block(held, owner)
    return out


def _indexes(spark: SparkSession, benchmark: DataFrame, item_col: str, item_text: str) -> Iterator:
    """Broadcast indexes of the benchmark, each over at most about BLOCK_CHARS characters."""
    bench = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")) \
        .filter(F.col("text").isNotNull())
    blocks = max(1, -(-int(bench.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS))
    for k in range(blocks):
        part = bench if blocks == 1 else bench.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield spark.sparkContext.broadcast(Index([(r.item, r.text) for r in part.collect()]))


def flag_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", out: str = "passages") -> DataFrame:
    """``docs`` with a new column ``out``: the number of benchmark windows
    its text holds within their edit budgets. No shuffle; every row stays, also
    rows without an id and repeated ones, and null or empty texts count 0."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    small_batches(spark)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])
    flagged = docs.withColumn(out, F.lit(0).cast("bigint"))
    for index in _indexes(spark, benchmark, item_col, item_text):
        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                count = b.column(b.num_columns - 1).to_numpy().copy()
                windows_of = {(m[0], m[1], m[2]) for m in search(index.value, b.column(at).to_pylist())}
                np.add.at(count, np.array([m[0] for m in windows_of], np.int64), 1)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(count)], b.schema.names)
        flagged = flagged.mapInArrow(run, schema)
    return flagged


def _search_task(index, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = search(index.value, b.column(1).to_pylist())
            if out:
                rows = b.column(0).take(pa.array([o[0] for o in out]))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(cols[1], item_type), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                    ["id", "item_id", "item_start", "length", "edits", "shared", "doc_end"])
    return run


def find_passages(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, item_start, length, edits, shared, doc_end): a row for
    each window of a benchmark item that a document holds within the edit
    budget: best alignment; places count bytes of the normalised texts.

    Null and empty texts (of either table) match nothing; an item of fewer
    than ``Q`` normalised bytes matches the documents equal to it; rows that
    repeat an id give one result for it, a null id stays null; either table may be empty; further columns are
    ignored.
    """
    small_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    item = benchmark.schema[item_col].dataType
    schema = (f"id {src.schema['id'].dataType.simpleString()}, item_id {item.simpleString()}, item_start bigint, "
              "length bigint, edits bigint, shared bigint, doc_end bigint")
    found = None
    for index in _indexes(spark, benchmark, item_col, item_text):
        one = src.mapInArrow(_search_task(index, to_arrow_type(item)), schema)
        found = one if found is None else found.unionByName(one)
    return found.groupBy("id", "item_id", "item_start").agg(
        F.min_by(F.struct("length", "edits", "shared", "doc_end"), F.struct("edits", "doc_end")).alias("m")
    ).select("id", "item_id", "item_start", "m.length", "m.edits", "m.shared", "m.doc_end")
