"""Sharding over fixed virtual slots.

Every record is hashed into one of a fixed number of slots, which never
changes; bytes and rows are aggregated per slot; a versioned map says which
shard holds which slot. The first version deals the slots out evenly, the
next is edited from it: slots move, or change places, from the fullest shard
to the emptiest until their bytes are as near as whole slots allow, so every
edit moves few slots. ``grown`` edits a map for one more shard, which takes
slots from all others and gives none.

Rows are written by shard and slot, in the order of their ids, each with its
number within its cell; a cell is a slot, or for a slot of very many bytes
(one id on a great share of the rows) one of several parts of it, which are
written by tasks of their own. The index holds each cell's first number, so
that rows of a shard are numbered without a gap and without passing through
one task. Maps and index have as many rows as there are slots and parts.

Null and empty texts have the size 1; a null id hashes by its text. Repeated
rows are rows of their own. An empty table gives empty shards. Extra columns
are written along; the operator's own names must be new.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import workspace

SHARDS = 8
SLOTS = 8192
# A slot is cut into parts of this many times the mean bytes of a slot.
PART = 4
# Shards are even when the fullest and the emptiest differ by this share of the mean.
EVEN = 1e-4
OWN = ("virtual_slot", "size", "shard", "part", "number")


@dataclass
class SlotMap:
    version: int
    shards: int
    shard_of: np.ndarray        # one per slot


def dealt(slots: int, shards: int) -> SlotMap:
    """First version: slots dealt out evenly."""
    return SlotMap(1, shards, np.arange(slots) % shards)


def rebalanced(old: SlotMap, sizes: np.ndarray) -> SlotMap:
    """Next version, edited until the shards' bytes are even: a slot moves, or
    two change places, between the fullest and the emptiest shard."""
    shard_of = old.shard_of.copy()
    held = [sorted((int(sizes[s]), int(s)) for s in np.flatnonzero((shard_of == k) & (sizes > 0)))
            for k in range(old.shards)]
    loads = [sum(b for b, _ in h) for h in held]
    mean = sum(loads) / max(old.shards, 1)

    def nearest(items, want):
        at = bisect.bisect_left(items, (want, -1))
        return items[max(at - 1, 0):at + 1]

    while True:
        top, low = max(range(old.shards), key=loads.__getitem__), min(range(old.shards), key=loads.__getitem__)
        gap = loads[top] - loads[low]
        if gap <= EVEN * mean:
            break
        moves = [(abs(gap - 2 * a[0]), a, None) for a in nearest(held[top], gap // 2)]
        if not moves or min(moves)[0] > EVEN * mean:
            moves += [(abs(gap - 2 * (a[0] - b[0])), a, b) for b in held[low]
                      for a in nearest(held[top], b[0] + gap // 2) if a[0] > b[0]]
        left, a, b = min(moves, key=lambda m: (m[0], m[1]))
        if left >= gap:
            break
        for item, old_shard, new in ((a, top, low), (b, low, top)):
            if item:
                held[old_shard].remove(item)
                bisect.insort(held[new], item)
                shard_of[item[1]] = new
                loads[old_shard] -= item[0]
                loads[new] += item[0]
    return SlotMap(old.version + 1, old.shards, shard_of)


def grown(old: SlotMap, sizes: np.ndarray) -> SlotMap:
    """Next version for one more shard, which takes slots from the fullest
    shards up to its even share; no slot moves between the others."""
    new = old.shards
    shard_of = old.shard_of.copy()
    loads = np.bincount(shard_of, sizes, minlength=new).astype(float)
    held = [sorted((int(sizes[s]), int(s)) for s in np.flatnonzero(shard_of == k)) for k in range(new)]
    room = loads.sum() / (new + 1)
    while room > 0:
        top = int(loads.argmax())
        want = min(room, loads[top] - loads.sum() / (new + 1))
        at = bisect.bisect_right(held[top], (want, len(sizes)))
        if not at or held[top][at - 1][0] <= 0:
            break
        size, slot = held[top].pop(at - 1)
        shard_of[slot] = new
        loads[top] -= size
        room -= size
    return SlotMap(old.version + 1, new + 1, shard_of)


def save_map(spark: SparkSession, root: str, m: SlotMap, sizes: np.ndarray, rows: np.ndarray) -> None:
    """Adds a version to the stored maps; one that exists is an error."""
    table = spark.createDataFrame(
        [(i, int(k), int(b), int(n)) for i, (k, b, n) in enumerate(zip(m.shard_of, sizes, rows))],
        "virtual_slot int, shard int, bytes bigint, rows bigint")
    table.coalesce(1).write.parquet(f"{root}/maps/version={m.version}")


def load_map(spark: SparkSession, root: str, version: int | None = None) -> SlotMap:
    """A stored version, by default the last."""
    maps = spark.read.parquet(f"{root}/maps")
    if version is None:
        version = maps.agg(F.max("version").alias("v")).first().v
    got = maps.filter(F.col("version") == version).orderBy("virtual_slot").collect()
    shard_of = np.array([x.shard for x in got])
    return SlotMap(version, int(shard_of.max()) + 1, shard_of)


def slot_of(key: Column, text: Column, slots: int) -> Column:
    """Virtual slot by the key, or by the text where that is null."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.concat(F.lit("text:"), F.md5(text)), F.lit(""))),
                  F.lit(slots)).cast("int")


def _constant(values) -> Column:
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<int>")


def slot_sizes(rows: DataFrame, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, rows) per slot; at most ``slots`` rows come to the driver."""
    sizes, n = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for x in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        sizes[x.virtual_slot], n[x.virtual_slot] = x.b, x.n
    return sizes, n


def write_shards(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS,
                 id_col: str = "doc_id", text_col: str = "text", root: str | None = None) -> str:
    """Writes ``docs`` by shard under ``root`` (default: a new folder in the
    shared checkpoint folder) with its maps and index; returns ``root``."""
    if taken := set(OWN) & set(docs.columns):
        raise ValueError(f"columns {sorted(taken)} exist")
    root = root or workspace(spark, "shards")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn("virtual_slot", slot_of(F.col(id_col), F.col(text_col), slots)).withColumn(
        "size", (F.octet_length(text) + 1).cast("bigint"))
    sizes, n = slot_sizes(rows, slots)
    first = dealt(slots, shards)
    save_map(spark, root, first, sizes, n)
    current = rebalanced(first, sizes)
    save_map(spark, root, current, sizes, n)
    parts = np.maximum(-(-sizes // max(PART * int(sizes.sum()) // slots, 1)), 1)
    placed = rows.withColumn("shard", F.get(_constant(current.shard_of), F.col("virtual_slot")))
    # Parts by input split: even where one id holds most of a slot.
    placed = placed.withColumn("part", F.pmod(F.spark_partition_id(), F.get(_constant(parts), F.col("virtual_slot"))))
    cell = ["shard", "virtual_slot", "part"]
    number = F.row_number().over(Window.partitionBy(*cell).orderBy(F.asc_nulls_last(id_col))) - 1
    (placed.repartitionByRange(*cell).withColumn("number", number.cast("bigint"))
     .write.partitionBy("shard").parquet(f"{root}/rows"))
    counts = _rows(spark, root, docs).groupBy(*cell).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    counts.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0))).write.parquet(f"{root}/index")
    return root


def _rows(spark: SparkSession, root: str, docs: DataFrame) -> DataFrame:
    own = [T.StructField(c, T.LongType() if c in ("size", "number") else T.IntegerType()) for c in OWN]
    return spark.read.schema(T.StructType([*docs.schema.fields, *own])).parquet(f"{root}/rows")


def read_shards(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """Rows of written shards (columns of ``like``) with virtual_slot, size,
    shard and ``number``, their place in the shard from 0."""
    index = spark.read.schema("shard int, virtual_slot int, part int, rows bigint, first bigint").parquet(f"{root}/index")
    # The index has at most one row per slot and part, a number fixed by SLOTS and PART.
    starts = index.select("shard", "virtual_slot", "part", F.col("first").alias("__first"))
    back = _rows(spark, root, like).join(F.broadcast(starts), ["shard", "virtual_slot", "part"])
    return back.select(*like.columns, "virtual_slot", "size", "shard",
                       (F.col("__first") + F.col("number")).alias("number"))
