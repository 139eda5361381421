"""N-gram Jaccard join by PartEnum signatures.

Sets are dealt into bands of sizes [l, r] with r = floor(l / t); two sets with
Jaccard similarity of at least t lie in one band or in neighbouring ones, and
differ in at most k = floor(2 r (1 - t) / (1 + t)) features there. For each
band the feature domain (64-bit hashes) is cut into n1 ranges and every range
into n2 cells; a signature is the content of one subset of n2 - 1 cells of a
range. With n1 > k / 2 some range holds at most one differing feature, so one
of its subsets agrees: similar sets share a signature, whatever their other
content. More exactly, k differing features leave at least 2 n1 - k agreeing
signatures (the first in a range spoils all but one of its subsets, the
second the last). With s ranges more on either side, n1 = k / 2 + 1 + 2 s,
1 + 4 s agree, so each of two sets may leave out the 2 s signatures that
cover the fewest features, and one agreeing signature stays: (nearly) empty
ones, which agree by chance, are hardly written. s is chosen for each band,
up to ``light`` of the ranges.

Sets sharing a signature form a bucket. No pairs are listed within a bucket:
every member is compared with the bucket's centre (the member with most
company over all buckets), links are closed to components, and only the
centres whose members still differ in component are worked through again, in
square blocks of bounded size that return spanning links only. Before whole
sets are moved, candidates are compared by sketches a sixty-fourth of their
size: counts of features per range of the domain, whose absolute differences
add up to at most the number of differing features, so no similar pair is
dismissed. All decisions are exact, on whole sets; nothing is capped or
sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import small_batches, stored
from strata.llm.components import components
from strata.llm.words import mix, shingle_set, word_hashes

# Members of one block of a bucket group compared within a task.
BLOCK_MEMBERS = 512
# Share of the ranges that may be spare on either side.
LIGHT = 0.1


class Scheme:
    """Bands and signatures for Jaccard >= num / den."""

    def __init__(self, num: int, den: int, n2: int, light: float = LIGHT):
        self.num, self.den, self.n2, self.light = num, den, n2, light
        self.tops = [1]
        self._edges: dict[int, tuple] = {}

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append((self.tops[-1] + 1) * self.den // self.num)
        return int(np.searchsorted(self.tops, size))

    def top(self, band: int) -> int:
        while len(self.tops) <= band:
            self.tops.append((self.tops[-1] + 1) * self.den // self.num)
        return self.tops[band]

    def plan(self, band: int) -> tuple:
        if band not in self._edges:
            k = 2 * self.top(band) * (self.den - self.num) // (self.den + self.num)
            n1 = k // 2 + 1
            spare = self._spare(self.top(band - 1) + 1 if band else 1, n1)
            n1 += 2 * spare
            cells = n1 * self.n2
            edges = np.array([((i << 64) // cells) for i in range(1, cells)], np.uint64)
            self._edges[band] = (k, n1, spare, edges)
        return self._edges[band]

    def _spare(self, size: int, n1: int) -> int:
        """Ranges to spare that leave the fewest empty signatures to be
        written, by their expected number in a set of ``size`` features."""
        best, least = 0, None
        for s in range(int(self.light * n1) + 2):
            m = (n1 + 2 * s) * self.n2
            mean = m * (1 - (self.n2 - 1) / m) ** size
            x = np.arange(2 * s)
            chance = np.exp(x * np.log(mean) - mean - np.cumsum(np.log(np.maximum(x, 1)))) if mean > 0 else x == 0
            left = mean - 2 * s + float(((2 * s - x) * chance).sum())
            if least is None or left < least - 1e-3:
                best, least = s, left
        return best

    def signatures(self, features: np.ndarray) -> np.ndarray:
        """Signatures of a sorted set, for its own band and the next one."""
        out = []
        run = np.zeros(len(features) + 1, np.uint64)
        np.cumsum(mix(features ^ np.uint64(0x632BE59BD9B4E019)), out=run[1:])
        own = self.band(len(features))
        for band in (own, own + 1):
            k, n1, spare, edges = self.plan(band)
            if not k:
                continue        # only equal sets are similar, and those are one set here
            at = np.concatenate(([0], np.searchsorted(features, edges), [len(features)]))
            cell = (run[at[1:]] - run[at[:-1]]).reshape(n1, self.n2)
            held = np.diff(at).reshape(n1, self.n2)
            subset = (cell.sum(axis=1, dtype=np.uint64)[:, None] - cell).reshape(-1)
            covered = (held.sum(axis=1)[:, None] - held).reshape(-1)
            kept = np.argsort(covered, kind="stable")[2 * spare:]
            out.append(mix(mix(subset[kept] + np.uint64(band)) ^ kept.astype(np.uint64)))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _raw(col) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if v is None else v for v in col.cast(pa.binary()).to_pylist()]


def _digest(features: np.ndarray) -> tuple[int, int]:
    one = mix(np.array([mix(features ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64)
                        + np.uint64(len(features))], np.uint64))
    two = mix(features ^ np.uint64(0x9FB21C651E98DF25)).sum(dtype=np.uint64)
    return int(one[0].astype(np.int64)), int(two.astype(np.int64))


def sketch(features: np.ndarray) -> np.ndarray:
    """Features (at most 255) in each of about len / 8 equal ranges of the domain."""
    bits = max(3, (len(features) // 8).bit_length())
    return np.minimum(np.bincount((features >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits),
                      255).astype(np.uint8)


def _folded(raw: list[bytes]) -> np.ndarray:
    """Sketches as rows of one length, that of the shortest."""
    rows = [np.frombuffer(r, np.uint8) for r in raw]
    m = min(len(r) for r in rows)
    return np.stack([r.reshape(m, -1).sum(axis=1, dtype=np.int32) for r in rows])


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(w, words) for w in word_hashes(_raw(b.column(1)))]
            dig = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([d[0] for d in dig], pa.int64()), pa.array([d[1] for d in dig], pa.int64()),
                 pa.array([sketch(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                ["id", "n", "d", "d2", "sketch"])
    return run


def _sign(words: int, num: int, den: int, n2: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme, seen = Scheme(num, den, n2), set()
        for b in batches:
            sigs, owner = [], []
            for w in word_hashes(_raw(b.column(0))):
                s = shingle_set(w, words)
                d = _digest(s)[0] if len(s) else None
                if d is None or d in seen:
                    continue            # copies sign once per task
                seen.add(d)
                sigs.append(scheme.signatures(s))
                owner.append(np.full(len(sigs[-1]), d, np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(owner))], ["sig", "d"])
    return run


def _similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) * den < num * len(b):
        return False
    at = np.searchsorted(b, a)
    inter = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return den * inter >= num * (len(a) + len(b) - inter)


def _near(num: int, den: int):
    """Of pairs (centre, d, n, sketch, n, sketch) those that may be similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy() + b.column(4).to_numpy()
            apart = np.array([np.abs(np.subtract(*_folded(list(p)))).sum()
                              for p in zip(b.column(3).to_pylist(), b.column(5).to_pylist())], np.int64)
            keep = pa.array(np.flatnonzero(apart * (den + num) <= n * (den - num)))
            yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(1).take(keep)], ["centre", "d"])
    return run


def _retain(num: int, den: int):
    """Streams rows (centre, i, j, d, comp, side, n, sketch) sorted by the first
    three; returns those that may be similar to a member of another component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close():
            at = np.zeros(0, np.int64)
            if len(held) > 1:
                comp, side, n = (np.array([h[k] for h in held], np.int64) for k in (4, 5, 6))
                m = _folded([h[7] for h in held])
                may = np.zeros(len(held), bool)
                for i in range(len(held)):
                    ok = (np.abs(m - m[i]).sum(axis=1) * (den + num) <= (n + n[i]) * (den - num)) & (comp != comp[i])
                    if key[1] != key[2]:
                        ok &= side != side[i]
                    may[i] = ok.any()
                at = np.flatnonzero(may)
            cols = list(zip(*[held[i][:6] for i in at])) or [()] * 6
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              ["centre", "i", "j", "d", "comp", "side"])

        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(8))):
                if row[:3] != key:
                    if len(held) > 1:
                        yield close()
                    key, held = row[:3], []
                held.append(row)
        if len(held) > 1:
            yield close()
    return run


def _verify(num: int, den: int):
    """Streams rows (centre, blk, member, d, features) sorted by the first
    three: the centre's own row comes first in each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, of = None, None
        for b in batches:
            out = []
            for centre, member, d, raw in zip(*(b.column(k).to_pylist() for k in (0, 2, 3, 4))):
                features = np.frombuffer(raw, np.uint64)
                if not member:
                    own, of = features, centre
                elif of == centre:
                    out.append((centre, d, _similar(own, features, num, den)))
            if out:
                c, d, linked = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(d, pa.int64()),
                                                  pa.array(linked, pa.bool_())], ["centre", "d", "linked"])
    return run


def _spanning(members: list[tuple], num: int, den: int, across: bool) -> list[tuple[int, int]]:
    """Links that join different components among members (d, comp, block
    side, features); union-find keeps one link per join."""
    m = len(members)
    feats = [np.frombuffer(x[3], np.uint64) for x in members]
    size = np.array([len(f) for f in feats])
    flat, inv, count = np.unique(np.concatenate(feats), return_inverse=True, return_counts=True)
    shared = count >= 2
    col = np.cumsum(shared) - 1
    row = np.repeat(np.arange(m), size)
    keep = shared[inv]
    row, col = row[keep], col[inv][keep]
    inter = np.zeros((m, m), np.float32)
    width = max(1, (16 << 20) // m)
    for lo in range(0, int(shared.sum()), width):       # a bounded slice of the features at a time
        part = (col >= lo) & (col < lo + width)
        x = np.zeros((m, min(width, int(shared.sum()) - lo)), np.float32)
        x[row[part], col[part] - lo] = 1
        inter += x @ x.T
    comp = np.array([x[1] for x in members], np.int64)
    side = np.array([x[2] for x in members])
    ok = den * inter >= num * (size[:, None] + size[None, :] - inter)
    ok &= comp[:, None] != comp[None, :]
    if across:
        ok &= side[:, None] != side[None, :]
    root: dict[int, int] = {}

    def find(v):
        while root.get(v, v) != v:
            v = root[v]
        return v

    out = []
    for i, j in zip(*np.nonzero(np.triu(ok, 1))):
        a, b = find(int(comp[i])), find(int(comp[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((members[i][0], members[j][0]))
    return out


def _blocks(num: int, den: int):
    """Streams rows sorted by (centre, i, j); holds one square block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close():
            links = _spanning(held, num, den, key[1] != key[2]) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()),
                                               pa.array([x[1] for x in links], pa.int64())], ["a", "b"])

        for b in batches:
            c = [b.column(k).to_pylist() for k in range(7)]
            for centre, i, j, d, comp, side, feats in zip(*c):
                if (centre, i, j) != key:
                    if key is not None:
                        yield close()
                    key, held = (centre, i, j), []
                held.append((d, comp, side, feats))
        if key is not None:
            yield close()
    return run


def jaccard_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = 5, num: int = 80, den: int = 100, n2: int = 2) -> DataFrame:
    """(id, n_shingles, component): one row per row of ``docs``.

    A row's set: distinct ``words``-word shingles of its lower-cased (A-Z)
    text; a shorter text counts as one shingle. Rows link when
    ``den * |intersection| >= num * |union|``; ``component`` is the smallest
    id reachable by links. A null or empty text has no set, no links, and is
    its own component; repeated rows each get a row; a row without an id links
    with nothing and its component is null; an empty table gives an empty
    result; further columns are ignored. ``n2``: cells per range (2 or more); more
    cells make signatures more selective and more numerous.
    """
    small_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    about = stored(spark, src.mapInArrow(_describe(words), f"id {id_type}, n bigint, d bigint, d2 bigint, sketch binary"),
                   "pe-docs")
    sets = stored(spark, about.filter("n > 0 AND id IS NOT NULL").groupBy("d").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("n").alias("n"),
        F.min("sketch").alias("sketch"),
        (F.max("d2") != F.min("d2")).alias("clash")), "pe-sets")
    if sets.filter("clash").limit(1).count():
        raise ValueError("two different sets share a 64-bit digest")

    signed = src.select("text").mapInArrow(_sign(words, num, den, n2), "sig bigint, d bigint")
    ordered = (signed.repartition("sig").sortWithinPartitions("sig", "d")
               .mapInArrow(_keep_shared, "sig bigint, d bigint"))
    buckets = stored(spark, ordered, "pe-buckets")
    size = buckets.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
    company = buckets.join(size, "sig").groupBy("d").agg(F.sum(F.col("size") - 1).alias("company"))
    shared = buckets.join(company, "d")
    centres = shared.groupBy("sig").agg(F.max_by("d", F.struct("company", "d")).alias("centre"))
    star = stored(spark, buckets.select("sig", "d").join(centres, "sig").filter("d <> centre")
                  .select("centre", "d").distinct(), "pe-star")

    drawn = sets.select("d", "n", "sketch")
    of_centre = drawn.toDF("centre", "nc", "sc")
    near = stored(spark, star.join(drawn, "d").join(of_centre, "centre")
                  .select("centre", "d", "n", "sketch", "nc", "sc").mapInArrow(_near(num, den), "centre bigint, d bigint"),
                  "pe-near")

    # Where each set goes: to a block of every centre it is compared with, and to all blocks of its own group.
    group = near.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).cast("int").alias("nb"))
    block = F.struct("centre", F.pmod(F.xxhash64("d"), F.col("nb")).cast("int").alias("blk"), F.lit(True).alias("member"))
    goes = (near.join(group, "centre").groupBy("d").agg(F.collect_list(block).alias("to"))
            .join(group.withColumnRenamed("centre", "d"), "d", "full"))
    feats = _features(spark, src, sets, goes, words)
    none = F.array().cast(goes.schema["to"].dataType)
    all_blocks = F.transform(F.sequence(F.lit(0), F.col("nb") - 1),
                             lambda k: F.struct(F.col("d").alias("centre"), k.alias("blk"), F.lit(False).alias("member")))
    dealt = feats.select("d", "features", F.explode(F.concat(F.coalesce("to", none), F.coalesce(all_blocks, none)))
                         .alias("t")).select("t.centre", "t.blk", "t.member", "d", "features")
    tested = stored(spark, dealt.repartition("centre", "blk").sortWithinPartitions("centre", "blk", "member")
                    .mapInArrow(_verify(num, den), "centre bigint, d bigint, linked boolean").distinct(), "pe-tested")

    links = tested.filter("linked").select(F.col("centre").alias("a"), F.col("d").alias("b"))
    comp = components(spark, links)
    label = lambda df, key: (df.join(comp.withColumnRenamed("node", key), key, "left")
                             .withColumn("comp", F.coalesce("comp", key)))
    # Rows that repeat an id and text come twice; what is compared twice gives the same links.
    # Groups of a centre whose members are not yet of one component: compare members of different components.
    member = label(star, "d")
    group = member.groupBy("centre").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"),
                                         F.max("comp").alias("hi")).filter("size > 1 AND lo <> hi")
    open_ = (member.join(group, "centre")
             .withColumn("nb", F.ceil(F.col("size") / BLOCK_MEMBERS).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("d"), F.col("nb")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("centre", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "d", "comp",
                     F.col("own").alias("side")))
    kept = (open_.join(drawn, "d").select(*open_.columns, "n", "sketch")
            .repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j")
            .mapInArrow(_retain(num, den), "centre bigint, i int, j int, d bigint, comp bigint, side int"))
    kept = stored(spark, kept.groupBy("d").agg(F.collect_list(F.struct("centre", "i", "j", "comp", "side")).alias("to")),
                  "pe-open")
    more = _features(spark, src, sets, kept, words).select("d", "features", F.explode("to").alias("t"))
    more = (more.select("t.centre", "t.i", "t.j", "d", "t.comp", "t.side", "features")
            .repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j", "d")
            .mapInArrow(_blocks(num, den), "a bigint, b bigint"))
    more = stored(spark, more, "pe-more")
    if more.limit(1).count():
        comp = components(spark, links.union(more))
    smallest = (sets.join(comp.withColumnRenamed("node", "d"), "d")
                .groupBy("comp").agg(F.min("id").alias("component")))
    linked = comp.join(smallest, "comp").select(F.col("node").alias("d"), "component")
    of_set = (sets.filter("copies > 1").select("d", "id").join(linked, "d", "full")
              .select("d", F.coalesce("component", "id").alias("component")))
    return (about.join(of_set, "d", "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") == 0) | F.col("id").isNull(), F.col("id"))
                    .otherwise(F.coalesce("component", "id")).alias("component")))


def _keep_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (sig, d) sorted by both, the distinct ones whose signature
    occurs for more than one set. Holds one row from batch to batch."""
    held = np.zeros((0, 2), np.int64)
    linked = False          # whether the held row shares its signature with the row before it

    def emit(rows, keep):
        return pa.RecordBatch.from_arrays([pa.array(rows[keep, 0]), pa.array(rows[keep, 1])], ["sig", "d"])

    for b in batches:
        if not b.num_rows:
            continue
        rows = np.concatenate((held, np.column_stack((b.column(0).to_numpy(), b.column(1).to_numpy()))))
        rows = rows[np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))]
        same = rows[1:, 0] == rows[:-1, 0]
        keep = np.concatenate(([linked], same)) | np.append(same, False)
        held, linked = rows[-1:], bool(keep[-1])
        keep[-1] = False
        if keep.any():
            yield emit(rows, keep)
    if linked:
        yield emit(held, [True])


def _features(spark: SparkSession, src: DataFrame, sets: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``wanted`` (d, further columns) with the features of its sets, made anew
    from the texts of one row each: sets of other rows are never moved."""
    reps = stored(spark, wanted.join(sets.select("d", "id", "copies"), "d"), "pe-wanted")
    # Spark may build a Bloom filter (8 MB at most) of the few ids and skip other texts before the shuffle.
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "1g")
    extra = [c for c in wanted.columns if c != "d"]
    texts = src.join(reps.filter("copies >= 1"), "id").select("d", "text", *extra)
    schema = T.StructType([T.StructField("d", T.LongType()), T.StructField("features", T.BinaryType()),
                           *[wanted.schema[c] for c in extra]])
    return texts.mapInArrow(_sets_checked(words), schema)


def _sets_checked(words: int):
    """Rows (d, text, ...) to (d, features, ...). Rows that repeat an id may
    hold other texts: only a set of the digest asked for counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = b.column(0).to_pylist()
            sets = [shingle_set(w, words) for w in word_hashes(_raw(b.column(1)))]
            keep = [i for i, s in enumerate(sets) if len(s) and _digest(s)[0] == want[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([want[i] for i in keep], pa.int64()),
                 pa.array([sets[i].tobytes() for i in keep], pa.binary()),
                 *[c.take(pa.array(keep, pa.int64())) for c in b.columns[2:]]],
                ["d", "features", *b.schema.names[2:]])
    return run
