"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node of the graph (its id is their smallest id), so a
vector on a third of all rows is a single node. The graph starts from random
projection trees, fitted on a bounded sample: nodes are dealt to leaves, a
leaf's nodes are ordered along a random direction, and runs of ``CHUNK``
nodes are compared. Each round of NN-descent then joins every node's
neighbours (its own and up to ``K`` that have it as neighbour, chosen by
hash) with their vectors, compares neighbours of the same node with one another, and
keeps each node's ``K`` best. Vectors move by Spark joins; no task holds more
than a node's neighbourhood or a chunk, and nothing is collected but the
sample.

A query walks the graph from its own node: each hop expands the unexpanded
members of its beam, and scores only new nodes, until no query has an
unexpanded member left. Queries are taken in blocks whose vectors are sent to
the tasks (bounded by ``QUERY_BLOCK``); candidates come by joins.

Vectors travel as bytes in the width of their column: float32 for an array of
floats, float64 for anything else, so scores are those of the vectors given.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import small_batches, stored

K = 24                  # neighbours of a node in the graph
TREES = 3
LEAF = 256
CHUNK = 256             # nodes compared with one another when the graph starts
SAMPLE = 20_000         # nodes that the trees are fitted on, at most
ROUNDS = 5
BEAM = 320
QUERY_BLOCK = 16_384
SEED = 11


def _rows(raw: list[bytes], width: str) -> np.ndarray:
    """Vectors of one length from their bytes; ``width`` is "<f4" or "<f8"."""
    return np.frombuffer(b"".join(raw), width).reshape(len(raw), -1) if raw else np.zeros((0, 0), width)


def _matrix(col, width: str) -> np.ndarray:
    return _rows(col.to_pylist(), width)


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision. Rows are first scaled by a power of
    two, which is exact, so that no square over- or underflows."""
    x = x.astype(np.float64)
    if not x.size:
        return x
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pack_task(width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [np.array(v, width).tobytes() for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], ["node", "vec"])
    return run


# --- the starting graph --------------------------------------------------------------------

def fit_trees(sample: np.ndarray, rows: int, trees: int = TREES, leaf: int = LEAF, seed: int = SEED) -> list[tuple]:
    """Trees as (normals, thresholds, children): leaves are negative. Leaves
    hold about ``leaf`` of ``rows`` rows, as far as the sample can tell."""
    rng = np.random.default_rng(seed)
    least = max(2, int(leaf * len(sample) / max(rows, 1)))
    out = []
    for _ in range(trees):
        normals, cuts, children, leaves = [], [], [], 0
        todo = [(np.arange(len(sample)), None, 0)]
        while todo:
            ix, parent, side = todo.pop()
            if len(ix) > least:
                a, b = rng.choice(len(ix), 2, replace=False)
                normal = sample[ix[a]] - sample[ix[b]]
                place = sample[ix] @ normal
                cut = float(np.median(place))
                left = place < cut
                if 0 < left.sum() < len(ix):
                    me = len(normals)
                    normals.append(normal)
                    cuts.append(cut)
                    children.append([0, 0])
                    if parent is not None:
                        children[parent][side] = me
                    todo += [(ix[left], me, 0), (ix[~left], me, 1)]
                    continue
            leaves += 1
            if parent is not None:
                children[parent][side] = -leaves
        dim = max(1, sample.shape[1])
        out.append((np.array(normals, np.float32).reshape(-1, dim), np.array(cuts, np.float32),
                    np.array(children, np.int64).reshape(-1, 2)))
    return out


def route(tree: tuple, x: np.ndarray) -> np.ndarray:
    normals, cuts, children = tree
    at = np.zeros(len(x), np.int64) if len(normals) else np.full(len(x), -1)
    while (live := np.flatnonzero(at >= 0)).size:
        t = at[live]
        side = (np.einsum("ij,ij->i", x[live], normals[t]) >= cuts[t]).astype(np.int64)
        at[live] = children[t, side]
    return -at


def _deal_task(held, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(_matrix(b.column(1), width)).astype(np.float32)
            if not len(x):
                continue
            for t, tree in enumerate(held.value):
                along = x @ np.random.default_rng(SEED + 1 + t).standard_normal(x.shape[1]).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(route(tree, x)),
                     pa.array(along.astype(np.float64)), b.column(0), b.column(1)],
                    ["tree", "leaf", "along", "node", "vec"])
    return run


def _best(nodes: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    s = x @ x.T
    np.fill_diagonal(s, -2)
    k = min(k, len(nodes) - 1)
    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return np.repeat(nodes, k), nodes[top].reshape(-1), np.take_along_axis(s, top, 1).reshape(-1)


def _edges(parts) -> pa.RecordBatch:
    a, b, s = (np.concatenate(c) for c in zip(*parts))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s.astype(np.float32))], ["a", "b", "s"])


def _chunk_task(k: int, width: str):
    """Rows sorted by (tree, leaf, along): best ``k`` within runs of CHUNK."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, vecs = None, [], []

        def close():
            parts = []
            if len(nodes) > 1:
                x = _unit(_rows(vecs, width)).astype(np.float32)
                parts = [_best(np.array(nodes), x, k)]
            nodes.clear()
            vecs.clear()
            return parts

        for b in batches:
            parts = []
            for t, leaf, node, vec in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if (t, leaf) != key or len(nodes) >= CHUNK:
                    parts += close()
                    key = (t, leaf)
                nodes.append(node)
                vecs.append(vec)
            if parts:
                yield _edges(parts)
        if parts := close():
            yield _edges(parts)
    return run


def _keep_best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct neighbours of each node (ties to smaller ids)."""
    one = edges.groupBy("a", "b").agg(F.max("s").alias("s"), F.min("round").alias("round"))
    best = Window.partitionBy("a").orderBy(F.desc("s"), "b")
    return one.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r")


# --- NN-descent ------------------------------------------------------------------------------

def _meet_task(width: str):
    """Rows (v, u, fresh, tau, vec) sorted by v: compares the neighbours u of
    each v of which at least one is fresh; returns what beats a node's ``tau``,
    the score of its worst neighbour."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def meet(v, u, fresh, tau, x):
            cuts = np.append(np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1]))), len(v))
            parts = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo < 2:
                    continue
                s = x[lo:hi] @ x[lo:hi].T
                np.fill_diagonal(s, -2)
                f = fresh[lo:hi]
                i, j = np.nonzero((s > tau[lo:hi, None]) & (f[:, None] | f[None, :]))
                parts.append((u[lo:hi][i], u[lo:hi][j], s[i, j]))
            return parts

        for b in batches:
            if not b.num_rows:
                continue
            x = _unit(_matrix(b.column(4), width)).astype(np.float32)
            cols = [b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False),
                    b.column(3).to_numpy(), x]
            if held:
                cols = [np.concatenate((h, c)) for h, c in zip(held, cols)]
            last = np.searchsorted(cols[0], cols[0][-1])        # the last node may go on in the next batch
            held = [c[last:] for c in cols]
            if last and (parts := meet(*[c[:last] for c in cols])):
                yield _edges(parts)
        if held and (parts := meet(*held)):
            yield _edges(parts)
    return run


def build_graph(spark: SparkSession, nodes: DataFrame, k: int = K, rounds: int = ROUNDS,
                width: str = "<f4") -> DataFrame:
    """(a, b, s, round): neighbours ``b`` of each node ``a`` of (node, vec)."""
    n = nodes.count()
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vec").collect()
    x = _unit(_rows([r.vec for r in sample], width))
    trees = spark.sparkContext.broadcast(fit_trees(x.astype(np.float32), n))
    dealt = nodes.mapInArrow(_deal_task(trees, width), "tree int, leaf bigint, along double, node bigint, vec binary")
    start = (dealt.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "along")
             .mapInArrow(_chunk_task(k, width), "a bigint, b bigint, s float").withColumn("round", F.lit(0)))
    graph = stored(spark, _keep_best(start, k), "nn-graph")
    for turn in range(1, rounds + 1):
        tau = graph.groupBy("a").agg(F.min("s").alias("tau"))
        fresh = (F.col("round") == turn - 1).alias("fresh")
        back = (graph.withColumn("r", F.row_number().over(
            Window.partitionBy("b").orderBy(F.xxhash64("a", F.lit(turn)), "a"))).filter(F.col("r") <= k))
        near = (graph.select(F.col("a").alias("v"), F.col("b").alias("u"), fresh)
                .unionByName(back.select(F.col("b").alias("v"), F.col("a").alias("u"), fresh))
                .groupBy("v", "u").agg(F.max("fresh").alias("fresh")))
        known = nodes.join(tau, F.col("node") == F.col("a"), "left").select(
            F.col("node").alias("u"), F.coalesce("tau", F.lit(-2.0)).cast("float").alias("tau"), "vec")
        met = (near.join(known, "u").select("v", "u", "fresh", "tau", "vec")
               .repartition("v").sortWithinPartitions("v", "u").mapInArrow(_meet_task(width), "a bigint, b bigint, s float"))
        graph = stored(spark, _keep_best(graph.unionByName(met.withColumn("round", F.lit(turn))), k), "nn-graph")
    return graph


# --- search --------------------------------------------------------------------------------

def _score_task(held, width: str):
    """Rows (node, queries, vec): cosine of the node with each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, unit = held.value
        for b in batches:
            x = _unit(_matrix(b.column(2), width))
            q = b.column(1)
            size = np.diff(q.offsets.to_numpy())
            flat = q.flatten().to_numpy()
            row = np.repeat(np.arange(len(x)), size)
            at = np.searchsorted(ids, flat)
            s = np.concatenate([np.einsum("ij,ij->i", x[row[lo:lo + 65536]], unit[at[lo:lo + 65536]])
                                for lo in range(0, len(flat), 65536)]) if len(flat) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(b.column(0).to_numpy()[row]), pa.array(s)],
                                             ["q", "node", "s"])
    return run


def search(spark: SparkSession, graph: DataFrame, nodes: DataFrame, queries: DataFrame, beam: int = BEAM,
           keep: int = 8, width: str = "<f4") -> DataFrame:
    """(q, node, s): best ``keep`` nodes found for each query node (column
    ``q``), itself included, by greedy walks over ``graph`` and its reverse.
    A walk ends when its beam holds no unexpanded node: a node never comes
    back into the beam it fell out of, so every walk ends."""
    links = stored(spark, graph.select("a", "b").union(_reverse(graph)).distinct(), "nn-links")
    queries = stored(spark, queries.select("q").distinct()
                     .join(nodes, F.col("q") == F.col("node")).select("q", "vec"), "nn-queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    found = None
    for k in range(blocks):
        block = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == k)
        rows = sorted(block.collect(), key=lambda r: r.q)
        if not rows:
            continue
        unit = _unit(_rows([r.vec for r in rows], width))
        held = spark.sparkContext.broadcast((np.array([r.q for r in rows], np.int64), unit))
        best = Window.partitionBy("q").orderBy(F.desc("s"), "node")
        state = block.select("q", F.col("q").alias("node"), F.lit(2.0).alias("s"), F.lit(False).alias("done"))
        walking = True
        while walking:
            front = (state.filter("NOT done").join(links, F.col("node") == F.col("a")).select("q", F.col("b").alias("node"))
                     .distinct().join(state.select("q", "node"), ["q", "node"], "left_anti"))
            asked = front.groupBy("node").agg(F.collect_list("q").alias("queries"))
            scored = asked.join(nodes, "node").select("node", "queries", "vec").mapInArrow(
                _score_task(held, width), "q bigint, node bigint, s double")
            state = stored(spark, state.withColumn("done", F.lit(True))
                           .unionByName(scored.withColumn("done", F.lit(False)))
                           .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= beam).drop("r"), "nn-beam")
            walking = state.filter("NOT done").limit(1).count() > 0
        top = state.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= keep).select("q", "node", "s")
        found = top if found is None else found.unionByName(top)
    return found if found is not None else queries.select("q", F.col("q").alias("node"), F.lit(2.0).alias("s"))


def _reverse(graph: DataFrame, k: int = K) -> DataFrame:
    """Up to ``k`` best reverse links of each node."""
    best = Window.partitionBy("b").orderBy(F.desc("s"), "a")
    return (graph.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k)
            .select(F.col("b").alias("a"), F.col("a").alias("b")))


def nearest(spark: SparkSession, vectors: DataFrame, is_query, top: int = 5, id_col: str = "vec_id",
            vec_col: str = "embedding", beam: int = BEAM, rounds: int = ROUNDS) -> DataFrame:
    """(query_id, rank, id, score): the ``top`` nearest rows found for every
    row with ``is_query``, by cosine in double precision; ties to smaller ids.

    Rows without an id, and vectors that are null, empty, zero, or hold null
    or non-finite components, take no part. Vectors of different lengths have
    no cosine: every length is searched on its own. Equal vectors are ranked by id; a row that repeats
    another's id and vector counts once. Fewer candidates than ``top`` give
    fewer rows; no candidate gives none; further columns are ignored.
    """
    small_batches(spark, 2048)
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    valid = (vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"),
                            is_query.alias("is_query"))
             .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
             .filter(~F.exists("v", wrong) & F.exists("v", lambda x: x != 0)))
    width = "<f4" if dict(valid.dtypes)["v"] == "array<float>" else "<f8"
    lengths = sorted(r.n for r in valid.filter("is_query").select(F.size("v").alias("n")).distinct().collect())
    parts = [_nearest_of(spark, valid.filter(F.size("v") == n), top, beam, rounds, width) for n in lengths or [0]]
    return reduce(DataFrame.unionByName, parts)


def _nearest_of(spark: SparkSession, valid: DataFrame, top: int, beam: int, rounds: int, width: str) -> DataFrame:
    """``nearest`` for (id, v, is_query) with vectors of one length."""
    same = valid.groupBy("v").agg(F.min("id").alias("node"), F.count_distinct("id").alias("copies"))
    same = stored(spark, same, "nn-distinct")
    nodes = stored(spark, same.select("node", "v").mapInArrow(_pack_task(width), "node bigint, vec binary"), "nn-nodes")
    graph = build_graph(spark, nodes, rounds=rounds, width=width)
    copied = same.filter("copies > 1").withColumnRenamed("v", "w")
    smallest = Window.partitionBy("node").orderBy("id")
    shared = valid.join(copied, F.col("v") == F.col("w")).select("node", "id", "is_query").distinct()
    shared = stored(spark, shared, "nn-copies")
    few = (shared.withColumn("r", F.row_number().over(smallest)).filter(F.col("r") <= top + 1).select("node", "id"))
    members = few.union(same.filter("copies = 1").select("node", F.col("node").alias("id")))
    asked = shared.filter("is_query").select(F.col("node").alias("q"), F.col("id").alias("query_id")).union(
        valid.filter("is_query").join(copied, F.col("v") == F.col("w"), "left_anti")
        .select(F.col("id").alias("q"), F.col("id").alias("query_id")).distinct())
    asked = stored(spark, asked, "nn-asked")
    # The walk scores a query's own node as 2 (always kept); its copies' cosine is that of the vector with itself.
    found = search(spark, graph, nodes, asked, beam, keep=top + 1, width=width)
    own = nodes.select(F.col("node").alias("me"), "vec").join(asked.select("q").distinct(), F.col("me") == F.col("q"),
                                                              "left_semi").mapInArrow(_self_task(width), "me bigint, self double")
    scored = found.join(own, F.col("q") == F.col("me")).select(
        "q", "node", F.when(F.col("q") == F.col("node"), F.col("self")).otherwise(F.col("s")).alias("score"))
    ranked = (asked.join(scored, "q").join(members, "node").filter("id <> query_id")
              .withColumn("rank", F.row_number().over(
                  Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= top))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def _self_task(width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(_matrix(b.column(1), width))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array((x * x).sum(axis=1) if len(x) else np.zeros(0))], ["me", "self"])
    return run
