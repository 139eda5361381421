"""Embedding whitening: principal components of all vectors, scaled to unit
variance.

Entries are put on a grid of whole numbers (``floor(scale * entry) + shift``),
so that sums and deviations are exact and don't depend on how the rows are
dealt out. One pass adds up the entries, a second one the products of the
centred entries; every task sends one small matrix, which Spark adds up. Only
sums and the covariance, whose size is the vector's length squared, come to
the driver, where ``eigen.leading`` takes the components; they go to all tasks
with the projection. A third pass measures the covariance of the projected
rows.

Rows whose vector is null or holds a null or non-finite entry take no part.
Where lengths differ, the commonest one (of equally common ones the longest)
is fitted; rows of other lengths take no part. Repeated rows count each.
Components whose eigenvalue is not above ``LEAST`` of the largest are not
determined in double precision and left out: equal vectors, a single row or
no rows at all have no component. Extra columns are passed on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import ship, stored
from strata.llm.eigen import leading

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
LEAST = 1e-11
# Grid values beyond this are refused: their sums would not fit 64 bits.
LARGEST = 1 << 36
# Entries worked on at once within a task.
ENTRIES = 1 << 21


@dataclass
class Whitening:
    dim: int
    n: int
    sums: list[int]             # of the grid values, per dimension
    trace: float                # of the covariance
    values: np.ndarray          # eigenvalues, falling
    vectors: np.ndarray         # unit columns
    scale: float
    shift: int
    identity_error: float = 0.0

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist() if len(self.values) else []

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole and remaining part of the mean of the grid values."""
        whole = [round(s / self.n) for s in self.sums]
        return (np.array(whole, np.int64),
                np.array([(s - self.n * w) / self.n for s, w in zip(self.sums, whole)], float))


def _grids(col: pa.Array, scale: float, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, grid values) of the usable rows of a list column, blocks
    of rows of one length."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    flat = col.flatten()
    flat = (pc.fill_null(flat, float("nan")) if pa.types.is_floating(flat.type) else flat.cast(pa.float64()))
    flat = flat.to_numpy(zero_copy_only=False)
    start = np.concatenate(([0], np.cumsum(np.maximum(size, 0))))
    for dim in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == dim)
        for lo in range(0, len(rows), max(ENTRIES // dim, 1)):
            part = rows[lo:lo + max(ENTRIES // dim, 1)]
            x = flat[start[part][:, None] + np.arange(dim)].astype(np.float64)
            fine = np.isfinite(x).all(axis=1)
            x = np.floor(scale * x[fine])
            if len(x) and np.abs(x).max() > LARGEST - abs(shift):
                raise ValueError(f"grid values beyond {LARGEST}: use a smaller scale")
            yield part[fine], x.astype(np.int64) + shift


def _sums_task(scale: float, shift: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for rows, x in _grids(b.column(0), scale, shift):
                n, s = held.get(x.shape[1], (0, np.zeros(x.shape[1], object)))
                held[x.shape[1]] = (n + len(rows), s + x.sum(axis=0).astype(object))
        for dim, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
                 pa.array([n] * dim, pa.int64()), pa.array(s.tolist(), pa.int64())], ["dim", "i", "n", "s"])
    return run


def _centred(model: Whitening) -> Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    whole, rest = model.centre()
    dim, scale, shift = model.dim, model.scale, model.shift

    def of(col):
        for rows, x in _grids(col, scale, shift):
            if x.shape[1] == dim:
                near = x - whole
                yield rows, near, near - rest
    return of


def _products(size: int, rows_of: Callable) -> Callable:
    """Task that adds up the products of the columns of what ``rows_of``
    yields, and the columns themselves (``j`` = -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, single, n = np.zeros((size, size)), np.zeros(size), 0
        for b in batches:
            for y in rows_of(b.column(0)):
                total += y.T @ y
                single += y.sum(axis=0)
                n += len(y)
        if n:
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((i, np.arange(size))), pa.int32()),
                 pa.array(np.concatenate((j, np.full(size, -1))), pa.int32()),
                 pa.array(np.concatenate((total[i, j], single)))], ["i", "j", "v"])
    return run


def _covariance(vectors: DataFrame, size: int, n: int, rows_of: Callable) -> np.ndarray:
    parts = vectors.mapInArrow(_products(size, rows_of), "i int, j int, v double")
    got = np.zeros((size, size + 1))
    for x in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():     # size * (size + 3) / 2 numbers
        got[x.i, x.j] = x.v
    mean = got[:, size] / n
    cov = np.triu(got[:, :size]) / n
    return cov + np.triu(cov, 1).T - np.outer(mean, mean)


def fit(spark: SparkSession, df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS,
        scale: float = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Components of all usable rows of ``df``; None if there are none."""
    ship(spark)
    vectors = df.select(F.col(vec_col).alias("v"))
    sums = stored(spark, vectors.mapInArrow(_sums_task(scale, shift), "dim int, i int, n bigint, s bigint")
                  .groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")),
                  "whitening-sums")
    common = sums.filter("i = 0").orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not common:
        return None
    dim, n = common[0].dim, common[0].n
    held = {x.i: int(x.s) for x in sums.filter(F.col("dim") == dim).collect()}
    model = Whitening(dim, n, [held[i] for i in range(dim)], 0.0, np.zeros(0), np.zeros((dim, 0)), scale, shift)
    centred = _centred(model)
    cov = _covariance(vectors, dim, n, lambda col: (y for _, _, y in centred(col)))
    values, axes = leading(cov, components)
    keep = values > LEAST * max(float(values[0]) if len(values) else 0.0, 0.0)
    model.trace, model.values, model.vectors = float(np.trace(cov)), values[keep], axes[:, keep]
    k = len(model.values)
    if k:
        turn = model.vectors / np.sqrt(model.values)
        white = _covariance(vectors, k, n, lambda col: (y @ turn for _, _, y in centred(col)))
        model.identity_error = float(np.abs(white - np.eye(k)).max())
    return model


def whiten(spark: SparkSession, df: DataFrame, model: Whitening | None, vec_col: str = "embedding",
           out: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """The usable rows of ``df`` with ``out`` (projections on the components,
    unit variance, an array) and ``deviation`` (sum over dimensions of
    ``(n * x - sum)**2``, exact; null where it does not fit a long). Column
    names that ``df`` has already raise a ValueError; no model gives no rows."""
    if taken := {out, deviation} & set(df.columns):
        raise ValueError(f"columns {sorted(taken)} exist")
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType())),
                           T.StructField(deviation, T.LongType())])
    if model is None:
        return spark.createDataFrame([], schema)
    ship(spark)
    at = df.columns.index(vec_col)
    centred = _centred(model)
    whole, _ = model.centre()
    less = np.array([s - model.n * int(w) for s, w in zip(model.sums, whole)], object)
    turn = model.vectors / np.sqrt(model.values) if len(model.values) else model.vectors
    n, dim, names = model.n, model.dim, [*df.columns, out, deviation]

    def deviations(near: np.ndarray) -> pa.Array:
        if n * (int(np.abs(near).max(initial=0)) + 1) < int((2.0 ** 62 / dim) ** 0.5):
            u = n * near - less.astype(np.int64)
            return pa.array((u * u).sum(axis=1), pa.int64())
        u = n * near.astype(object) - less
        return pa.array([s if s < 1 << 63 else None for s in (u * u).sum(axis=1).tolist()], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, near, y in centred(b.column(at)):
                w = y @ turn
                ends = np.arange(0, w.size + 1, w.shape[1] or 1)
                ends = ends[:len(rows) + 1] if w.shape[1] else np.zeros(len(rows) + 1, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*b.take(pa.array(rows)).columns, lists, deviations(near)], names)

    return df.mapInArrow(run, schema)


def components(white: DataFrame, model: Whitening | None, out: str = "whitened") -> DataFrame:
    """One row per row of ``white`` and component: its columns but ``out``,
    then component (from 1), ``out`` (double), n, explained, identity_error."""
    rest = [c for c in white.columns if c != out]
    flat = white.select(*rest, F.posexplode(out).alias("__k", out))
    shares = F.array(*map(F.lit, model.explained)) if model and model.explained else F.array().cast("array<double>")
    return flat.select(*rest, (F.col("__k") + 1).cast("int").alias("component"), out,
                       F.lit(model.n if model else 0).cast("bigint").alias("n"),
                       F.get(shares, F.col("__k")).alias("explained"),
                       F.lit(model.identity_error if model else 0.0).alias("identity_error"))
