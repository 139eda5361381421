"""Eigenpairs and whitening against numpy."""

import math

import numpy as np
import pytest

from strata.llm import whitening
from strata.llm.eigen import leading, leading_values, sturm_counts, tridiagonal

VECS = "vec_id long, embedding array<float>, label int, n string"


@pytest.mark.parametrize("d,k", [(1, 3), (2, 2), (3, 32), (17, 5), (64, 32), (150, 32)])
@pytest.mark.parametrize("kind", ["random", "equal", "repeated", "graded", "two", "zero", "blocks"])
def test_eigenpairs(d, k, kind):
    r = np.random.default_rng(d)
    q = np.linalg.qr(r.standard_normal((d, d)))[0]
    e = {"random": r.random(d), "equal": np.ones(d), "repeated": np.round(3 * r.random(d)), "zero": np.zeros(d),
         "graded": 10.0 ** -np.arange(d), "two": 1.0 + (np.arange(d) < d // 2), "blocks": r.random(d)}[kind]
    a = np.diag(np.round(e, 1)) if kind == "blocks" else (q * e) @ q.T
    a = (a + a.T) / 2 * 1e5
    values, x = leading(a, k)
    k = min(k, d)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], rtol=0, atol=1e-9)
    assert np.abs(x.T @ x - np.eye(k)).max() < 1e-11
    assert np.abs(a @ x - x * values).max() < 1e-7


def test_sturm_counts_and_reflections():
    a = np.random.default_rng(3).standard_normal((40, 40))
    a += a.T
    diag, off, _ = tridiagonal(a)
    want = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1)), want)
    at = np.linspace(-30, 30, 200)
    assert sturm_counts(diag, off, at).tolist() == [int((want < x).sum()) for x in at]
    assert np.allclose(leading_values(diag, off, 40), want[::-1])


def brute(vectors, k=32):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return ((n * x - s) ** 2).sum(axis=1), y @ v / np.sqrt(e), e / np.trace(cov)


def test_query_equals_numpy(spark):
    import __spark_entry__
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    deviation, white, explained = brute([x.embedding for x in rows])
    got = __spark_entry__.queries()["op13_whitening"](spark, d).toPandas()
    assert len(got) == len(rows) * white.shape[1]
    assert got.n.unique().tolist() == [len(rows)] and got.identity_error.nunique() == 1
    assert got.identity_error[0] < 1e-9
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[[x.vec_id for x in rows]].to_numpy()
    sign = np.sign((table * white).sum(axis=0))
    assert np.abs(table * sign - white).max() < 1e-7
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-9)
    once = got[got.component == 1].set_index("vec_id").deviation
    assert [once[x.vec_id] for x in rows] == deviation.tolist()


def test_unusable_rows_and_edges(spark):
    r = np.random.default_rng(4)
    good = [(k, [float(c) for c in r.standard_normal(6) * [9, 9, 3, 3, 3, 1]], 0, "x") for k in range(200)]
    bad = [(300, None, 0, ""), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0, ""), (302, [float("nan")] * 6, 0, ""),
           (303, [float("inf")] + [0.0] * 5, 0, ""), (304, [], 0, ""), (305, [1.0] * 5, 0, "")]
    rows = [*good, *bad, good[0], (None, [0.5] * 6, None, None)]
    df = spark.createDataFrame(rows, VECS).repartition(4)
    model = whitening.fit(spark, df)
    assert (model.dim, model.n, len(model.values)) == (6, 202, 6) and model.identity_error < 1e-9
    white = whitening.whiten(spark, df, model)
    assert white.columns == [*df.columns, "whitened", "deviation"]
    got = white.collect()
    deviation, _, _ = brute([x[1] for x in rows if x[1] and len(x[1]) == 6 and None not in x[1] and np.isfinite(x[1]).all()])
    assert sorted(x.deviation for x in got) == sorted(deviation.tolist())
    assert sorted((x.vec_id for x in got), key=str) == sorted([*range(200), 0, None], key=str)
    w = np.array([x.whitened for x in got])
    assert np.abs(w.T @ w / len(w) - np.eye(6)).max() < 1e-9
    with pytest.raises(ValueError):
        whitening.whiten(spark, df.withColumnRenamed("n", "deviation"), model)


@pytest.mark.parametrize("rows,n", [([], 0), ([(1, [1.0, 2.0], 0, "")], 1), ([(k, [1.0, 2.0], 0, "") for k in range(5)], 5)])
def test_without_spread_there_is_no_component(spark, rows, n):
    df = spark.createDataFrame(rows, VECS)
    model = whitening.fit(spark, df)
    white = whitening.whiten(spark, df, model)
    assert white.count() == n and all(x.whitened == [] and x.deviation == 0 for x in white.collect())
    assert whitening.components(white.drop("n"), model).count() == 0


def test_long_doubles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ENTRIES", 64)
    r = np.random.default_rng(5)
    data = (r.standard_normal((300, 40)) @ r.standard_normal((40, 40)) * 1e4).tolist()
    df = spark.createDataFrame(list(enumerate(data)), "vec_id long, embedding array<double>").repartition(3)
    model = whitening.fit(spark, df, components=10)
    _, white, explained = brute(data, 10)
    got = {x.vec_id: x for x in whitening.whiten(spark, df, model).collect()}
    table = np.array([got[k].whitened for k in range(300)])
    assert np.abs(table * np.sign((table * white).sum(axis=0)) - white).max() < 1e-7
    assert np.allclose(model.explained, explained)
    x = np.floor(64 * np.array(data)).astype(np.int64).astype(object) + 1_000_000
    want = ((300 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert [got[k].deviation for k in range(300)] == [v if v < 1 << 63 else None for v in want]
