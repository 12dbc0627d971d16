"""Whitening against a dense eigendecomposition, and its edge rows."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import cabwise.llm.whitening as W
from conftest_paths import SF_SMOKE

SCHEMA = "vec_id long, embedding array<float>"


def plain_whitening(rows, wanted=4):
    """{vec_id: (n, deviation, whitened, explained)} by numpy and fractions."""
    good = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    trace = (centred**2).sum() / n
    out = []
    for i, x in good:
        own = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        out.append((i, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), own @ vectors / np.sqrt(values), values / trace))
    return out


def rows_of(df):
    got = {}
    for r in df.orderBy("vec_id", "component").collect():
        got.setdefault(r.vec_id, []).append(r)
    return got


def check(df, rows, wanted=4):
    want, got = plain_whitening(rows, wanted), rows_of(df)
    assert sorted(got, key=str) == sorted({w[0] for w in want}, key=str)
    signs = None
    for i, n, deviation, z, explained in want:
        own = got[i]
        assert [r.component for r in own] == list(range(1, len(z) + 1))
        assert all((r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-10 for r in own)
        mine = np.array([r.whitened for r in own])
        if signs is None and np.abs(z).min() > 1e-6:
            signs = np.sign(mine * z)
        if signs is not None:
            assert np.allclose(mine * signs, z, rtol=1e-8, atol=1e-9)
        assert np.allclose([r.explained for r in own], explained, rtol=1e-10)
    assert signs is not None


def test_query_against_dense_decomposition(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet").collect()]
    check(W.op11_whitening(spark, SF_SMOKE), rows)


def test_edge_rows(spark):
    rng = np.random.default_rng(5)
    body = [(i, [float(x) for x in np.float32(rng.standard_normal(6) * [9, 5, 3, 2, 1, 1])]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (103, [float("nan")] * 6),
           (104, [1.0] * 5), (105, [float("inf")] * 6), (106, [1e30] * 6)]
    copies = [(200 + i, body[0][1]) for i in range(30)]       # a hot vector counts once
    table = spark.createDataFrame(body + bad + copies, SCHEMA).withColumns({c: F.lit(c) for c in ("x", "v", "n", "component", "task")})
    check(W.whitened(table.repartition(5)), body + copies)


def test_repeated_ids_and_null_ids_are_reported_one_by_one(spark):
    rows = [(1, [0.0, 1.0]), (1, [2.0, 0.0]), (None, [3.0, 5.0]), (None, [3.0, 5.0])]
    got = W.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in got) == [(0, 1, 3), (0, 1, 3), (0, 2, 3), (0, 2, 3), (1, 1, 3), (1, 1, 3), (1, 2, 3), (1, 2, 3)]


def test_no_variance_and_no_rows(spark):
    assert W.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    assert W.whitened(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0
    assert W.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).count() == 0
    line = W.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], SCHEMA)).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12   # one direction has all the variance


def test_partial_sums_are_added_in_levels(spark, monkeypatch):
    rows = spark.range(300).select(F.col("id").alias("vec_id"), F.array(
        *[F.sin(F.col("id") * (k + 1)).cast("float") for k in range(5)]).alias("embedding"))
    monkeypatch.setattr(W, "FAN_IN", 3)
    check(W.whitened(rows.repartition(20)), [(r.vec_id, r.embedding) for r in rows.collect()])


@pytest.mark.parametrize("spectrum", [[5, 4, 3, 2] + [1] * 60, [7, 7, 7, 7, 7] + [1] * 59, [9, 8, 3 + 1e-6, 3, 3 - 1e-6] + [2.9] * 59])
def test_solver(spectrum):
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((64, 64)))[0]
    v = q @ np.diag(spectrum) @ q.T
    values, vectors = W.leading_pairs(lambda b: v @ b, 64, 4)
    assert np.allclose(values, sorted(spectrum)[::-1][:4], rtol=1e-13)
    assert np.abs(v @ vectors - values * vectors).max() < 1e-12 and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-13


def test_deviations_beyond_a_long_are_null():
    assert W.deviations(np.array([[3, 0]]), 2, [3, 1]) == [10]
    assert W.deviations(np.array([[1 << 40, 0]]), 3, [5, 1]) == [None]
    assert W.deviations(np.array([[1 << 31, 0]]), 1, [0, 1]) == [(1 << 62) + 1]
