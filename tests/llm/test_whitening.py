"""Whitening against whole-number sums of products."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from starmetrics.llm import whitening
from tests.conftest import SF_SMALL


def want(rows, k=32):
    """rows: (id, vector) that stay.  n, deviations, covariance by products, eigenvalues."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    z = [[n * v - t for v, t in zip(r, s)] for r in x]
    dev = [sum(v * v for v in r) for r in z]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in z), n ** 3)) for j in range(d)] for i in range(d)])
    return x, n, s, dev, cov


def check(spark, df, rows, k=32, tol=1e-8):
    got = whitening.whiten(df, components=k).collect()
    x, n, s, dev, cov = want(rows)
    d = len(s)
    k = min(k, d)
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    assert sorted(set((r["vec_id"], r["deviation"]) for r in got), key=str) == sorted(set((i, v) for (i, _), v in zip(rows, dev)), key=str)
    values = np.linalg.eigh(cov)[0][::-1]
    trace = np.trace(cov)
    for r in got:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace if trace else 0.0, rel=1e-9, abs=1e-12)
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() <= 1e-4
    model = whitening.fit(df.select(df["embedding"].cast("array<double>")))
    assert np.allclose(model.cov, cov, rtol=1e-13, atol=1e-13)
    assert model.sums == s
    # whitened: the centred row on the component, over the root of its variance
    z = np.array([[float(Fraction(n * v - t, n)) for v, t in zip(r, s)] for r in x])
    live = model.values[:k] > 0
    assert np.allclose(cov @ model.vectors[:, :k], model.vectors[:, :k] * model.values[:k], atol=1e-9 * max(trace, 1e-300))
    w = np.where(live, (z @ model.vectors[:, :k]) / np.sqrt(np.where(live, model.values[:k], 1.0)), 0.0)
    by = {}
    for (i, _), row in zip(rows, w):
        for c, v in enumerate(row, 1):
            by.setdefault((i, c), []).append(v)
    mine = {}
    for r in got:
        mine.setdefault((r["vec_id"], r["component"]), []).append(r["whitened"])
    assert by.keys() == mine.keys()
    for key in by:
        assert np.allclose(sorted(mine[key]), sorted(by[key]), atol=tol)
    return got


def test_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = check(spark, df, rows)
    assert {r["component"] for r in got} == set(range(1, 33))
    # measured whitened covariance
    w = np.zeros((len(rows), 32))
    at = {i: k for k, (i, _) in enumerate(rows)}
    for r in got:
        w[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert np.abs(np.cov(w.T, bias=True) - np.eye(32)).max() < 1e-9
    again = whitening.whiten(df.repartition(7)).collect()
    assert {(r["vec_id"], r["component"]): r["whitened"] for r in again} == {(r["vec_id"], r["component"]): r["whitened"] for r in got}


def test_odd_rows(spark):
    rng = random.Random(1)
    good = [(i, [rng.gauss(0, 1) * (j + 1) for j in range(5)]) for i in range(60)]
    good += [good[0], good[0], (None, [1.0, -2.0, 0.5, 0.25, 1 / 128])]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (104, []), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0, 0.0, 0.0]), (107, [-math.inf] * 5)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").selectExpr("*", "'x' n", "1 part", "2 key", "3 component", "4 v")
    check(spark, df.repartition(6), good)
    assert whitening.whiten(df.limit(0)).count() == 0
    only = spark.createDataFrame(bad[:4], "vec_id long, embedding array<double>")
    assert whitening.whiten(only).count() == 0
    assert whitening.whiten(only).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_no_variance(spark):
    one = [(1, [0.5, -0.25, 3.0])]
    df = spark.createDataFrame(one * 4, "vec_id long, embedding array<float>")
    got = whitening.whiten(df).collect()
    assert len(got) == 12 and {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, 0.0, 0.0, 0.0)}
    flat = [(i, [float(i), 1.0, float(2 * i)]) for i in range(10)]  # one dimension of variance out of three
    got = check(spark, spark.createDataFrame(flat, "vec_id long, embedding array<double>"), flat)
    assert {r["whitened"] for r in got if r["component"] > 1} == {0.0}


def test_large_numbers(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** e for e in (0, 12, 30, 45)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    x, n, s, dev, cov = want(rows)
    model = whitening.fit(df.select("embedding"))
    assert model.sums == s and np.allclose(model.cov, cov, rtol=1e-13)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).collect()}
    assert got == {i: v if v < 2 ** 63 else None for (i, _), v in zip(rows, dev)}


def test_exact_sums():
    rng = np.random.default_rng(3)
    for bits in (5, 20, 31, 40, 50, 56):
        a = rng.integers(-(1 << bits), 1 << bits, (200, 7))
        assert whitening.exact_sum(a) == [sum(c) for c in a.T.tolist()]
        assert whitening.exact_squares(a) == [sum(v * v for v in c) for c in a.T.tolist()]
