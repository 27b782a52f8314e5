"""Whitening and hard negatives against plain versions, and their results on odd rows."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import negatives, whitening
from vitalgrid.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def embeddings(sf_dir):
    return pd.read_parquet(f"{sf_dir}/embeddings.parquet")


# whitening -------------------------------------------------------------------------------------------


def orthogonal(d, seed):
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]


def exact_form(q, values):
    """Q diag(values) Q' in long double, rounded once."""
    q = q.astype(np.longdouble)
    for _ in range(3):  # orthonormal beyond double precision
        q = q + q @ (np.eye(len(q)) - q.T @ q) / 2
    return (q * np.asarray(values, np.longdouble)) @ q.T, q


def test_product_is_better_than_double():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(30, 40)).astype(np.longdouble), rng.normal(size=(40, 20)).astype(np.longdouble)
    a += rng.normal(size=a.shape) * np.longdouble(2) ** -55
    assert np.abs(whitening.product(a, b) - a @ b).max() < 1e-17
    assert whitening.product(np.zeros((3, 3)), np.ones((3, 2))).tolist() == [[0, 0]] * 3


def test_refined_eigenvectors():
    values = np.linspace(1, 50, 40)
    matrix, q = exact_form(orthogonal(40, 2), values)
    e, x = whitening.eigen(matrix.astype(np.float64))
    assert np.abs(e - values[::-1]).max() < 1e-13
    turned = np.abs((q[:, ::-1].T @ x).astype(float))
    assert np.abs(turned - np.eye(40)).max() < 1e-14
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-15


@pytest.mark.parametrize("gap", [1e-5, 1e-8, 1e-10])
def test_clustered_eigenvalues(gap):
    """float32 cannot tell the clusters' values apart; the sub-solves can."""
    values = np.concatenate([3 + gap * np.arange(4), [5.0], 7 + gap * np.arange(3), np.linspace(9, 20, 8)])
    matrix, q = exact_form(orthogonal(16, 3), values)
    e, x = whitening.eigen(matrix.astype(np.float64))
    assert np.abs(e - values[::-1]).max() < 2e-14
    turned = np.abs((q[:, ::-1].T @ x).astype(float))
    assert np.abs(turned - np.eye(16)).max() < 4e-15 / gap + 1e-14
    assert np.abs(matrix @ x - x * e).max() < 1e-13 and np.abs(x.T @ x - np.eye(16)).max() < 1e-15


def test_equal_and_zero_eigenvalues():
    e, x = whitening.eigen(np.diag([2.0, 2.0, 2.0, 1.0, 0.0]))
    assert e.tolist() == [2, 2, 2, 1, 0] and np.abs(x.T @ x - np.eye(5)).max() < 1e-15
    matrix, _ = exact_form(orthogonal(6, 4), [4, 4, 4, 1, 1, 0])
    e, x = whitening.eigen(matrix.astype(np.float64))
    assert np.abs(e - [4, 4, 4, 1, 1, 0]).max() < 1e-14 and np.abs(matrix @ x - x * e).max() < 1e-14
    assert whitening.eigen(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]


def plain_whitening(vectors):
    """Rows of (id, vector): n, S and the covariance of distinct fixed-point vectors, all in integers."""
    points = {i: [math.floor(64 * float(c)) + 1_000_000 for c in v] for i, v in vectors}
    fit = sorted(set(map(tuple, points.values())))
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    centred = [[n * a - s for a, s in zip(v, total)] for v in fit]
    d = len(total)
    cov = np.array([[sum(v[i] * v[j] for v in centred) / n**3 for j in range(d)] for i in range(d)])
    return points, n, total, cov


def test_whitening(spark, sf_dir, embeddings):
    found = QUERIES["op11_refined_whitening"](spark, sf_dir).toPandas()
    points, n, total, cov = plain_whitening(list(zip(embeddings.vec_id, embeddings.embedding))[:500])
    assert len(found) == 16 * len(points) and set(found.n) == {n}
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    mean = np.array([s / n for s in total])
    wide = found.pivot(index="vec_id", columns="component", values="whitened")
    want = np.array([(np.array(points[i]) - mean) @ vectors / np.sqrt(values) for i in wide.index])
    signs = np.sign((wide.to_numpy() * want).sum(axis=0))
    assert np.abs(wide.to_numpy() * signs - want).max() < 1e-8
    deviation = found.groupby("vec_id").deviation.first()
    assert all(deviation[i] == sum((n * a - s) ** 2 for a, s in zip(x, total)) for i, x in points.items())
    explained = found.groupby("component").explained.first()
    assert np.abs(explained.to_numpy() / (values / np.trace(cov)) - 1).max() < 1e-10
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    assert np.abs(np.cov(want.T, bias=True) - np.eye(16)).max() < 1e-9


def whitened(spark, rows, schema=SCHEMA):
    used = whitening.usable(spark.createDataFrame(rows, schema))
    model = whitening.learn(used)
    return model, whitening.whiten(used, model).collect()


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), float(i % 3), 1.0], None) for i in range(20)]
    bad = [(50, None, 1), (51, [1.0, None, 2.0], 1), (52, [nan, 1.0, 2.0], 1), (53, [1.0, inf, 2.0], 1), (54, [], 1), (55, [1.0], 1)]
    model, rows = whitened(spark, good + bad + [good[0], (None, [1.0, 1.0, 1.0], 3)])
    assert model.n == 15 and len(model.values) == 2  # the third entry never varies
    assert len(rows) == 22 and sum(r.vec_id is None for r in rows) == 1
    assert model.identity_error < 1e-12
    model, rows = whitened(spark, bad[:5])
    assert model.n == 0 and rows == []
    model, rows = whitened(spark, [(1, [1.0, 2.0], 0)] * 3)
    assert model.n == 1 and [len(r.whitened) for r in rows] == [0] * 3 and rows[0].deviation == 0


def test_whitening_of_very_large_entries(spark):
    rows = [(i, [float((-1) ** i * 10.0 ** (3 * i)), float(i), 2.0], 0) for i in range(8)]
    model, out = whitened(spark, rows, "vec_id long, embedding array<double>, label int")
    points, n, total, _ = plain_whitening([(r[0], r[1]) for r in rows[:4]])
    assert model.n == 8 and any(r.deviation is None for r in out) and all(np.isfinite(r.whitened).all() for r in out)


def test_packing_is_unique():
    x = np.array([[1, -3], [200, 5], [1, -3], [1 << 40, 0], [-(1 << 62), 7], [-128, 0]])
    packed = whitening._pack(x)
    assert packed[0] == packed[2] and len(set(packed)) == 5
    import pyarrow as pa

    assert (whitening._unpack(pa.array(packed, pa.binary())) == x).all()


# hard negatives --------------------------------------------------------------------------------------


def plain_negatives(rows, is_anchor, n_pos=5, n_neg=5):
    """rows: (id, entries, label), usable ones only."""
    points = [(i, [math.floor(256 * float(c)) for c in v], l) for i, v, l in rows]
    out = []
    for k, (i, q, own) in enumerate(points):
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(q, x)), j, l) for m, (j, x, l) in enumerate(points) if m != k and len(x) == len(q)]
        scored.sort(key=lambda s: s[:2])
        for s, j, l in [s for s in scored if s[2] == own][:n_pos]:
            inside = [(t, m) for t, m, other in scored if other != own and 80 * -s <= 100 * -t <= 100 * -s]
            out += [(i, j, r + 1, m, -s, -t) for r, (t, m) in enumerate(inside[:n_neg])]
    return sorted(out)


def mined(spark, rows, anchor, schema=SCHEMA):
    return sorted(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, schema), anchor).collect())


def test_negatives(spark, sf_dir, embeddings):
    rows = [(i, v, (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in zip(embeddings.vec_id, embeddings.embedding, embeddings.label)]
    want = plain_negatives(rows, lambda i: i % 100 == 0)
    assert want and sorted(tuple(r) for r in QUERIES["op13_threshold_negatives"](spark, sf_dir).collect()) == want


@pytest.mark.parametrize("seed", range(3))
def test_negatives_with_ties_in_small_blocks(spark, monkeypatch, seed):
    """Few distinct entries give many ties; a hot label fills several blocks, anchors several units."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 20)
    monkeypatch.setattr(negatives, "UNIT_ANCHORS", 7)
    random.seed(seed)
    rows = [(i, [random.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(5)], random.choice([0, 0, 0, 1, 2])) for i in range(150)]
    assert mined(spark, rows, F.col("vec_id") % 10 == 0) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_walk_stops_before_the_end():
    """With one heavy dimension the threshold falls early, and the best are still the best."""
    rng = np.random.default_rng(0)
    x = np.column_stack([np.arange(5000), rng.integers(-3, 4, (5000, 3))]).astype(float)
    lists, q = negatives.Lists(x), np.array([9.0, -1.0, 0.0, 1.0])
    ids = rng.permutation(5000)
    met = 0

    class Counting(negatives.Lists):
        def walk(self, q):
            nonlocal met
            for rows, scores, bound in super().walk(q):
                met += len(rows)
                yield rows, scores, bound

    lists = Counting(x)
    order = np.lexsort((ids, -(x @ q)))[:5]
    assert [p for _, p in negatives.best(lists, q, ids, np.arange(5000), -1, 5)] == order.tolist()
    assert met < 1000
    found = negatives.in_windows(lists, q, ids, np.arange(5000), np.ones(5000, bool), [(40_000, 44_000), (5, 4)], 5)
    inside = [i for i in np.lexsort((ids, -(x @ q))) if 40_000 <= (x @ q)[i] <= 44_000][:5]
    assert [p for _, p in found[0]] == inside and found[1] == []


def test_negatives_odd_rows(spark):
    nan = float("nan")
    good = [(i, [float(i % 4), 1.0 - i % 3], i % 2) for i in range(12)] + [(100, [1.0], 0), (101, [2.0], 0), (102, [1.75], 1)]
    bad = [(None, [1.0, 1.0], 0), (20, None, 0), (21, [1.0, None], 0), (22, [nan, 1.0], 0), (23, [1.0, 1.0], None)]
    everyone = plain_negatives(good, lambda i: True)
    assert mined(spark, good + bad, F.lit(True)) == everyone
    docs = spark.createDataFrame(good + bad, SCHEMA).withColumns({c: F.lit(9) for c in ("row", "block", "unit", "dim", "salt", "_deal")})
    assert sorted(tuple(r) for r in negatives.mine(docs, F.lit(True)).collect()) == everyone
    assert mined(spark, [], F.lit(True)) == [] and mined(spark, bad, F.lit(True)) == []
    assert mined(spark, good, F.lit(None).cast("boolean")) == []
    zero = [(i, [0.0, 0.0], i % 2) for i in range(4)]
    assert mined(spark, zero, F.lit(True)) == plain_negatives(zero, lambda i: True)


def test_repeated_rows_are_rows(spark):
    rows = [(1, [1.0, 0.5], 0)] * 2 + [(2, [1.0, 0.25], 0), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)]
    assert mined(spark, rows, F.col("vec_id") == 1) == plain_negatives(rows, lambda i: i == 1)


def test_very_large_entries(spark):
    rows = [(i, [float(10.0 ** (i % 6 + 3)), float(i), 1.0], i // 6 % 2) for i in range(30)]
    found = mined(spark, rows, F.col("vec_id") % 5 == 0, "vec_id long, embedding array<double>, label int")
    fits = [r for r in plain_negatives(rows, lambda i: i % 5 == 0) if max(map(abs, r)) < 1 << 63]
    assert fits and set(fits) <= set(found)
