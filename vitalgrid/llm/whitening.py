"""Whitening by principal components: float32 eigenvectors, refined to double precision.

The covariance is counted over Spark in whole numbers: entries are fixed-point integers, centred on the
integer nearest to their mean, so that every sum is exact and the same however the rows are dealt. Its
eigenvectors come from a float32 solve and are corrected by Ogita-Aishima iterations, which need only
matrix products; products are formed beyond double precision from exact partial products. Eigenvalues
that lie too close together for the correction are solved again inside their own subspace.

Only matrices of the size of the dimension reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import in_arrow
from vitalgrid.session import stored

#: Fixed-point steps of one unit.
STEPS = 64
#: Entries beyond this many steps count as this many.
LIMIT = 1 << 62
COMPONENTS = 16
MAX_ITERATIONS = 30

_LONG = np.longdouble
_MOST = (1 << 63) - 1


# vectors ---------------------------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of rows whose vector has entries, all of them finite, and as many as most
    vectors have (of lengths equally common the smallest)."""
    bare = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = bare.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)
    lengths = whole.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    most = lengths.first()
    return whole.filter(F.size("embedding") == (most["d"] if most else 0))


def _steps(batch: pa.RecordBatch) -> np.ndarray:
    """Fixed-point entries, one row per vector."""
    column = batch.column("embedding")
    flat = np.floor(STEPS * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    return np.clip(flat, -float(LIMIT), float(LIMIT)).astype(np.int64).reshape(len(column), -1)


def _pack(x: np.ndarray) -> list[bytes]:
    """Each row as bytes of the narrowest integers that hold it; equal rows give equal bytes."""
    width = np.select([np.abs(x).max(axis=1) < 1 << b for b in (7, 15, 31)], [1, 2, 4], 8)
    out = np.empty(len(x), object)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out[at] = [bytes([w]) + row.tobytes() for row in x[at].astype(f"<i{w}")]
    return out.tolist()


def _unpack(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.stack([np.frombuffer(r, f"<i{r[0]}", offset=1).astype(np.int64) for r in rows])


def _fits(*factors: int) -> bool:
    """Whether a product of these stays exact in a double."""
    total = 1
    for f in factors:
        total *= int(f)
    return total < 1 << 53


def _decimals(values) -> pa.Array:
    return pa.array([int(v) for v in values], pa.decimal128(38, 0))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Every fixed-point vector once, packed; copies are combined in the tasks that read them."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_pack(_steps(b)), pa.binary())], names=["x"])

    return in_arrow(rows.select("embedding"), run, "x binary").dropDuplicates(["x"])


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each entry."""

    def run(batches):
        n, total = 0, 0
        for b in batches:
            if b.num_rows:
                x = _unpack(b.column(0))
                n += len(x)
                total = total + x.astype(object).sum(axis=0) if np.abs(x).max() > _MOST // len(x) else total + x.sum(axis=0).astype(object)
        if n:
            values = [n, *total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values), dtype=np.int32)), _decimals(values)], names=["k", "value"]
            )

    rows = in_arrow(fit, run, "k int, value decimal(38,0)").groupBy("k").agg(F.sum("value").alias("value")).collect()
    values = {r["k"]: int(r["value"]) for r in rows}
    return values.get(0, 0), [values[k] for k in range(1, len(values))]


def products(fit: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Exact sums of products of all entry pairs, entries less ``centre``; Python integers."""
    d = len(centre)
    above = np.triu_indices(d)

    def run(batches):
        total, any_rows = np.zeros((d, d), object), False
        for b in batches:
            if not b.num_rows:
                continue
            any_rows, z = True, _unpack(b.column(0)) - centre
            top = int(np.abs(z).max())
            if _fits(top, top, len(z)):
                z = z.astype(np.float64)
                total += (z.T @ z).astype(np.int64).astype(object)
            else:
                z = z.astype(object)
                total += z.T @ z
        if any_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(above[0]))), _decimals(total[above])], names=["k", "value"]
            )

    rows = in_arrow(fit, run, "k long, value decimal(38,0)").groupBy("k").agg(F.sum("value").alias("value")).collect()
    out = np.zeros((d, d), object)
    for r in rows:
        i, j = above[0][r["k"]], above[1][r["k"]]
        out[i, j] = out[j, i] = int(r["value"])
    return out


# eigenvectors ----------------------------------------------------------------------------------------


def _parts(a: np.ndarray, axis: int, bits: int, count: int = 4) -> list[np.ndarray]:
    """``a`` as a sum of doubles whose entries are multiples of a unit, ``bits`` bits each, with one unit
    along ``axis``: products of such parts are exact sums."""
    out, rest = [], a.astype(_LONG)
    for _ in range(count):
        top = np.abs(rest).max(axis=axis, keepdims=True)
        unit = np.ldexp(_LONG(1), np.frexp(top)[1] - bits)
        part = np.rint(rest / unit) * unit
        out.append(part.astype(np.float64))
        rest = rest - part
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product with the precision of a long double, from products of doubles."""
    if not a.size or not b.size:
        return np.zeros((len(a), b.shape[1]), _LONG)
    bits = (53 - int(a.shape[1]).bit_length()) // 2
    left, right = _parts(a, 1, bits), _parts(b, 0, bits)
    total = np.zeros((len(a), b.shape[1]), _LONG)
    for order in reversed(range(len(left))):  # small terms first
        for i in range(order + 1):
            total += left[i] @ right[order - i]
    return total


def _norm(a: np.ndarray) -> float:
    return float(np.linalg.norm(a.astype(np.float64), 2)) if a.size else 0.0


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Starts from the float32 solution. Each round corrects all vectors by X <- X + XE with
    E[i, j] = (S[i, j] + l[j] R[i, j]) / (l[j] - l[i]), where R = I - X'X and S = X'AX, or R[i, j] / 2 where
    l[i] and l[j] lie closer than the error of S. Vectors of such a cluster are turned by the
    eigenvectors of their own small matrix X'(A - mI)X, in which the cluster's differences are large.
    Exactly equal eigenvalues get some orthonormal basis of their space.
    """
    d = len(matrix)
    top = float(np.abs(matrix).max()) if d else 0.0
    if top == 0.0:
        return np.zeros(d), np.eye(d)
    scale = 2.0 ** np.frexp(top)[1]
    a = np.asarray(matrix, np.float64) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_LONG)
    values, last = np.zeros(d, _LONG), np.inf
    eps = np.finfo(np.float64).eps
    for _ in range(MAX_ITERATIONS):
        r = np.eye(d) - product(x.T, x)
        s = product(x.T, product(a, x))
        r, s = (r + r.T) / 2, (s + s.T) / 2  # an uneven error of close pairs would make them oblique
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        close = 2 * (_norm(off) + _norm(a) * _norm(r))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > max(close, eps * eps)
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + product(x, e)
        for cluster in _clusters(values, close):
            x[:, cluster] = _sub_solve(a, x[:, cluster])
        step = float(np.abs(e).max())
        if step < eps / 64 or (step < 64 * eps and step >= last / 2):
            break
        last = step
    values = np.diag(product(x.T, product(a, x))) / np.diag(product(x.T, x))
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    lead = x[np.argmax(np.abs(x), axis=0), np.arange(d)]
    x = x * np.where(lead < 0, -1, 1) / np.sqrt((x * x).sum(axis=0))
    return (values[order] * scale).astype(np.float64), x.astype(np.float64)


def _clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Groups of two or more eigenvalues, each within ``close`` of the next."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > close) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _sub_solve(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The vectors of one cluster, turned to the eigenvectors of the matrix in their space. The space is
    made orthonormal first, as the correction of close pairs does."""
    k = x.shape[1]
    for _ in range(2):
        x = x + product(x, (np.eye(k) - product(x.T, x)) / 2)
    t = product(x.T, product(a, x))
    middle = np.trace(t) / k
    t = t - middle * np.eye(k)
    top = np.abs(t).max()
    if not top > 0:
        return x
    turn = eigen_small(((t + t.T) / 2 / top).astype(np.float64))
    return product(x, turn)


def eigen_small(t: np.ndarray) -> np.ndarray:
    return np.linalg.eigh(t)[1]


# the model -------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """n vectors learned from, sums of their entries, components (columns) with their eigenvalues,
    trace of the covariance, and the largest error of the whitened covariance."""

    n: int
    total: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """Integers nearest to the mean, and n times what is left of the mean; integers."""
        centre = [(2 * s + self.n) // (2 * self.n) for s in self.total]
        return np.array(centre, np.int64), np.array([s - self.n * c for s, c in zip(self.total, centre)], object)

    def project(self, x: np.ndarray) -> np.ndarray:
        centre, left = self.parts()
        mean = np.array([float(v) / self.n for v in left])
        return ((x - centre).astype(np.float64) - mean) @ self.components / np.sqrt(self.values)


def learn(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on every distinct vector of ``rows`` (from ``usable``) once. Components whose eigenvalue is
    zero to double precision are left out: nothing can be divided by it. An empty table gives a
    model without components."""
    fit = stored(distinct_vectors(rows), "whitening-fit")
    n, total = sums(fit)
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    model = Whitening(n, total, np.zeros((0, 0)), np.zeros(0), 0.0)
    centre, left = model.parts()
    gram = products(fit, centre)
    d = len(centre)
    # n * n * covariance in whole numbers, divided once
    covariance = np.array([[(n * gram[i, j] - left[i] * left[j]) / (n * n) for j in range(d)] for i in range(d)], np.float64)
    values, vectors = eigen(covariance)
    model.trace = float(np.trace(covariance))
    some = int((values[:components] > model.trace * d * np.finfo(np.float64).eps).sum())
    model.values, model.components = values[:some], vectors[:, :some]
    model.identity_error = _identity_error(fit, model)
    return model


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of all whitened fit vectors less the identity."""
    k = len(model.values)
    if not k:
        return 0.0

    def run(batches):
        total, any_rows = np.zeros((k + 1, k + 1)), False
        for b in batches:
            if b.num_rows:
                w = np.column_stack([np.ones(b.num_rows), model.project(_unpack(b.column(0)))])
                total, any_rows = total + w.T @ w, True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["k", "value"])

    rows = in_arrow(fit, run, "k long, value double").groupBy("k").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((k + 1) * (k + 1))
    for r in rows:
        total[r["k"]] = r["value"]
    total = total.reshape(k + 1, k + 1) / model.n
    return float(np.abs(total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:]) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and whitened (one number per component) of every row of ``usable``.

    ``deviation`` is the exact sum of squares of n times a vector less the sum of all; null where it
    exceeds a long. Repeated rows and ids are kept as they are.
    """

    def run(batches):
        centre, left = model.parts() if model.n else (None, None)
        for b in batches:
            if not b.num_rows:
                continue
            x = _steps(b)
            z = x - centre
            top = model.n * int(np.abs(z).max()) + max(abs(int(v)) for v in left)
            if top * top * len(centre) <= _MOST:
                off = model.n * z - left.astype(np.int64)
                deviation = (off * off).sum(axis=1)
            else:
                off = model.n * z.astype(object) - left
                deviation = [int(v) if v <= _MOST else None for v in (off * off).sum(axis=1)]
            w = model.project(x)
            offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))],
                names=["vec_id", "deviation", "whitened"],
            )

    return in_arrow(rows, run, "vec_id long, deviation long, whitened array<double>")
