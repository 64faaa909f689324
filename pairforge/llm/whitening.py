"""Operator 11: whitening of embeddings on their leading principal components.

Every entry c becomes the whole number x = floor(64 * c) + 1000000.

1. One pass counts the vectors and sums each dimension (exact).
2. One pass gives the covariance: tasks centre x on the exact mean first, add up the
   products and emit one row per dimension; partial results are merged in two rounds
   of grouping (count, mean and centred products of parts give those of the whole).
3. The covariance (dimensions squared, whatever the number of rows) is reduced to
   tridiagonal form by Householder reflections; bisection on Sturm counts finds the
   leading eigenvalues; inverse iteration finds their vectors, those of close
   eigenvalues are made orthogonal in every step.
4. The components are broadcast (dimensions x components); tasks project the rows.

Cases: a vector that is null, empty, or holds a null, a non-finite entry or one whose x
is no long (64 * c beyond 2^62) is dropped, as is one whose length isn't the most
frequent of those left (ties: the longer).  A component without variance (an
eigenvalue of rounding size) has null ``whitened`` and doesn't count for
``identity_error``; with no component of any variance that error is null.  A deviation
beyond a long is null.  Repeated rows and repeated or null ids stay as they are; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import small_batches, stage

#: fixed values of the contract
GRID, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: entries whose 64-fold is beyond this have no x
LIMIT = float(1 << 62)
#: groups of the first merging round, per dimension
SALTS = 64
BATCH = 2_000
EPS = float(np.finfo(np.float64).eps)


class Fit(NamedTuple):
    """Exact sums of the fit list."""
    n: int
    sums: list[int]


class Whitening(NamedTuple):
    """The fitted projection: components as rows, eigenvalues falling."""
    fit: Fit
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def scale(self) -> np.ndarray:
        """1 / sqrt(e) of every component, nan without variance."""
        e = self.eigenvalues
        low = EPS * len(self.fit.sums) * (e[0] if len(e) else 0.0)
        return np.array([1 / np.sqrt(v) if v > low else np.nan for v in e])


# -- rows of a batch --------------------------------------------------------------

def usable(vectors: pa.ListArray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x of those rows) for every length that usable rows have."""
    lens = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(lens[lens > 0]):
        at = np.flatnonzero(lens == d)
        c = flat[np.repeat(lens == d, lens)].reshape(-1, d) * GRID
        ok = (np.abs(c) < LIMIT).all(axis=1)
        if ok.any():
            out.append((int(d), at[ok], np.floor(c[ok]).astype(np.int64) + SHIFT))
    return out


def centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    """n * x - S, exact (Python integers where 64 bits don't do)."""
    top = max(int(np.abs(x).max(initial=0)) * fit.n, max(map(abs, fit.sums), default=0))
    if top < 1 << 62:
        return x * fit.n - np.array(fit.sums, np.int64)
    return x.astype(object) * fit.n - np.array(fit.sums, object)


def deviations(y: np.ndarray) -> list[int | None]:
    """Sums of squares of whole numbers, exact; None beyond a long."""
    if y.dtype == object or int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] >= 1 << 63:
        sums = (y.astype(object) ** 2).sum(axis=1)
        return [int(s) if s < 1 << 63 else None for s in sums]
    return (y * y).sum(axis=1).tolist()


def offsets(y: np.ndarray, n: int) -> np.ndarray:
    """x - S/n, without rounding S/n first."""
    return (y / n).astype(np.float64)


# -- passes -----------------------------------------------------------------------

def fit_sums(df: DataFrame, vec_col: str = "embedding") -> Fit:
    """Count and exact sums of the vectors of the most frequent usable length."""
    def run(batches):
        found: dict[int, list] = {}
        for b in batches:
            for d, at, x in usable(b.column(0)):
                exact = x if int(np.abs(x).max()) * len(x) < 1 << 62 else x.astype(object)
                n, s = found.get(d, (0, 0))
                found[d] = n + len(at), exact.sum(axis=0).astype(object) + s
        for d, (n, s) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array([Decimal(v) for v in s], pa.decimal128(38, 0))], names=["len", "dim", "n", "s"])

    parts = df.select(F.col(vec_col).cast("array<double>")).mapInArrow(run, "len int, dim int, n long, s decimal(38,0)")
    # one row per length and dimension
    sums = stage(parts.groupBy("len", "dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "white-sums")
    best = sums.filter("dim = 0").orderBy(F.desc("n"), F.desc("len")).first()
    if best is None:
        return Fit(0, [])
    rows = sums.filter(F.col("len") == best.len).orderBy("dim").collect()
    return Fit(best.n, [int(r.s) for r in rows])


class Moments:
    """Count, mean and centred products of rows that come in blocks."""

    def __init__(self, d: int):
        self.n, self.mean, self.products = 0, np.zeros(d), np.zeros((d, d))

    def add(self, z: np.ndarray) -> None:
        n, mean = len(z), z.mean(axis=0)
        z = z - mean
        self.merge(n, mean, z.T @ z)

    def merge(self, n: int, mean: np.ndarray, products: np.ndarray) -> None:
        total, gap = self.n + n, mean - self.mean
        self.products += products + np.outer(gap, gap) * (self.n * n / total)
        self.mean = self.mean + gap * (n / total)
        self.n = total


def _merged(t: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and one row of products of parts that hold the same row."""
    d, i = len(t["mean"][0]), t["i"][0].as_py()
    n = t["n"].to_numpy()
    mean, row = (np.array(t[c].combine_chunks().flatten()).reshape(-1, d) for c in ("mean", "row"))
    total = n.sum()
    whole = (n[:, None] * mean).sum(axis=0) / total
    gap = mean - whole
    return total, whole, row.sum(axis=0) + ((n * gap[:, i])[:, None] * gap).sum(axis=0)


def covariance(df: DataFrame, vec_col: str, d: int, rows_of) -> np.ndarray:
    """Covariance (divisor n) of the d numbers that ``rows_of`` gives for every row of a batch."""
    from pyspark import TaskContext

    def run(batches):
        m = Moments(d)
        for b in batches:
            z = rows_of(b.column(0))
            if len(z):
                m.add(z)
        if m.n:
            salt = TaskContext.get().partitionId() % SALTS
            yield _part([salt] * d, range(d), [m.n] * d, [m.mean] * d, m.products)

    def merge(t: pa.Table) -> pa.Table:
        n, mean, row = _merged(t)
        return pa.Table.from_batches([_part([t["salt"][0].as_py()], [t["i"][0].as_py()], [n], [mean], [row])])

    schema = "salt int, i int, n long, mean array<double>, row array<double>"
    parts = df.select(F.col(vec_col).cast("array<double>")).mapInArrow(run, schema)
    once = parts.groupBy("salt", "i").applyInArrow(merge, schema)
    rows = once.groupBy("i").applyInArrow(merge, schema).orderBy("i").collect()
    if not rows:
        return np.zeros((d, d))
    out = np.array([r.row for r in rows]) / rows[0].n
    return (out + out.T) / 2


def _part(salt, i, n, mean, row) -> pa.RecordBatch:
    lists = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(salt, pa.int32()), pa.array(i, pa.int32()), pa.array(n, pa.int64()),
                                       pa.array(list(mean), lists), pa.array(list(row), lists)], names=["salt", "i", "n", "mean", "row"])


# -- leading eigenvectors of a symmetric matrix -----------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal and unit reflectors of the Householder reduction."""
    a, n = a.copy(), len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        v = x.copy()
        side = -np.copysign(np.linalg.norm(x), x[0])
        v[0] -= side
        size = np.linalg.norm(v)
        if size == 0 or not x[1:].any():
            reflectors.append(np.zeros_like(v))
            continue
        v /= size
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = side
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_counts(d: np.ndarray, e2: np.ndarray, x: np.ndarray, least: float) -> np.ndarray:
    """Number of eigenvalues below each x: negative terms of the Sturm sequence."""
    q = d[0] - x
    count = (q < 0).astype(np.int64)
    for k in range(1, len(d)):
        q = d[k] - x - e2[k - 1] / np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection."""
    n = len(d)
    side = np.abs(np.append(e, 0)) + np.abs(np.append(0, e))
    norm = max(np.abs(d).max() + side.max(), np.finfo(float).tiny)
    least = max(np.finfo(float).tiny, EPS * EPS * norm)
    lo = np.full(k, (d - side).min() - 2 * EPS * norm)
    hi = np.full(k, (d + side).max() + 2 * EPS * norm)
    rank = n - 1 - np.arange(k)
    for _ in range(200):
        mid = (lo + hi) / 2
        below = sturm_counts(d, e * e, mid, least) > rank
        hi, lo = np.where(below, mid, hi), np.where(below, lo, mid)
        if (hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)) + least).all():
            break
    return (lo + hi) / 2


class Shifted:
    """T - x, factored with row exchanges (an upper band of three), for repeated solving."""

    def __init__(self, d: np.ndarray, e: np.ndarray, x: float, least: float):
        n = len(d)
        a, b, c = (d - x).tolist(), [*e.tolist(), 0.0], [0.0] * n
        self.steps = []
        for k in range(n - 1):
            low = float(e[k])
            if abs(a[k]) >= abs(low):
                m = low / a[k] if a[k] else 0.0
                a[k + 1] -= m * b[k]
                self.steps.append((m, False))
            else:
                m = a[k] / low
                a[k], a[k + 1], b[k], c[k] = low, b[k] - m * a[k + 1], a[k + 1], b[k + 1]
                b[k + 1] *= -m
                self.steps.append((m, True))
        self.a, self.b, self.c = [v if abs(v) > least else least for v in a], b, c

    def solve(self, y: np.ndarray) -> np.ndarray:
        y, n = y.tolist(), len(y)
        for k, (m, swap) in enumerate(self.steps):
            if swap:
                y[k], y[k + 1] = y[k + 1], y[k]
            y[k + 1] -= m * y[k]
        for k in range(n - 1, -1, -1):
            s = y[k]
            if k + 1 < n:
                s -= self.b[k] * y[k + 1]
            if k + 2 < n:
                s -= self.c[k] * y[k + 2]
            y[k] = s / self.a[k]
        return np.array(y)


def vectors_of(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) by inverse iteration; close eigenvalues share a cluster."""
    n, draw = len(d), np.random.default_rng(11)
    norm = max(float((np.abs(d) + np.abs(np.append(e, 0)) + np.abs(np.append(0, e))).max()), np.finfo(float).tiny)
    out = np.zeros((len(values), n))
    start, x = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            start = k
        # equal eigenvalues are told apart, so that their systems differ
        x = min(float(value), x - 10 * EPS * norm) if k > start else float(value)
        system = Shifted(d, e, x, EPS * norm)
        v = draw.standard_normal(n)
        for _ in range(5):
            # the size may be beyond a double's square: scale first
            v = system.solve(v / np.linalg.norm(v))
            v /= np.abs(v).max()
            for _ in range(2):
                for u in out[start:k]:
                    v -= (u @ v) * u
        out[k] = v / np.linalg.norm(v)
    return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (rows) of a symmetric matrix, the k first."""
    n = len(a)
    k = min(k, n)
    if not k:
        return np.zeros(0), np.zeros((0, n))
    size = float(np.abs(a).max())
    if size == 0:
        return np.zeros(k), np.eye(n)[:k]
    d, e, reflectors = tridiagonal(a / size)
    values = leading_values(d, e, k)
    vectors = vectors_of(d, e, values)
    for j in range(len(reflectors) - 1, -1, -1):
        part = vectors[:, j + 1:]
        part -= 2 * np.outer(part @ reflectors[j], reflectors[j])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    return values * size, vectors


# -- the operator -----------------------------------------------------------------

def fit_whitening(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on all usable vectors."""
    fit = fit_sums(df, vec_col)
    d = len(fit.sums)

    def rows_of(vectors):
        return np.concatenate([offsets(centred(x, fit), fit.n) for length, _, x in usable(vectors) if length == d] or [np.zeros((0, d))])

    v = covariance(df, vec_col, d, rows_of) if d else np.zeros((0, 0))
    values, vectors = leading(v, components)
    return Whitening(fit, vectors, values, float(np.trace(v)))


def identity_error(df: DataFrame, model: Whitening, vec_col: str = "embedding") -> float | None:
    """Largest entry of (covariance of the whitened rows - identity)."""
    live = np.isfinite(model.scale)
    if not live.any():
        return None
    spark, d = df.sparkSession, len(model.fit.sums)
    shared = spark.sparkContext.broadcast((model.fit, (model.components * model.scale[:, None])[live].T))

    def rows_of(vectors):
        fit, matrix = shared.value
        return np.concatenate([offsets(centred(x, fit), fit.n) @ matrix for length, _, x in usable(vectors) if length == d]
                              or [np.zeros((0, matrix.shape[1]))])

    k = int(live.sum())
    return float(np.abs(covariance(df, vec_col, k, rows_of) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding", error: float | None = None) -> DataFrame:
    """One row per usable vector and component."""
    import pyspark.sql.pandas.types as pt
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>"))
    id_type = pt.to_arrow_type(rows.schema["vec_id"].dataType)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    explained = model.eigenvalues / model.trace if model.trace else np.zeros(len(model.eigenvalues))
    shared = df.sparkSession.sparkContext.broadcast((model.fit, model.components * model.scale[:, None], explained))

    def run(batches):
        fit, matrix, explained = shared.value
        k, d = matrix.shape
        for b in batches:
            for length, at, x in usable(b.column(1)):
                if length != d:
                    continue
                y = centred(x, fit)
                m = len(at)
                w = (offsets(y, fit.n) @ matrix.T).ravel()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(at, k))).cast(id_type), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, fit.n, np.int64)), pa.array(deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(w, mask=np.isnan(w)), pa.array(np.tile(explained, m)), pa.array([error] * (m * k), pa.float64())], names=names)

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, "
                                "whitened double, explained double, identity_error double")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark, BATCH)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(rows)
    return whiten(rows, model, error=identity_error(rows, model))
