"""Whitening of embeddings by the leading eigenvectors of their covariance.

Entries become the integers x = floor(1024 c) + 100000, so counts, sums and
squared deviations are exact.  The covariance is gathered in two passes: the
sums S of every dimension, then products of x - S/n, added up in each task and
by matrix row over the tasks.  The driver holds one matrix of dimension by
dimension and solves it as follows: Householder reflections make it
tridiagonal; Sturm counts bisect for the leading eigenvalues; inverse iteration
gives their vectors, each made orthogonal to the vectors of close eigenvalues
in every step; the reflections are undone.  Mean and components go out to the
tasks, which project every row.

Edge cases: vectors that are null, empty, or hold a null or non-finite entry
take no part, nor do entries too large for a long x, nor vectors of another
length than most (ties: the longer); repeated rows and null ids each count; components whose
eigenvalue is nothing but rounding (a constant dimension, fewer rows than
dimensions) are left out, so equal vectors give no rows; an empty table gives
none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trimatch.operators.numbering import written

from .common import list_array, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0 ** 62
#: Rows of a matrix that a task multiplies at once.
BLOCK = 2048
#: Eigenvalues closer than this share of the largest are one cluster.
CLUSTER = 1e-3


# --- eigenvectors of a symmetric matrix ------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the reflections
    I - 2 v v' that lead from ``a`` to them."""
    a = a.copy()
    n, mirrors = len(a), []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        v[0] += size if v[0] >= 0 else -size
        length = np.linalg.norm(v)
        if length == 0:                                     # nothing to reflect
            mirrors.append(np.zeros(n - k - 1))
            continue
        v /= length
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = -size if a[k + 1, k] >= 0 else size
        a[k + 2:, k] = a[k, k + 2:] = 0
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def undo_reflections(z: np.ndarray, mirrors: list[np.ndarray]) -> np.ndarray:
    """Vectors (columns) of the tridiagonal matrix as vectors of the first one."""
    z = z.copy()
    for k in reversed(range(len(mirrors))):
        v = mirrors[k]
        z[k + 1:] -= 2 * np.outer(v, v @ z[k + 1:])
    return z


def count_below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: eigenvalues smaller than each of ``x``, from the signs of
    the pivots of T - x."""
    tiny = np.finfo(float).tiny ** 0.5
    q = d[0] - x
    n = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - x - e[i - 1] * (e[i - 1] / q)
        n += q < 0
    return n


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, bisected until their bounds are neighbours."""
    reach = np.abs(np.concatenate([e, [0]])) + np.abs(np.concatenate([[0], e]))
    spread = max(float((np.abs(d) + reach).max()), np.finfo(float).tiny)
    low, high = np.full(k, -spread * 1.01), np.full(k, spread * 1.01)
    least = len(d) - 1 - np.arange(k)                       # so many are smaller than the value
    for _ in range(1200):                                   # at most as many steps as a double has values to halve
        mid = low + (high - low) / 2
        if ((mid <= low) | (mid >= high) | (high - low < spread * 1e-18)).all():
            break
        below = count_below(d, e, mid) <= least
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return low + (high - low) / 2


def solve_shifted(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """x with (T - shift) x = b, by elimination with row exchanges; a vanishing
    pivot is replaced by a tiny one."""
    n = len(d)
    eps = np.finfo(float).eps * max(float(np.abs(d).max()), float(np.abs(e).max()) if n > 1 else 0.0, np.finfo(float).tiny)
    main, up, up2, rhs = (d - shift).tolist(), [*e.tolist(), 0.0], [0.0] * n, b.tolist()
    low = e.tolist()
    for i in range(n - 1):
        if abs(low[i]) > abs(main[i]):                      # rows i and i+1 change places
            main[i], low_, up[i], main[i + 1] = low[i], main[i], main[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            rhs[i], rhs[i + 1] = rhs[i + 1], rhs[i]
        else:
            low_ = low[i]
        pivot = main[i] if abs(main[i]) > eps else eps
        main[i] = pivot
        f = low_ / pivot
        main[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        rhs[i + 1] -= f * rhs[i]
    if abs(main[-1]) <= eps:
        main[-1] = eps
    x = [0.0] * (n + 2)
    for i in reversed(range(n)):
        x[i] = (rhs[i] - up[i] * x[i + 1] - up2[i] * x[i + 2]) / main[i]
    return np.array(x[:n])


def inverse_iteration(d: np.ndarray, e: np.ndarray, values: np.ndarray, steps: int = 6) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix."""
    rng = np.random.default_rng(11)
    out = np.zeros((len(d), len(values)))
    near = CLUSTER * max(float(np.abs(values).max()), np.finfo(float).tiny)
    first = 0                                               # of the cluster
    for j, value in enumerate(values):
        if j and values[j - 1] - value > near:
            first = j
        # equal values are told apart a little, or their solves would agree
        shift = value - (j - first) * 4 * np.finfo(float).eps * abs(values[0])
        x = rng.standard_normal(len(d))
        for _ in range(steps):
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x = solve_shifted(d, e, shift, x / np.linalg.norm(x))
            x /= np.abs(x).max()
        for _ in range(2):
            x -= out[:, first:j] @ (out[:, first:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_components(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v`` above rounding, falling, and
    their unit vectors as columns."""
    n = len(v)
    unit = float(np.abs(v).max()) if n else 0.0
    if unit == 0:
        return np.zeros(0), np.zeros((n, 0))
    v = v / unit
    d, e, mirrors = tridiagonal(v)
    values = leading_eigenvalues(d, e, min(k, n))
    values = values[values > n * n * np.finfo(float).eps * max(values[0], 0)]
    vectors = undo_reflections(inverse_iteration(d, e, values), mirrors)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)    # the value each vector has, to the last digit
    order = np.argsort(-values, kind="stable")
    return values[order] * unit, vectors[:, order]


# --- passes over the table -----------------------------------------------------------

def _vectors(batch: pa.RecordBatch, col: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, x) of the vectors of a batch that take part, by length."""
    vec = batch.column(col)
    vec = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    size = vec.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for length in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == length)
        flat = vec.take(pa.array(rows)).flatten().cast(pa.float64())
        c = flat.to_numpy(zero_copy_only=False).reshape(-1, length)      # a null reads as NaN
        with np.errstate(invalid="ignore", over="ignore"):
            x = np.floor(c * SCALE)
            good = (np.abs(x) < LARGEST).all(axis=1)
        if good.any():
            yield length, rows[good], x[good].astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Moments:
    """Rows, dimensions and exact sums of the fit list."""
    n: int
    sums: tuple[int, ...]

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])        # integers: correctly rounded

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, from the whole and the broken part of the mean."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - part

    def deviations(self, x: np.ndarray) -> pa.Array:
        """sum over dimensions of (n x - S)^2, exact, as decimal(38); null where
        that has more digits."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        z = x - whole
        if float(np.abs(z).max() + 1) ** 2 * self.n ** 2 * len(self.sums) < 2.0 ** 62:
            y = z * self.n - np.array([s % self.n for s in self.sums], np.int64)
            return pa.array((y * y).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
        rest = [s % self.n for s in self.sums]
        exact = (sum((a * self.n - b) ** 2 for a, b in zip(row, rest)) for row in z.tolist())
        return pa.array([Decimal(t) if t < 10 ** 38 else None for t in exact], pa.decimal128(38, 0))


def moments(vectors: DataFrame, vector_col: str = "embedding") -> Moments | None:
    """Counts and sums of the most frequent length.  Tasks send one row for
    each batch and length; sums travel in two halves, which keeps them exact."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows, x in _vectors(batch, 0):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([length], pa.int32()), pa.array([len(rows)], pa.int64()),
                     pa.array([(x >> 32).sum(axis=0).tolist()], pa.list_(pa.int64())),
                     pa.array([(x & 0xFFFFFFFF).sum(axis=0).tolist()], pa.list_(pa.int64()))], ["d", "n", "hi", "lo"])

    part = vectors.select(vector_col).mapInArrow(add, "d int, n long, hi array<long>, lo array<long>")
    sums = part.select("d", "n", F.posexplode(F.arrays_zip("hi", "lo")).alias("i", "s")).groupBy("d", "i").agg(
        F.sum("n").alias("n"), F.sum("s.hi").alias("hi"), F.sum("s.lo").alias("lo"))
    best = sums.filter("i = 0").groupBy().agg(F.max(F.struct("n", "d")).alias("b"))
    rows = sums.join(best, F.col("d") == F.col("b.d")).select("i", "n", "hi", "lo").collect()      # one row a dimension
    if not rows:
        return None
    rows.sort(key=lambda r: r["i"])
    return Moments(rows[0]["n"], tuple((r["hi"] << 32) + r["lo"] for r in rows))


def covariance(vectors: DataFrame, m: Moments, vector_col: str = "embedding") -> np.ndarray:
    """Covariance of the fit list: every task adds up the products of its
    centred rows, and the rows of these matrices are added up by number."""
    d = len(m.sums)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            for length, _, x in _vectors(batch, 0):
                if length == d:
                    for at in range(0, len(x), BLOCK):
                        c = m.centred(x[at:at + BLOCK])
                        total += c.T @ c
        if total.any():
            for at in range(0, d, 256):                     # 256 matrix rows a batch
                some = total[at:at + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(at, at + len(some)), pa.int32()), list_array(some.ravel(), np.full(len(some), d), pa.float64())], ["i", "v"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}                    # the matrix rows dealt to this task
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(-1, d)
            for i, x in zip(batch.column(0).to_pylist(), v):
                rows[i] = rows[i] + x if i in rows else x
        for i, x in rows.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), list_array(x, np.array([d]), pa.float64())], ["i", "v"])

    kind = "i int, v array<double>"
    out = np.zeros((d, d))
    for r in vectors.select(vector_col).mapInArrow(multiply, kind).repartition("i").mapInArrow(merge, kind).collect():
        out[r["i"]] = r["v"]                                # dimension x dimension
    return (out + out.T) / (2 * m.n)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of
    every row that takes part and every component; ``deviation`` is a decimal."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    shape = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    m = moments(vectors, vector_col)
    values, basis = (np.zeros(0), None) if m is None else leading_components(v := covariance(vectors, m, vector_col), components)
    if not len(values):
        return spark.createDataFrame([], shape)
    explained = (values / np.trace(v)).tolist()
    project = basis / np.sqrt(values)
    d, k = project.shape

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows, x in _vectors(batch, 1):
                if length == d:
                    w = m.centred(x) @ project
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), m.deviations(x),
                                                      list_array(w.ravel(), np.full(len(w), k), pa.float64())], ["id", "dev", "w"])

    rows = written(vectors.select(id_col, vector_col).mapInArrow(rotate, f"id {kind}, dev decimal(38,0), w array<double>"), "whitened")
    # covar_pop centres as it goes
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    got = rows.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    return rows.select("id", "dev", F.posexplode("w").alias("i", "whitened")).select(
        F.col("id").alias(id_col), (F.col("i") + 1).alias("component"), F.lit(m.n).cast("long").alias("n"), F.col("dev").alias("deviation"),
        "whitened", F.array(*map(F.lit, explained))[F.col("i")].alias("explained"), F.lit(error).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings.  A deviation beyond a long is null here; the
    operator gives it as a decimal."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
