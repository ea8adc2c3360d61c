"""Whitening of embeddings by an incremental eigendecomposition.

A task keeps the count, mean and spectrum of the vectors it has seen. A batch goes in as centred rank-one updates: the rows
of its triangular factor, which have the same scatter, and the shift between the means. Each update solves the
secular equation for all eigenvalues at once, after directions that the update does not touch and equal
eigenvalues are deflated. Spectra of tasks are combined in the same way, an update for each eigenpair of the other and
one for the shift, in a tree. The basis then goes back to the vectors once: their covariance in that basis, summed over
tasks, is small, and its eigenvectors (Rayleigh-Ritz) give the components to double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 64, 1_000_000
MOST_COMPONENTS, FAN_IN, BATCH = 16, 16, 10_000
#: Components of less than this share of the largest eigenvalue are noise and can't be scaled to one.
LEAST_SHARE = 1e-10
SPECTRUM = "part long, n long, sums array<long>, mean array<double>, values array<double>, vectors array<double>"


def rank_one(values: np.ndarray, vectors: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues (ascending) and eigenvectors (columns) of vectors * diag(values) * vectors^T + step * step^T."""
    z = vectors.T @ step
    norm = float(z @ z)
    if norm == 0:
        return values, vectors
    scale = max(float(np.abs(values).max()), norm)
    tiny = 8 * np.finfo(np.float64).eps
    order = np.argsort(values, kind="stable")
    d, z, q = values[order].copy(), z[order], vectors[:, order].copy()
    last = None
    for i in range(len(d)):  # deflation: of equal eigenvalues all but one are turned out of the update's way
        if abs(z[i]) <= tiny * np.sqrt(scale):
            z[i] = 0
            continue
        if last is not None and d[i] - d[last] <= tiny * scale:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            q[:, [last, i]] = q[:, [last, i]] @ np.array([[c, s], [-s, c]])
            z[last], z[i] = 0, r
        last = i
    live = np.flatnonzero(z)
    if not len(live):
        return d, q
    a, w = d[live], z[live]
    base, tau = secular_roots(a, w * w)
    gaps = (a[:, None] - a[base][None]) - tau[None]  # a_i - mu_j, exact near the poles
    # the update that has exactly these roots, so that eigenvectors are orthogonal
    apart = a[None] - a[:, None]
    np.fill_diagonal(apart, 1.0)
    exact = np.sqrt(np.abs(np.prod(-gaps / apart, axis=1)))
    turn = np.copysign(exact, w)[:, None] / gaps
    turn /= np.linalg.norm(turn, axis=0)
    d[live] = a[base] + tau
    q[:, live] = q[:, live] @ turn
    return d, q


def secular_roots(a: np.ndarray, w2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum of w2_i / (a_i - x) = 0 for ascending a, one in each gap and one above: the nearest pole of each and
    how far from it, by bisection of all at once."""
    m = len(a)
    width = np.append(np.diff(a), w2.sum())
    left = np.arange(m)
    middle = 1 + (w2[None] / ((a[None] - a[left][:, None]) - width[:, None] / 2)).sum(axis=1)
    base = np.where((middle < 0) & (left < m - 1), left + 1, left)  # the function rises from minus to plus infinity in a gap
    low = np.where(base > left, -width / 2, 0.0)
    high = np.where(base > left, 0.0, np.where(left < m - 1, width / 2, width))
    away = a[None] - a[base][:, None]
    pole = away == 0
    for _ in range(70):
        x = (low + high) / 2
        f = 1 + (w2[None] / np.where(pole, -x[:, None], away - x[:, None])).sum(axis=1)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
    x = (low + high) / 2
    return base, np.where(x == 0, np.where(base > left, -1, 1) * np.finfo(np.float64).tiny, x)


@dataclass
class Spectrum:
    """Count, exact sums, mean and scatter (as eigenvalues and eigenvectors) of a set of vectors."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d, np.int64), np.zeros(d), np.zeros(d), np.eye(d))

    def shifted(self, n: int, sums: np.ndarray, mean: np.ndarray, rows: np.ndarray) -> None:
        """Takes in ``n`` more vectors: ``rows`` have their scatter around their own ``mean``."""
        both = self.n + n
        apart = mean - self.mean
        steps = list(rows)
        if self.n:
            steps.append(apart * np.sqrt(self.n * n / both))
        for step in steps:
            self.values, self.vectors = rank_one(self.values, self.vectors, step)
        self.mean = self.mean + apart * (n / both)
        self.n, self.sums = both, self.sums + sums

    def add(self, x: np.ndarray) -> None:
        """Takes in a batch of integer vectors."""
        shift = x.mean(axis=0)
        centred = x - shift
        rows = np.linalg.qr(centred, mode="r") if len(x) > 1 else np.empty((0, x.shape[1]))
        self.shifted(len(x), x.sum(axis=0), shift, rows)

    def merge(self, other: Spectrum) -> None:
        self.shifted(other.n, other.sums, other.mean, np.sqrt(np.maximum(other.values, 0))[:, None] * other.vectors.T)

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": self.sums.tolist(), "mean": self.mean.tolist(), "values": self.values.tolist(), "vectors": self.vectors.ravel().tolist()}

    @classmethod
    def of(cls, row) -> Spectrum:  # noqa: ANN001 - a row of Spark or pandas
        mean = np.array(row["mean"], np.float64)
        return cls(int(row["n"]), np.array(row["sums"], np.int64), mean, np.array(row["values"]), np.array(row["vectors"]).reshape(len(mean), -1))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def fixed_points(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector is finite, each entry c as floor(64 * c) + 1000000."""
    whole = F.col("embedding").isNotNull() & F.expr("forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))")
    return vectors.where(whole).select("vec_id", F.expr(f"transform(embedding, c -> CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) + {SHIFT}L)").alias("x"))


def spectra(fit: DataFrame, d: int) -> DataFrame:
    """The spectrum of each task's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        own = Spectrum.empty(d)
        for b in batches:
            x = matrix(b.column("x"), d)
            for i in range(0, len(x), BATCH):
                own.add(x[i : i + BATCH])
        if own.n:
            yield pa.RecordBatch.from_pandas(pd.DataFrame([own.row(TaskContext.get().partitionId())]), preserve_index=False)

    return fit.mapInArrow(run, SPECTRUM)


def combined(parts: DataFrame, fan_in: int = FAN_IN) -> Spectrum:
    """The spectrum of all: groups of ``fan_in`` are merged at a time, and the last one comes to the driver (d^2 numbers)."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        every = [Spectrum.of(r) for r in rows.sort_values("part").to_dict("records")]
        for other in every[1:]:
            every[0].merge(other)
        return pd.DataFrame([every[0].row(int(rows.part.min()) // fan_in)])

    held = stored(parts, "spectra")
    last = held.agg(F.max("part")).first()[0]
    while last:
        held = stored(held.groupBy(F.expr(f"part div {fan_in}").alias("to")).applyInPandas(merge, SPECTRUM), "spectra")
        last //= fan_in
    return Spectrum.of(held.first())


def projected_moment(fit: DataFrame, basis: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The covariance of the vectors in ``basis`` (columns): products are summed within tasks and then over them, entry by entry."""
    k, mean = basis.shape[1], sums / n
    shared = fit.sparkSession.sparkContext.broadcast((basis, mean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (base, middle) = np.zeros((k, k)), shared.value
        for b in batches:
            y = (matrix(b.column("x"), len(middle)) - middle) @ base
            own += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k, dtype=np.int32)), pa.array(own.ravel())], ["at", "sum"])

    sums_of = fit.mapInArrow(run, "at int, sum double").groupBy("at").agg(F.sum("sum").alias("sum")).collect()
    out = np.zeros(k * k)
    for r in sums_of:
        out[r["at"]] = r["sum"]
    return out.reshape(k, k) / n


@dataclass
class Whitening:
    """What whitens a vector: (x - sums / n) @ vectors / sqrt(values), components by falling eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float


def fitted(points: DataFrame, d: int, components: int = MOST_COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``points`` (x, of length d); None where there are none."""
    fit = stored(points.select("x").distinct(), "fit-list")
    if fit.isEmpty():
        return None
    whole = combined(spectra(fit, d))
    basis, _ = np.linalg.qr(whole.vectors)  # orthonormal to the last bit
    small = projected_moment(fit, basis, whole.n, whole.sums)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    keep = np.argsort(-values)[:components]
    keep = keep[values[keep] > LEAST_SHARE * max(values.max(), 0)]
    vectors, values, trace = basis @ turn[:, keep], values[keep], float(np.trace(small))
    if not len(keep):
        return Whitening(whole.n, whole.sums, values, vectors, trace, 0.0)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    unit = projected_moment(fit, vectors / np.sqrt(values), whole.n, whole.sums)
    return Whitening(whole.n, whole.sums, values, vectors, trace, float(np.abs(unit - np.eye(len(keep))).max()))


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = MOST_COMPONENTS) -> DataFrame:
    """A row for each vector of ``vectors`` (vec_id, embedding) and component, up to ``components``.

    Null vectors and those with null or non-finite entries are left out, and so are those not of the length that most have
    (of equally many the longer), as they have no place in that space. Null and repeated vec_ids stay as rows. Repeated
    vectors count once in the fit. Components without variance (where there are fewer vectors than dimensions, or
    constant ones) are left out; a single distinct vector, or an empty table, gives no rows. A deviation beyond 64 bits is an
    error. What comes to the driver are d^2 numbers. Other columns are not read.
    """
    points = fixed_points(vectors)
    spark, size = vectors.sparkSession, F.size("x")
    common = points.where(size > 0).groupBy(size.alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    made = fitted(points.where(size == common.d), common.d, components) if common else None
    if made is None or not len(made.values):
        return spark.createDataFrame([], OUT)
    shared, d = spark.sparkContext.broadcast(made), common.d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k, mean, scale = len(m.values), m.sums / m.n, m.vectors / np.sqrt(m.values)
        explained = m.values / m.trace
        for b in (whole.slice(i, BATCH) for whole in batches for i in range(0, whole.num_rows, BATCH)):
            x = matrix(b.column("x"), d)
            apart = m.n * x - m.sums
            if m.n * float(np.abs(x).max()) > 2**62 or float(np.square(apart.astype(np.float64)).sum(axis=1).max()) > 2**62:
                raise OverflowError("a deviation needs more than 64 bits")
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, m.n)),
                 pa.array(np.repeat((apart * apart).sum(axis=1), k)), pa.array(((x - mean) @ scale).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, m.error))],
                [f.split()[0] for f in OUT.split(", ")])

    return points.where(size == d).select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, OUT)
