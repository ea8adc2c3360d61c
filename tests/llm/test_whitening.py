"""Whitening against a plain eigendecomposition, and updates of a spectrum one by one."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.op13_whitening import Spectrum, combined, rank_one, spectra, whitened

ROWS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("kind", ["any", "equal", "rounded", "zeros", "wide"])
def test_updates_equal_a_plain_decomposition(kind):
    rng = np.random.default_rng(3)
    for _ in range(40):
        d = int(rng.integers(1, 14))
        values = np.sort(rng.random(d) * 10.0 ** rng.integers(-3, 6, size=d))
        values = {"any": values, "equal": np.full(d, values[0]), "rounded": np.round(values), "zeros": np.where(np.arange(d) < d // 2, 0, values), "wide": values * 1e9}[kind]
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        for step in (rng.normal(size=d) * 10.0 ** rng.integers(-5, 6), q[:, 0] * 3, np.zeros(d)):
            want = q @ np.diag(values) @ q.T + np.outer(step, step)
            new, vectors = rank_one(values, q, step)
            assert np.abs(vectors @ np.diag(new) @ vectors.T - want).max() <= 1e-12 * max(np.abs(want).max(), 1e-300)
            assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-12


def test_spectra_of_parts_combine():
    rng = np.random.default_rng(5)
    x = rng.integers(-40, 40, size=(3000, 9)) + 1_000_000
    x[:, 4] = 1_000_000  # constant
    parts = []
    for rows in np.array_split(x, [1, 2, 500, 501, 2000]):
        own = Spectrum.empty(9)
        for i in range(0, len(rows), 100):
            own.add(rows[i : i + 100])
        parts.append(own)
    for other in parts[1:]:
        parts[0].merge(other)
    scatter = np.cov(x.T.astype(float), bias=True) * len(x)
    got = parts[0].vectors @ np.diag(parts[0].values) @ parts[0].vectors.T
    assert np.abs(got - scatter).max() < 1e-10 * np.abs(scatter).max()
    assert parts[0].n == 3000 and (parts[0].sums == x.sum(axis=0)).all()


def test_spectra_of_many_tasks_combine_in_a_tree(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(-40, 40, size=(500, 6)) + 1_000_000
    fit = spark.createDataFrame([(row.tolist(),) for row in x], "x array<long>").repartition(11)
    got = combined(spectra(fit, 6), fan_in=2)
    scatter = np.cov(x.T.astype(float), bias=True) * len(x)
    assert np.abs(got.vectors @ np.diag(got.values) @ got.vectors.T - scatter).max() < 1e-10 * np.abs(scatter).max()
    assert got.n == 500 and (got.sums == x.sum(axis=0)).all()


def held_to_plain(df, rows, d, k=16):
    """Deviations and explained shares are equal, whitened values up to the sign, or up to a turn within equal eigenvalues."""
    good = [(i, v) for i, v, _ in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in good])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    cov = np.cov((fit - sums / n).T, bias=True).reshape(d, d)
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    live = e > 1e-10 * e[0]
    want = ((x - sums / n) @ q / np.sqrt(np.where(live, e, 1)))[:, live]
    got = df.orderBy("vec_id", "component").collect()
    assert len(got) == len(good) * live.sum() and {r.n for r in got} == {n}
    order = np.argsort([i for i, _ in good], kind="stable")
    w = np.array([r.whitened for r in got]).reshape(len(good), -1)
    assert np.abs(np.abs(w) - np.abs(want[order])).max() < 1e-8
    assert np.abs(np.array([r.explained for r in got]).reshape(len(good), -1) - e[live] / np.trace(cov)).max() < 1e-12
    deviation = ((n * x - sums) ** 2).sum(axis=1)[order]
    assert [r.deviation for r in got[:: live.sum()]] == deviation.tolist()
    assert all(r.identity_error < 1e-9 for r in got)


def test_whitening_equals_plain_with_copies_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    basis = rng.normal(size=(20, 20)) * np.linspace(0.2, 3, 20)
    rows = [(i, (rng.normal(size=20) @ basis).tolist(), 1) for i in range(700)]
    rows += [(1000 + i, rows[0][1], None) for i in range(400)]  # a third is one vector
    rows += [(2000, None, 1), (2001, [1.0, None] + [0.0] * 18, 1), (2002, [float("nan")] * 20, 1), (2003, [float("-inf")] + [1.0] * 19, 1), (2004, [], 1), (2005, [1.0, 2.0], 1), (2006, [-0.001] * 20, 1)]
    df = spark.createDataFrame(rows, ROWS).withColumn("x", F.lit("clash")).withColumn("n", F.lit(0)).repartition(7)
    held_to_plain(whitened(df), rows, 20)


def test_whitening_where_vectors_are_few_or_dimensions_constant(spark):
    rng = np.random.default_rng(9)
    few = [(i, rng.normal(size=12).tolist(), 1) for i in range(5)]
    held_to_plain(whitened(spark.createDataFrame(few, ROWS)), few, 12)
    flat = [(i, [*rng.normal(size=3).tolist(), 1.0, 0.0], 1) for i in range(100)]
    held_to_plain(whitened(spark.createDataFrame(flat, ROWS)), flat, 5)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1)] * 3, [(1, None, 1)], [(1, [], 1)]])
def test_whitening_without_variance_gives_no_rows(spark, rows):
    assert whitened(spark.createDataFrame(rows, ROWS)).count() == 0


def test_a_deviation_beyond_64_bits_is_an_error(spark):
    big = [(i, [float(i) * 1e9, 1.0], 1) for i in range(50)]
    with pytest.raises(Exception, match="64 bits"):
        whitened(spark.createDataFrame(big, ROWS)).count()
