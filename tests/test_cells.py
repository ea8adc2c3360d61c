"""The index of vectors against exact scores of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.search import ranked
from tessera.sources import cells
from tessera.sources.cells import CellIndex, coded, units

ROWS = "vec_id long, embedding array<double>"


def plain(x, q, k, same_ids):
    """The k best (id, score) of each query by all cosines, ties by id."""
    out = {}
    for i, v in q.items():
        s = {j: round(float(v @ u / np.linalg.norm(v) / np.linalg.norm(u)), 6) for j, u in x.items() if not (same_ids and i == j)}
        out[i] = sorted(s.items(), key=lambda r: (-r[1], r[0]))[:k]
    return out


def found(rows):
    out = {}
    for r in rows.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for i, rows in want.items():
        assert [j for j, _ in got[i]] == [j for j, _ in rows] and [s for _, s in got[i]] == pytest.approx([s for _, s in rows], abs=2e-6)


def test_codes_are_within_their_errors():
    rng = np.random.default_rng(1)
    x = units(np.vstack([rng.normal(size=(200, 24)), np.eye(24), rng.normal(size=(50, 24)) ** 9]))
    codes, step, error = coded(x)
    for q in units(rng.normal(size=(50, 24))):
        assert (np.abs(x @ q - (codes * step[:, None]) @ q) <= error + 1e-12).all()


@pytest.mark.parametrize("prune", [True, False])
@pytest.mark.parametrize("same_ids", [True, False])
def test_index_equals_all_pairs_on_clusters_with_ties(spark, tmp_path, prune, same_ids, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = {i: centres[i % 12] * rng.uniform(0.5, 4) + rng.normal(size=16) * 0.15 for i in range(600)}
    x |= {600 + i: x[i] * 2 for i in range(40)}  # the same directions
    q = {i: x[i] for i in range(0, 640, 37)} | ({} if same_ids else {9000: rng.normal(size=16)})
    df = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], ROWS).repartition(5)
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in q.items()], "query_id long, embedding array<double>")
    monkeypatch.setattr(cells, "QUERIES", 9)
    index = CellIndex(spark, f"file://{tmp_path}/cells").build(df, cells=24)
    rows, work = index.top(asked, 5, same_ids=same_ids, prune=prune)
    same(found(ranked(rows, "query_id", "vec_id", 5)), plain(x, q, 5, same_ids))
    assert work.scored < work.scanned / (1 if prune else 3)
    assert work.read == work.cells if not prune else work.read < work.cells / 2


def test_vectors_that_cannot_be_compared(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [inf, 0.0]), (6, [nan, 1.0]), (7, [1.0]), (8, [1.0, None]), (9, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, ROWS)
    index = CellIndex(spark, f"file://{tmp_path}/cells").build(df)
    got = ranked(index.top(df.withColumnRenamed("vec_id", "query_id"), 5)[0], "query_id", "vec_id", 5).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {(1, 2), (2, 1)}


def test_no_vectors_or_queries(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 0.0])], ROWS)
    asked = df.withColumnRenamed("vec_id", "query_id")
    assert CellIndex(spark, f"file://{tmp_path}/a").build(df.limit(0)).top(asked, 5)[0].count() == 0
    index = CellIndex(spark, f"file://{tmp_path}/b").build(df)
    assert index.top(asked.limit(0), 5)[0].count() == 0 and index.top(asked, 5, same_ids=False)[0].first().score == 1.0


def test_a_search_reads_the_folders_of_its_cells(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = np.repeat(np.eye(8), 20, axis=0) + rng.normal(size=(160, 8)) * 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], ROWS)
    index = CellIndex(spark, f"file://{tmp_path}/cells").build(df, cells=8)
    rows, work = index.top(df.where("vec_id = 3").select(F.col("vec_id").alias("query_id"), "embedding"), 5)
    assert rows.where("vec_id < 20").count() >= 5 and work.read < work.cells
    assert "PartitionFilters" in rows._jdf.queryExecution().executedPlan().toString()
