"""The stored index against plain scores of all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.terms import PATTERN, Terms, hashed_vector
from tessera.functions.text import fnv1a, tokens
from tessera.functions.vectors import hashed_vectors
from tessera.operators import search
from tessera.operators.topk import BLOCK, Scorer, Shard, block_bounds
from tessera.sources import postings
from tessera.sources.postings import InvertedIndex

RNG = random.Random(11)
WORDS = [f"mot{i}" for i in range(60)]


def text(n):
    return " ".join(RNG.choices(WORDS, weights=[1 / (i + 1) for i in range(60)], k=n))


def plain(docs, queries, k, bm25=False, open_=lambda q, d: True, counted=lambda d: True):
    """The k best (doc, score) of each query from all pairs: docs and queries are {id: text}."""
    tf = {d: Counter(PATTERN.findall((t or "").lower())) for d, t in docs.items() if counted(d)}
    n, mean = len(tf), sum(sum(c.values()) for c in tf.values()) / max(len(tf), 1)
    df = Counter(w for c in tf.values() for w in c)
    out = {}
    for q, t in queries.items():
        scores = {}
        for d, c in tf.items():
            if not open_(q, d):
                continue
            s = 0.0
            for w, m in Counter(PATTERN.findall((t or "").lower())).items():
                if c[w]:
                    own = c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) if bm25 else c[w]
                    s += m * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * own
            if s:
                scores[d] = round(s, 6)
        out[q] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(rows, query="item_id"):
    out = {}
    for r in rows.orderBy(query, "rank").collect():
        out.setdefault(r[query], []).append((r.doc_id, r.score))
    return out


def same(got, want):
    want = {q: rows for q, rows in want.items() if rows}
    assert got.keys() == want.keys()
    for q, rows in want.items():
        assert [d for d, _ in got[q]] == [d for d, _ in rows] and [s for _, s in got[q]] == pytest.approx([s for _, s in rows], abs=1e-6)


DOCS = {i: text(RNG.choice([0, 3, 20, 90])) for i in range(400)} | {400: None, 401: "mot3", 402: "mot3", 403: "Mot3 !", 404: text(4000)}
QUERIES = {1: "mot3 mot40 mot59", 2: "mot0 mot0 mot1", 3: "absent", 4: None, 5: text(30), 6: "mot3"}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "abc"[i % 3], None if i % 5 == 0 else "xy"[i % 2]) for i, t in DOCS.items()], "doc_id long, text string, matiere string, niveau string")
    return docs, spark.createDataFrame(list(QUERIES.items()), "item_id long, text string")


def test_terms_equal_the_column_functions(spark):
    texts = ["L'Œuvre ÇA 5e Noël où THÉORÈME", "", "ΣΑΣ İ K ß ﬁn", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    want = {r.k: Counter(r.h) for r in rows.select("k", F.transform(tokens(F.col("text")), fnv1a).alias("h")).collect() if r.h}
    assert {i: Counter(c) for i, t in enumerate(texts) if (c := Terms(most=2).counts(t)[1])} == want
    dense = {r.k: r.embedding for r in hashed_vectors(search.term_counts(rows, ["k"]), "k").collect()}
    assert {i: v for i, t in enumerate(texts) if (v := hashed_vector(Terms().counts(t)[1]))} == dense


@pytest.mark.parametrize("bm25", [False, True])
@pytest.mark.parametrize("shard", [300, 10**6])
def test_index_equals_all_pairs_with_ties(spark, tables, monkeypatch, bm25, shard):
    monkeypatch.setattr(postings, "PER_SHARD", shard)
    docs, queries = tables
    index = search.index_of(docs)
    for k in (1, 5, 1000):
        same(found(search.sparse_top(queries, index, k, scorer="bm25" if bm25 else "tf_idf")), plain(DOCS, QUERIES, k, bm25))


def test_queries_in_blocks_agree(tables, monkeypatch):
    docs, queries = tables
    index = search.index_of(docs)
    monkeypatch.setattr(postings, "QUERIES", 2)
    same(found(search.sparse_top(queries, index, 5)), plain(DOCS, QUERIES, 5))


def test_facets_cut_documents_and_what_idf_counts(tables):
    docs, queries = tables
    index = search.index_of(docs, facets=("matiere", "niveau"))
    same(found(search.sparse_top(queries, index, 5, facets={"matiere": "a", "niveau": ""})), plain(DOCS, QUERIES, 5, counted=lambda d: d % 3 == 0))
    asked = queries.withColumn("niveau", F.when(F.col("item_id") == 2, "x").when(F.col("item_id") == 5, ""))
    level = {i: None if i % 5 == 0 else "xy"[i % 2] for i in DOCS}
    same(found(search.sparse_top(asked, index, 5, within=("niveau",))), plain(DOCS, QUERIES, 5, open_=lambda q, d: q != 2 or level[d] == "x"))


def test_segments_grow_replace_and_compact(spark, tables, tmp_path):
    docs, queries = tables
    index = InvertedIndex(spark, f"file://{tmp_path}/index", ("matiere",))
    first = docs.where("doc_id < 300")
    assert index.add(first, "doc_id") == 300 and index.add(first, "doc_id") == 0 and len(index.segments()) == 1
    assert index.add(docs, "doc_id") == len(DOCS) - 300
    same(found(search.sparse_top(queries, index, 5)), plain(DOCS, QUERIES, 5))
    changed = docs.withColumn("text", F.when(F.col("doc_id") % 50 == 0, "mot3 mot59 mot40").otherwise(F.col("text")))
    assert index.add(changed, "doc_id") == 9
    now = {i: "mot3 mot59 mot40" if i % 50 == 0 else t for i, t in DOCS.items()}
    for _ in range(2):  # before and after compaction
        same(found(search.sparse_top(queries, index, 5)), plain(now, QUERIES, 5))
        index.compact()
    assert len(index.segments()) == 1 and index.documents().count() == len(DOCS)
    assert index.add(docs.where("doc_id < 10"), "doc_id", anew=True) == 10 and index.documents().count() == 10


def test_a_search_reads_the_buckets_of_its_terms_and_no_text(spark, tables, tmp_path):
    docs, queries = tables
    index = InvertedIndex(spark, f"file://{tmp_path}/index")
    index.add(docs, "doc_id")
    lists = index.postings([Terms().term("mot3")], index.segments())
    assert lists.count() == 1
    scan = lists._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in scan and f" = {Terms().term('mot3') % 16})" in scan.split("PartitionFilters")[1].split("]")[0]
    plan = index.top(queries.where("item_id = 6"), 5)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "PartitionFilters" in plan


def test_empty_tables(spark, tables):
    docs, queries = tables
    assert search.sparse_top(queries, docs.limit(0)).count() == 0 and search.sparse_top(queries.limit(0), docs).count() == 0


def test_blocks_below_the_kth_score_are_not_scored():
    rng = np.random.default_rng(2)
    n = 20_000
    lengths = rng.integers(50, 200, n).astype(np.float64)
    shard = Shard(np.arange(n) * 3, lengths, None, None, Scorer(float(lengths.mean())))
    lists = {1: np.sort(rng.choice(n, 40, replace=False)), 2: np.arange(n), 3: np.sort(rng.choice(n, 9000, replace=False))}
    tfs = {t: rng.integers(1, 4, len(d)).astype(np.float64) for t, d in lists.items()}
    for t, d in lists.items():
        shard.add(t, d, tfs[t], *block_bounds(tfs[t], lengths[d], np.zeros(1, np.int64))[:2])
    weights = {1: 9.0, 2: 0.01, 3: 0.4}
    ids, scores = shard.top(weights, 5)
    every = np.zeros(n)
    for t, d in lists.items():
        every[d] += weights[t] * shard.scorer(tfs[t], lengths[d])
    best = np.lexsort((np.arange(n), -np.round(every, 6)))[:5]
    assert (ids == best * 3).all() and np.allclose(scores, np.round(every[best], 6))
    assert shard.work.scored < shard.work.postings / 100
    top, low, cuts = block_bounds(tfs[2], lengths, np.array([0, 7, 500]))
    assert cuts.tolist() == [0, 1, 1 + -(-493 // BLOCK), 1 + -(-493 // BLOCK) + -(-(n - 500) // BLOCK)]
    assert top[0] == tfs[2][:7].max() and low[-1] == lengths[500 + (n - 501) // BLOCK * BLOCK :].min()


def test_learned_weights_and_vectors_come_from_one_call_and_are_kept(spark, tmp_path):
    calls = tmp_path / "calls"

    def encode(texts):
        with calls.open("a") as f:
            f.writelines(f"{t}\n" for t in texts)
        return np.array([[len(t), 1.0] for t in texts]), [{ord(c) - 96: 0.5 for c in t if c.isalpha()} | {99: 0.0} for t in texts]

    search.EMBEDDERS["learned"] = search.model_embedder(encode, sparse=True)
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a c", "x"), (3, "c", "y"), (4, None, "y"), (5, "c", "z")], "doc_id long, text string, matiere string")
    asked = spark.createDataFrame([(7, "b c")], "item_id long, text string")
    index = InvertedIndex(spark, f"file://{tmp_path}/index", ("matiere",), dense=True)
    search.indexed_into(index, docs, embedder="learned")
    assert sorted(calls.read_text().split("\n")) == ["", "a b", "a c", "c"]  # equal contexts once, null ones never
    idf = {t: math.log(1 + (5 - d + 0.5) / (d + 0.5)) for t, d in ((2, 1), (3, 3))}
    got = found(search.hybrid_search(asked, index, mode="sparse", embedder="learned", sparse_method="learned"))
    want = sorted({1: idf[2] / 4, 2: idf[3] / 4, 3: idf[3] / 4, 5: idf[3] / 4}.items(), key=lambda x: (-x[1], x[0]))
    assert [d for d, _ in got[7]] == [d for d, _ in want] and [s for _, s in got[7]] == pytest.approx([s for _, s in want], abs=1e-6)
    calls.unlink()
    search.indexed_into(index, docs.unionByName(spark.createDataFrame([(6, "new", "x"), (8, "a c", "x")], docs.schema)), embedder="learned")
    assert calls.read_text() == "new\n" and index.documents().count() == 7
    assert len(found(search.hybrid_search(asked, index, embedder="learned", sparse_method="learned"))[7]) == 5
    with pytest.raises(ValueError, match="needs the dense model"):
        search.hybrid_search(asked, index, sparse_method="learned")


def test_vectors_that_cannot_be_compared_link_with_nothing(spark):
    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [inf, 0.0]), (6, [nan, 1.0]), (7, [1.0]), (8, [1.0, None]), (9, [])], "vec_id long, embedding array<double>")
    got = search.dense_top(rows.withColumnRenamed("vec_id", "query_id"), rows, 5).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {(1, 2), (2, 1)}
