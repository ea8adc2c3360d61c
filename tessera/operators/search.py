"""Sparse, dense and hybrid search for batches of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fnv1a, tokens
from ..functions.vectors import hashed_vectors
from ..session import fresh_path
from ..sources.postings import InvertedIndex

TOP_K, PREFETCH_FACTOR, PREFETCH_LEAST, RRF_K = 5, 4, 20, 60
SCORERS, FUSIONS, MODES = ("tf_idf", "bm25", "learned"), ("rrf", "dbsf"), ("hybrid", "dense", "sparse")
#: Learned sparse weights (``learned_terms``) only make sense together with the dense model of the same name.
PAIRED_SPARSE = {"learned": "learned"}


def check_models(embed_model: str, sparse_method: str) -> None:
    """An error where a sparse method needs another dense model."""
    need = PAIRED_SPARSE.get(sparse_method)
    if need and embed_model != need:
        raise ValueError(f"sparse method {sparse_method} needs the dense model {need}, not {embed_model}")


def term_counts(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, term_id, tf) of a text column; tokens whose hashes are equal count as one term.

    Counts come before hashes, so each distinct token of a text is hashed once.
    """
    by_token = texts.select(*keys, F.explode(tokens(F.col("text"))).alias("token")).groupBy(*keys, "token").agg(F.count("*").alias("n"))
    return by_token.select(*keys, fnv1a(F.col("token")).alias("term_id"), "n").groupBy(*keys, "term_id").agg(F.sum("n").alias("tf"))


def learned_terms(rows: DataFrame, keys: list[str], weights: str = "weights") -> DataFrame:
    """(keys, term_id, tf) from a map of token ids to weights that a learned model gave; weights of zero or less go."""
    terms = rows.select(*keys, F.explode(F.col(weights)).alias("term_id", "tf"))
    return terms.select(*keys, F.col("term_id").cast("long").alias("term_id"), F.col("tf").cast("double").alias("tf")).where("tf > 0")


def inverse_frequencies(counts: DataFrame, n_docs: int) -> DataFrame:
    """(term_id, df, idf) with idf = ln(1 + (N - df + 0.5) / (df + 0.5)) over the whole collection."""
    df = counts.groupBy("term_id").agg(F.count("*").alias("df"))
    return df.withColumn("idf", F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5)))


def ranked(scores: DataFrame, query: str, doc: str, k: int) -> DataFrame:
    """The ``k`` best rows of each query by score (rounded to 6 decimals), then by id, with their rank from 1."""
    best = Window.partitionBy(query).orderBy(F.desc("score"), doc)
    return scores.withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)


def index_of(docs: DataFrame, doc: str = "doc_id", facets: tuple[str, ...] = (), dense: bool = False, embedder: str = "hashed", context: Column | None = None, folder: str | None = None) -> InvertedIndex:
    """The documents (doc, text, facets) in an index in ``folder``, or in a new one in the shared folder; see ``indexed_into``."""
    spark = docs.sparkSession
    index = InvertedIndex(spark, folder or fresh_path(spark, "index"), facets, dense)
    indexed_into(index, docs, doc, embedder, context)
    return index


def indexed_into(index: InvertedIndex, docs: DataFrame, doc: str = "doc_id", embedder: str = "hashed", context: Column | None = None, anew: bool = False) -> int:
    """Adds the documents that an index lacks, with their dense vectors where it has such; how many they are.

    The hashed embedder is part of the pass over the texts. Any other is called once for each distinct ``context`` (the text by
    default) that is not in the index's table of vectors by digest, and gives learned weights in the same call if it has such.
    """
    if not index.dense or embedder == "hashed":
        return index.add(docs, doc, context, anew)
    new = docs.where(F.col(doc).isNotNull())
    own = new.withColumn("_context", F.col("text") if context is None else context).withColumn("_digest", F.sha2(F.concat_ws("|", F.lit(embedder), "_context"), 256))
    wanted = own.where("_context IS NOT NULL").select("_digest", F.col("_context").alias("text")).dropDuplicates(["_digest"])
    known = index.vector_table()
    if known is not None:
        wanted = wanted.join(known.select("_digest"), "_digest", "left_anti")
    numbered = wanted.withColumn("_key", F.xxhash64("_digest"))
    made = embedded(numbered, "_key", embedder)
    index.keep_vectors(numbered.select("_digest", "_key").join(made, "_key").drop("_key"))
    return index.add(own.join(index.vector_table(), "_digest", "left").drop("_digest", "_context"), doc, context, anew)


def sparse_top(queries: DataFrame, docs: DataFrame | InvertedIndex, k: int = TOP_K, query: str = "item_id", doc: str = "doc_id", within: tuple[str, ...] = (), scorer: str = "tf_idf", facets: dict[str, str] | None = None, **options) -> DataFrame:
    """The ``k`` best documents for each query; a query that names a value of a column of ``within`` gets only those that have it.

    ``tf_idf`` sums query tf * idf * document tf, without saturation or length normalisation; ``bm25`` has both; ``learned``
    takes the weights of a learned model for the tfs. Documents that are no index yet are indexed first.
    """
    if scorer not in SCORERS:
        raise ValueError(f"unknown scorer {scorer}; there are {', '.join(SCORERS)}")
    named = tuple(dict.fromkeys([*within, *(facets or {})]))
    index = docs if isinstance(docs, InvertedIndex) else index_of(docs, doc, named)
    return ranked(index.top(queries, k, query, doc, bm25=scorer == "bm25", facets=facets, within=within, **options), query, doc, k)


def comparable() -> Column:
    """Whether a row's embedding is a vector that can be compared: with components, all of them finite."""
    return F.expr("embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))")


def dense_top(queries: DataFrame, vectors: DataFrame, k: int = TOP_K, block: int = 2000, query: str = "query_id", doc: str = "vec_id", same_ids: bool = True, within: tuple[str, ...] = ()) -> DataFrame:
    """(query, doc, score, rank): the ``k`` vectors of greatest cosine for each query vector; where ids are of one kind,
    the vector of the query's own id is left out. A query that names a value of a column of ``within`` gets only vectors that have it.

    Queries (query, embedding) go to the tasks in blocks of ``block``; a task keeps the best ``k`` of its rows
    for each query, so what is shuffled doesn't grow with the vectors of a task. Null and zero vectors, those with null or
    non-finite components and those of another length than the query's are left out.
    """
    lengths = [r[0] for r in queries.where(comparable()).select(F.size("embedding").alias("d")).distinct().collect()]
    if len(lengths) > 1:
        parts = [dense_top(queries.where(F.size("embedding") == d), vectors, k, block, query, doc, same_ids, within) for d in sorted(lengths)]
        return reduce(DataFrame.unionByName, parts)
    own_length = comparable() & (F.size("embedding") == F.lit(lengths[0] if lengths else 0))
    n, out = queries.count(), None
    blocks = max(1, -(-n // block))
    numbered = queries.where(own_length).select(F.col(query).cast("long").alias("id"), "embedding", F.array(*(F.coalesce(F.when(F.col(c) != "", F.xxhash64(c)), F.lit(0)) for c in within)).cast("array<long>").alias("want"), F.pmod(F.xxhash64(query), F.lit(blocks)).alias("block"))
    has = F.array(*(F.xxhash64(c) for c in within)).cast("array<long>").alias("has")
    schema = f"{query} long, {doc} long, score double"
    for i in range(blocks):
        rows = numbered.where(F.col("block") == i).orderBy("id").collect()
        if not rows:
            continue
        shared = queries.sparkSession.sparkContext.broadcast((np.array([r.id for r in rows]), np.array([r.embedding for r in rows], np.float64), np.array([r.want for r in rows], np.int64)))

        def best(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, q, want = shared.value
            q_norm = np.linalg.norm(q, axis=1)
            held_s, held_v = np.full((len(ids), 0), 0.0), np.full((len(ids), 0), 0, np.int64)
            for b in (whole.slice(j, 2000) for whole in batches for j in range(0, whole.num_rows, 2000)):
                x = b.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
                v, norms = b.column("vec").to_numpy(), np.outer(q_norm, np.linalg.norm(x, axis=1))
                s = np.full(norms.shape, -2.0)
                np.divide(q @ x.T, norms, out=s, where=norms > 0)
                s = np.round(s, 6)
                if within:
                    own = b.column("has").flatten().to_numpy().reshape(b.num_rows, -1)
                    for c in range(len(within)):
                        s[(want[:, c, None] != 0) & (want[:, c, None] != own[None, :, c])] = -2
                if same_ids:
                    s[ids[:, None] == v[None]] = -2
                held_s, held_v = np.hstack([held_s, s]), np.hstack([held_v, np.broadcast_to(v, s.shape)])
                keep = np.lexsort((held_v, -held_s), axis=1)[:, :k]
                held_s, held_v = np.take_along_axis(held_s, keep, 1), np.take_along_axis(held_v, keep, 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, held_s.shape[1])), pa.array(held_v.ravel()), pa.array(held_s.ravel())], [query, doc, "score"])

        part = vectors.where(own_length).select(F.col(doc).cast("long").alias("vec"), "embedding", has).mapInArrow(best, schema).where("score > -2")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = queries.sparkSession.createDataFrame([], schema)
    return ranked(out, query, doc, k)


def prefetch_limit(top_k: int, multiplier: int = PREFETCH_FACTOR) -> int:
    return max(top_k * multiplier, PREFETCH_LEAST)


def fused(legs: list[DataFrame], query: str, doc: str, fusion: str = "rrf", k: int = RRF_K) -> DataFrame:
    """(query, doc, score): several ranked lists (query, doc, score, rank) as one.

    ``rrf`` sums 1 / (k + rank). ``dbsf`` sums scores by where they stand between three standard deviations below and
    above their list's mean; a list without spread counts 0.5.
    """
    if fusion not in FUSIONS:
        raise ValueError(f"unknown fusion {fusion}; there are {', '.join(FUSIONS)}")
    parts = None
    for leg in legs:
        if fusion == "rrf":
            share: Column = 1 / (F.lit(float(k)) + F.col("rank"))
        else:
            own = Window.partitionBy(query)
            mean, spread = F.avg("score").over(own), F.stddev_samp("score").over(own)
            share = F.when(F.coalesce(spread, F.lit(0.0)) == 0, 0.5).otherwise((F.col("score") - (mean - 3 * spread)) / (6 * spread))
        part = leg.select(query, doc, share.alias("share"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy(query, doc).agg(F.sum("share").alias("score"))


def hybrid_top(legs: list[DataFrame], query: str, doc: str, top_k: int = TOP_K, fusion: str = "rrf") -> DataFrame:
    """The best ``top_k`` of the fused legs, each of which is cut to the prefetch limit first."""
    limit = prefetch_limit(top_k)
    return ranked(fused([leg.where(F.col("rank") <= limit) for leg in legs], query, doc, fusion), query, doc, top_k)


def hybrid_search(queries: DataFrame, chunks: DataFrame | InvertedIndex, query: str = "item_id", doc: str = "doc_id", top_k: int = TOP_K, fusion: str = "rrf", mode: str = "hybrid", embedder: str = "hashed", sparse_method: str = "tf_idf", facets: dict[str, str] | None = None, within: tuple[str, ...] = (), context: Column | None = None) -> DataFrame:
    """(query, doc, score, rank): the best ``top_k`` chunks for each query (query, text).

    Facets cut the chunks (doc, text, matiere, niveau, cycle) before both legs; columns named in ``within`` do so query by
    query, where the query has a value there. ``mode`` is hybrid, dense or sparse. The dense leg searches the vectors of
    ``context`` (the chunk's text by default) by the registered ``embedder``; ``sparse_method`` is tf_idf, bm25 or learned. Each
    leg goes as deep as the prefetch limit. Chunks that are no index yet are indexed first.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}; there are {', '.join(MODES)}")
    check_models(embedder, sparse_method)
    limit, legs, learned = prefetch_limit(top_k), [], sparse_method == "learned"
    if isinstance(chunks, InvertedIndex):
        index = chunks
    else:
        named = tuple(dict.fromkeys([*within, *(facets or {})]))
        index = index_of(chunks, doc, named, mode != "sparse" or learned, embedder, context)
    asked = embedded(queries, query, embedder) if mode != "sparse" or learned else None
    if within and asked is not None:
        asked = asked.join(queries.select(query, *within), query)
    if mode != "dense":
        legs.append(sparse_top(asked if learned else queries, index, limit, query=query, doc=doc, within=within, scorer=sparse_method, facets=facets))
    if mode != "sparse":
        legs.append(dense_top(asked, index.vectors(doc, facets), limit, query=query, doc=doc, same_ids=False, within=within))
    return hybrid_top(legs, query, doc, top_k, fusion) if len(legs) > 1 else legs[0].where(F.col("rank") <= top_k)


#: Embedders by name: each takes (rows, key) with a text column and gives (key, embedding), and weights of terms if it has such.
EMBEDDERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {"hashed": lambda rows, key: hashed_vectors(term_counts(rows, [key]), key)}


def embedded(rows: DataFrame, key: str, embedder: str = "hashed") -> DataFrame:
    """(key, embedding) of texts by a registered embedder."""
    if embedder not in EMBEDDERS:
        raise ValueError(f"unknown embedder {embedder}; there are {', '.join(sorted(EMBEDDERS))}")
    return EMBEDDERS[embedder](rows.select(key, "text"), key)


def model_embedder(encode: Callable, batch: int = 64, sparse: bool = False) -> Callable[[DataFrame, str], DataFrame]:
    """An embedder from a function that encodes a list of texts; each task calls it with ``batch`` texts at once. Null texts go.

    ``encode`` gives a matrix, or with ``sparse`` a pair: the matrix, and for each text a map of token ids to learned weights.
    """

    def embed(rows: DataFrame, key: str) -> DataFrame:
        kinds = pa.schema([(key, pa.int64()), ("embedding", pa.list_(pa.float64())), *([("weights", pa.map_(pa.int64(), pa.float64()))] if sparse else [])])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in (whole.slice(i, batch) for whole in batches for i in range(0, whole.num_rows, batch)):
                made = encode(b.column("text").to_pylist())
                dense, weights = made if sparse else (made, None)
                cols = [b.column(key), pa.array(list(np.asarray(dense, np.float64)), pa.list_(pa.float64()))]
                if sparse:
                    cols.append(pa.array([[(int(t), float(w)) for t, w in own.items()] for own in weights], pa.map_(pa.int64(), pa.float64())))
                yield pa.RecordBatch.from_arrays(cols, schema=kinds)

        return rows.where("text IS NOT NULL").select(F.col(key).cast("long"), "text").mapInArrow(run, f"{key} long, embedding array<double>" + (", weights map<long,double>" if sparse else ""))

    return embed


def with_payload(hits: DataFrame, chunks: DataFrame, doc: str) -> DataFrame:
    """Hits with the chunks' columns, looked up for the few that are left."""
    return hits.join(chunks, doc)
