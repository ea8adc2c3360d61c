"""A stored inverted index: postings in buckets of terms, searched without the texts.

An index is a folder of segments, each with the documents of one call of ``add``. A segment has documents (their shard, place in
it, length, facets, dense vector), postings (a row for each term of a shard: places, weights and the bounds of blocks of 128;
in folders by the term's bucket) and terms with their document frequencies. A segment counts once its last table, ``meta``, is
complete. ``compact`` makes one segment of all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import Terms, hashed_vector
from ..operators.topk import Scorer, Shard, block_bounds

#: Postings of a shard, which one task builds and searches, and of a bucket, which one task writes.
PER_SHARD, PER_BUCKET = 1_000_000, 16_000_000
#: Queries that go to the tasks at a time.
QUERIES = 2000
PARSED = "doc long, length long, terms array<long>, tfs array<double>, embedding array<double>, facets array<string>, digest long"
BUILT = "shard int, term long, n long, docs array<int>, tfs array<double>, top_tf array<double>, low_length array<int>, doc long, place int, length long, embedding array<double>, facets array<string>, digest long"
KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()), "string": pa.string()}


def arrow_schema(fields: str) -> pa.Schema:
    return pa.schema([(name, KINDS[kind]) for name, kind in (f.split() for f in fields.split(", "))])


PARSED_ARROW, BUILT_ARROW = arrow_schema(PARSED), arrow_schema(BUILT)


def parsed(docs: DataFrame, dense: bool) -> DataFrame:
    """A row for each document (doc, text, context, weights, embedding, facets): terms with their weights, and the dense vector.

    Terms are those of ``text``, or where the document has ``weights`` (a learned model's, by token id) those, without weights of
    zero or less. With ``dense``, a missing embedding is made of the hashed terms of ``context``: one pass for both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Terms()
        for b in (whole.slice(i, 1000) for whole in batches for i in range(0, whole.num_rows, 1000)):
            cols = {c: b.column(c).to_pylist() for c in ("text", "context", "weights", "embedding")}
            lengths, cuts, terms, tfs, vectors = [], [0], [], [], []
            for text, context, weights, vector in zip(*cols.values(), strict=True):
                if weights is not None:
                    counts = {e["key"]: e["value"] for e in weights if e["value"] is not None and e["value"] > 0}
                    length = len(counts)
                else:
                    length, counts = own.counts(text)
                if dense and vector is None and context:
                    vector = hashed_vector(own.in_context(context, text, counts if weights is None else None))
                lengths.append(length)
                terms += counts.keys()
                tfs += counts.values()
                cuts.append(len(terms))
                vectors.append(vector)
            cuts = pa.array(cuts, pa.int32())
            lists = pa.ListArray.from_arrays(cuts, pa.array(np.array(terms, np.int64))), pa.ListArray.from_arrays(cuts, pa.array(np.array(tfs, np.float64)))
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(lengths, pa.int64()), *lists, pa.array(vectors, pa.list_(pa.float64())), b.column("facets"), b.column("digest")], schema=PARSED_ARROW)

    return docs.mapInArrow(run, PARSED)


def built(rows: pa.Table) -> pa.Table:
    """A shard's rows (shard and those of ``parsed``): one for each term and one for each document; of equal ids the first by length stays."""
    shard = rows.column("shard")[0].as_py()
    order = np.lexsort((rows.column("length").to_numpy(), rows.column("doc").to_numpy()))
    docs = rows.column("doc").to_numpy()[order]
    order = order[np.append(True, docs[1:] != docs[:-1])]
    rows = rows.take(pa.array(order)).combine_chunks()
    lengths = rows.column("length").to_numpy().astype(np.int64)
    listed = rows.column("terms").combine_chunks()
    sizes = np.asarray(listed.value_lengths().fill_null(0))
    terms, tfs = listed.flatten().to_numpy(), rows.column("tfs").combine_chunks().flatten().to_numpy()
    places = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    by = np.lexsort((places, terms))
    terms, tfs, places = terms[by], tfs[by], places[by]
    starts = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(terms))
    top_tf, low_length, block_cuts = block_bounds(tfs, lengths[places], starts)

    def lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))

    n, m = len(starts), rows.num_rows
    cuts = np.append(starts, len(terms))
    postings = {"shard": pa.array(np.full(n, shard, np.int32)), "term": pa.array(terms[starts] if n else [], pa.int64()), "n": pa.array(ends - starts, pa.int64()), "docs": lists(places, cuts, pa.int32()), "tfs": lists(tfs, cuts, pa.float64()), "top_tf": lists(top_tf, block_cuts, pa.float64()), "low_length": lists(low_length.astype(np.int32), block_cuts, pa.int32())}
    own = {"shard": pa.array(np.full(m, shard, np.int32)), "doc": rows.column("doc").combine_chunks(), "place": pa.array(np.arange(m, dtype=np.int32)), "length": rows.column("length").combine_chunks(), "embedding": rows.column("embedding").combine_chunks(), "facets": rows.column("facets").combine_chunks(), "digest": rows.column("digest").combine_chunks()}

    def full(cols: dict[str, pa.Array], size: int) -> pa.Table:
        return pa.Table.from_arrays([cols.get(f.name, pa.nulls(size, f.type)) for f in BUILT_ARROW], schema=BUILT_ARROW)

    return pa.concat_tables([full(postings, n), full(own, m)])


class InvertedIndex:
    """The segments of an index in a folder."""

    def __init__(self, spark: SparkSession, folder: str, facets: tuple[str, ...] = (), dense: bool = False) -> None:
        self.spark, self.folder, self.facets, self.dense = spark, folder.rstrip("/"), facets, dense

    def segments(self) -> list[str]:
        """Names of the complete segments in use: those of the last generation."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path(self.folder)):
            return []
        names = [f.getPath().getName() for f in files.listStatus(path(self.folder))]
        done = sorted(n for n in names if n.startswith("segment-") and files.exists(path(f"{self.folder}/{n}/meta/_SUCCESS")))
        return [n for n in done if n.split("-")[1] == done[-1].split("-")[1]] if done else []

    def read(self, kind: str, names: list[str] | None = None) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.folder}/{n}/{kind}").withColumn("segment", F.lit(n)) for n in (self.segments() if names is None else names)]
        out = None
        for p in parts:
            out = p if out is None else out.unionByName(p)
        return out

    def documents(self, names: list[str] | None = None) -> DataFrame | None:
        """(segment, shard, place, doc, length, embedding, facets, digest, gone) of all documents; a later segment has those replaced by it."""
        names = self.segments() if names is None else names
        rows, gone = self.read("documents", names), self.replaced(names)
        if rows is None:
            return None
        if gone is None:
            return rows.withColumn("gone", F.lit(False))
        return rows.join(gone.withColumn("gone", F.lit(True)), ["segment", "shard", "place"], "left").withColumn("gone", F.coalesce("gone", F.lit(False)))

    def replaced(self, names: list[str]) -> DataFrame | None:
        """(segment, shard, place) of documents that a later segment has anew; None where there are none."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        own = [f"{self.folder}/{n}/gone" for n in names if files.exists(path(f"{self.folder}/{n}/gone"))]
        return self.spark.read.parquet(*own) if own else None

    def vector_table(self) -> DataFrame | None:
        """(_digest, embedding, and weights if learned): the vectors made so far, by digest of model and context."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/vectors")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.parquet(f"{self.folder}/vectors").dropDuplicates(["_digest"])

    def keep_vectors(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.folder}/vectors")

    def add(self, docs: DataFrame, doc: str = "doc", context: Column | None = None, anew: bool = False) -> int:
        """A segment with the documents (doc, text, and the facets) that the index does not hold as they are; how many they are.

        A document whose context, text or facets changed replaces the former one. ``doc`` is unique; null ones go. Columns
        ``weights`` (map of token ids to weights) and ``embedding`` are taken where there are any. ``anew`` begins an index of these documents alone.
        """
        about = F.xxhash64("text", F.col("text") if context is None else context, *self.facets)
        new, names = docs.where(F.col(doc).isNotNull()).withColumn("_row", about), self.segments()
        generation = names[-1].split("-")[1] if names else f"{0:012d}"
        if anew and names:
            names, generation = [], f"{int(generation) + 1:012d}"
        gone = None
        if names:
            held = self.documents(names).where("NOT gone").select("segment", "shard", "place", F.col("doc").alias(doc), F.col("digest").alias("_row"))
            new = new.join(held.select(doc, "_row"), [doc, "_row"], "left_anti")
            gone = held.join(new.select(doc), doc, "left_semi").select("segment", "shard", "place")
        return self._write(new, doc, context, generation, gone)

    def _write(self, docs: DataFrame, doc: str, context: Column | None, generation: str, gone: DataFrame | None) -> int:
        at = f"{self.folder}/segment-{generation}-{uuid.uuid4().hex}"
        has = set(docs.columns)
        weights = F.map_entries("weights") if "weights" in has else F.lit(None).cast("array<struct<key:long,value:double>>")
        weights = weights.cast("array<struct<key:bigint,value:double>>")
        one = docs.select(
            F.col(doc).cast("long").alias("doc"), "text", (F.col("text") if context is None else context).alias("context"),
            weights.alias("weights"),
            (F.col("embedding").cast("array<double>") if "embedding" in has else F.lit(None).cast("array<double>")).alias("embedding"),
            F.array(*(F.col(c).cast("string") for c in self.facets)).cast("array<string>").alias("facets"), F.col("_row").alias("digest"))
        seen = Observation()
        parsed(one, self.dense).observe(seen, F.count("*").alias("n"), F.sum(F.size("terms")).alias("postings")).write.parquet(f"{at}/parsed")
        n = seen.get["n"]
        if n and gone is not None and not gone.isEmpty():
            gone.write.parquet(f"{at}/gone")
        return self._finish(at, n, seen.get["postings"] or 0)

    def _finish(self, at: str, n: int, postings: int) -> int:
        """The tables of a segment from its parsed rows, ``meta`` last; without rows there is none."""
        if n:
            shards, buckets = max(1, -(-postings // PER_SHARD)), max(16, -(-postings // PER_BUCKET))
            rows = self.spark.read.schema(PARSED).parquet(f"{at}/parsed").withColumn("shard", F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("int"))
            rows.groupBy("shard").applyInArrow(built, BUILT).write.parquet(f"{at}/built")
            both = self.spark.read.schema(BUILT).parquet(f"{at}/built")
            lists = both.where("term IS NOT NULL").select(F.pmod("term", F.lit(buckets)).cast("int").alias("bucket"), "term", "shard", "n", "docs", "tfs", "top_tf", "low_length")
            lists.repartition("bucket").sortWithinPartitions("bucket", "term", "shard").write.partitionBy("bucket").parquet(f"{at}/postings")
            lists.groupBy("term").agg(F.sum("n").alias("df")).sortWithinPartitions("term").write.parquet(f"{at}/terms")
            both.where("doc IS NOT NULL").select("shard", "place", "doc", "length", "embedding", "facets", "digest").write.parquet(f"{at}/documents")
            meta = self.spark.range(1).select(F.lit(n).cast("long").alias("n"), F.lit(postings).cast("long").alias("postings"), F.lit(shards).alias("shards"), F.lit(buckets).alias("buckets"))
            meta.write.parquet(f"{at}/meta")
        for kind in ("parsed", "built"):
            self._delete(f"{at}/{kind}")
        return n

    def _delete(self, at: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def compact(self) -> None:
        """All segments as one of the next generation, from the stored rows: texts are not read. Readers of the former one go on with it."""
        names = self.segments()
        if len(names) < 2:
            return
        lists = self.read("postings", names).select("segment", "shard", "term", F.explode(F.arrays_zip("docs", "tfs")).alias("p")).select("segment", "shard", "term", F.col("p.docs").alias("place"), F.col("p.tfs").alias("tf"))
        docs = self.documents(names).where("NOT gone")
        terms = lists.groupBy("segment", "shard", "place").agg(F.collect_list(F.struct("term", "tf")).alias("t"))
        whole = docs.join(terms, ["segment", "shard", "place"], "left").select("doc", F.lit(None).cast("string").alias("text"), F.map_from_entries(F.coalesce("t", F.expr("CAST(array() AS array<struct<term:bigint,tf:double>>)"))).alias("weights"), "length", "embedding", "facets", "digest")
        self._write_again(whole, f"{int(names[0].split('-')[1]) + 1:012d}")

    def _write_again(self, rows: DataFrame, generation: str) -> None:
        at = f"{self.folder}/segment-{generation}-{uuid.uuid4().hex}"
        seen = Observation()
        again = rows.select("doc", "length", F.map_keys("weights").alias("terms"), F.map_values("weights").alias("tfs"), "embedding", "facets", "digest")
        again.observe(seen, F.count("*").alias("n"), F.sum(F.size("terms")).alias("postings")).write.parquet(f"{at}/parsed")
        self._finish(at, seen.get["n"], seen.get["postings"] or 0)

    def open_to(self, facets: dict[str, str] | None) -> Column:
        """Whether a document is in use and has the values of the facets; an empty value stands for any."""
        out = ~F.col("gone")
        for c, value in (facets or {}).items():
            if value:
                out = out & F.coalesce(F.col("facets")[self.facets.index(c)] == value, F.lit(False))
        return out

    def vectors(self, doc: str, facets: dict[str, str] | None = None) -> DataFrame:
        """(doc, embedding, and the facets) of the documents that have a dense vector."""
        rows = self.documents().where(F.col("embedding").isNotNull() & self.open_to(facets))
        return rows.select(F.col("doc").alias(doc), "embedding", *(F.col("facets")[i].alias(c) for i, c in enumerate(self.facets)))

    def postings(self, terms: list[int], names: list[str]) -> DataFrame:
        """The postings of the terms, from their buckets only."""
        out = None
        few = len(terms) <= 200
        asked = None if few else F.broadcast(self.spark.createDataFrame(pd.DataFrame({"term": terms})))
        for n in names:
            buckets = self.spark.read.parquet(f"{self.folder}/{n}/meta").first().buckets
            rows = self.spark.read.parquet(f"{self.folder}/{n}/postings").where(F.col("term").between(min(terms), max(terms)))
            own = sorted({t % buckets for t in terms})
            if len(own) < buckets:
                rows = rows.where(F.col("bucket").isin(own))
            rows = rows.where(F.col("term").isin(terms)) if few else rows.join(asked, "term", "left_semi")
            rows = rows.select(F.lit(n).alias("segment"), "shard", "term", "n", "docs", "tfs", "top_tf", "low_length")
            out = rows if out is None else out.unionByName(rows)
        return out

    def frequencies(self, terms: list[int], names: list[str], facets: dict[str, str] | None) -> dict[int, int]:
        """In how many documents (that have the facets) each term is; a number for each term comes to the driver."""
        if not any((facets or {}).values()) and self.replaced(names) is None:
            rows = self.read("terms", names).where(F.col("term").between(min(terms), max(terms)))
            rows = rows.join(F.broadcast(self.spark.createDataFrame(pd.DataFrame({"term": terms}))), "term", "left_semi")
            return {r.term: r.df for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}

        def count(lists: pa.Table, docs: pa.Table) -> pa.Table:
            open_ = np.zeros(docs.num_rows, np.int64)
            open_[docs.column("place").to_numpy()] = docs.column("open").to_numpy()
            n = [int(open_[np.asarray(d)].sum()) for d in lists.column("docs").to_numpy()] if docs.num_rows else [0] * lists.num_rows
            return pa.table({"term": lists.column("term"), "df": pa.array(n, pa.int64())})

        docs = self.documents(names).select("segment", "shard", "place", self.open_to(facets).alias("open")).groupBy("segment", "shard")
        rows = self.postings(terms, names).select("segment", "shard", "term", "docs").groupBy("segment", "shard").cogroup(docs).applyInArrow(count, "term long, df long")
        return {r.term: r.df for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}

    def top(self, queries: DataFrame, k: int, query: str = "item_id", doc: str = "doc_id", bm25: bool = False, k1: float = 1.2, b: float = 0.75, facets: dict[str, str] | None = None, within: tuple[str, ...] = ()) -> DataFrame:
        """(query, doc, score): the ``k`` best documents of each shard for each query (query, text or weights).

        Scores sum query weight * idf * the document's weight, or BM25's. Facets cut the documents, and what idf counts, for all
        queries; those of ``within`` cut them for a query that names a value. Queries go to the tasks in blocks; a shard's
        postings of their terms meet its documents in one task, which gives ``k`` rows for a query and no pair besides.
        """
        schema = f"{query} long, {doc} long, score double"
        names = self.segments()
        if not names:
            return self.spark.createDataFrame([], schema)
        weights = F.map_entries("weights").cast("array<struct<key:bigint,value:double>>") if "weights" in queries.columns else F.lit(None).cast("array<struct<key:bigint,value:double>>")
        wanted = F.array(*(F.coalesce(F.when(F.col(c) != "", F.xxhash64(F.col(c).cast("string"))), F.lit(0)) for c in within)).cast("array<long>")
        asked = queries.where(F.col(query).isNotNull()).select(F.col(query).cast("long").alias("id"), F.col("text") if "text" in queries.columns else F.lit(None).cast("string").alias("text"), weights.alias("weights"), wanted.alias("wanted"))
        blocks, out = max(1, -(-asked.count() // QUERIES)), None
        documents = self.documents(names)
        n, mean = documents.where(self.open_to(facets)).agg(F.count("*"), F.avg("length")).first()
        held = documents.select("segment", "shard", "place", "doc", "length", self.open_to(facets).alias("open"), F.array(*(F.coalesce(F.xxhash64(F.col("facets")[self.facets.index(c)]), F.lit(0)) for c in within)).cast("array<long>").alias("has"))
        for i in range(blocks):
            rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).orderBy("id").collect()
            terms = Terms()
            own = [(r.id, {e.key: e.value for e in r.weights if e.value and e.value > 0} if r.weights is not None else terms.counts(r.text)[1], np.array(r.wanted, np.int64)) for r in rows]
            every = sorted({t for _, counts, _ in own for t in counts})
            if not every:
                continue
            df = self.frequencies(every, names, facets)
            idf = {t: float(np.log(1 + (n - d + 0.5) / (d + 0.5))) for t, d in df.items() if d}
            shared = self.spark.sparkContext.broadcast([(q, {t: w * idf[t] for t, w in counts.items() if t in idf}, want if len(want) else None) for q, counts, want in own])
            search = searcher(shared, k, Scorer(float(mean or 0) or 1.0, k1, b) if bm25 else Scorer(), query, doc)
            part = self.postings(every, names).groupBy("segment", "shard").cogroup(held.groupBy("segment", "shard")).applyInArrow(search, schema)
            out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], schema) if out is None else out


def searcher(shared, k: int, scorer: Scorer, query: str, doc: str):  # noqa: ANN001, ANN201
    """Answers the queries of a block from a shard's postings and documents."""
    schema = pa.schema([(query, pa.int64()), (doc, pa.int64()), ("score", pa.float64())])

    def run(lists: pa.Table, docs: pa.Table) -> pa.Table:
        if not lists.num_rows or not docs.num_rows:
            return schema.empty_table()
        docs = docs.take(pa.array(np.argsort(docs.column("place").to_numpy()))).combine_chunks()
        open_ = docs.column("open").to_numpy()
        has = docs.column("has").combine_chunks().flatten().to_numpy().reshape(docs.num_rows, -1)
        shard = Shard(docs.column("doc").to_numpy(), docs.column("length").to_numpy().astype(np.float64), None if open_.all() else open_, has, scorer)
        cols = [lists.column(c).to_numpy() for c in ("term", "docs", "tfs", "top_tf", "low_length")]
        for row in zip(*cols, strict=True):
            shard.add(*row)
        found = [(q, *shard.top(weights, k, want)) for q, weights, want in shared.value]
        return pa.Table.from_arrays([
            pa.array(np.repeat(np.array([q for q, _, _ in found], np.int64), [len(d) for _, d, _ in found])),
            pa.array(np.concatenate([d for _, d, _ in found])), pa.array(np.concatenate([s for _, _, s in found]))], schema=schema)

    return run
