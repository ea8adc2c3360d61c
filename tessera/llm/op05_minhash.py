"""Near-duplicates by improved consistent weighted sampling over TF-IDF word shingles.

Samples are banded; texts that share a band are candidates; weighted Jaccard over whole texts decides. Copies of one
word sequence go on as one text. Within a bucket every text is held against the bucket's smallest id first; only
texts that are not connected after that are held against each other, so no group is expanded into all its pairs.
Every candidate is verified: first by a bound that similarity can't exceed, from the weights of a text's shingles summed up
in 256 cells, and then, where that leaves it open, by the shingles of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .shingles import SCALE, document_frequencies, idf_levels, mixed, sampler, shingles, weighted, weighted_jaccard, word_hashes

#: Rows of one bucket that go to one task in joins.
PER_SALT = 20_000
CELLS = 256
SIGS = "doc_id long, k1 long, k2 long, bands array<long>, sums binary"


def summed(weights: tuple[np.ndarray, np.ndarray]) -> bytes:
    """The weights of shingles summed up in cells: their total, the unit of a cell, and the cells in units, rounded up."""
    w = np.exp2(weights[1] / SCALE)
    cells = np.bincount((weights[0] >> np.uint64(56)).astype(np.int64), w, CELLS)
    unit = cells.max() / 65_000
    return np.array([w.sum(), unit]).tobytes() + np.ceil(cells / unit).astype("<u2").tobytes()


def opened(sums: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Totals, and cells (no less than they were), of texts."""
    raw = np.frombuffer(b"".join(sums), np.uint8).reshape(len(sums), 16 + 2 * CELLS)
    head = raw[:, :16].copy().view(np.float64)
    return head[:, 0], raw[:, 16:].copy().view("<u2") * (head[:, 1:] * (1 + 1e-9))


def most_similar(total_a: np.ndarray, cells_a: np.ndarray, total_b: np.ndarray, cells_b: np.ndarray) -> np.ndarray:
    """What weighted Jaccard similarity can be at most: what two texts share in a cell is no more than the lesser of them has there."""
    shared = np.minimum(cells_a, cells_b).sum(axis=-1)
    shared = np.minimum(shared, np.minimum(total_a, total_b))
    return shared / (total_a + total_b - shared)


def signatures(docs: DataFrame, levels, k: int, bands: int, rows: int) -> DataFrame:
    """For each text with words: a 128-bit key of its words, the band keys, and the sums of its weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lv, salt = sampler(bands * rows), levels.value, np.arange(bands, dtype=np.uint64)
        for b in batches:
            out = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                w = word_hashes(text)
                if doc is None or not len(w):
                    continue
                at = mixed(np.arange(len(w), dtype=np.uint64))
                keys = [int((w * (at | np.uint64(1))).sum().view(np.int64)), int(mixed(w ^ at).sum().view(np.int64))]
                weights = weighted(shingles(w, k), lv)
                s = own.samples(*weights)
                band = mixed(s.reshape(bands, rows) * np.arange(1, 2 * rows, 2, dtype=np.uint64) + salt[:, None])
                out.append((doc, *keys, mixed(band.sum(axis=1) + salt).view(np.int64), summed(weights)))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True)], [f.split()[0] for f in SIGS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SIGS)


def with_bucket(rows: DataFrame, buckets: DataFrame, key: str = "key", doc: str = "doc_id", how: str = "inner", size: str = "n") -> DataFrame:
    """``rows`` (key, doc, ...) joined with ``buckets`` (key, size, ...), so that a task gets PER_SALT rows of a bucket or so.

    Large buckets, of which there is one for PER_SALT rows at most, tell the rows how many ways theirs is dealt.
    """
    ways = F.ceil(F.col(size) / PER_SALT).cast("int")
    large = buckets.where(F.col(size) > PER_SALT).select(key, ways.alias("_ways"))
    spread = buckets.withColumn("_salt", F.explode(F.sequence(F.lit(0), ways - 1)))
    dealt = rows.join(F.broadcast(large), key, "left").withColumn("_salt", F.pmod(F.xxhash64(doc), F.coalesce("_ways", F.lit(1))).cast("int")).drop("_ways")
    return dealt.join(spread, [key, "_salt"], how).drop("_salt")


def likely(pairs: DataFrame, sigs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose similarity may be ``threshold`` or more by the sums of their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                bound = most_similar(*opened(b.column("sa").to_pylist()), *opened(b.column("sb").to_pylist()))
                yield b.select(["a", "b"]).filter(pa.array(bound >= threshold))

    both = pairs.join(sigs.select(F.col("doc_id").alias("a"), F.col("sums").alias("sa")), "a").join(sigs.select(F.col("doc_id").alias("b"), F.col("sums").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def similar(pairs: DataFrame, texts: DataFrame, levels, k: int, threshold: float, per_task: int = 100) -> DataFrame:
    """The pairs (a, b) of weighted Jaccard similarity ``threshold`` or more, over whole texts.

    Texts travel to the b of their pairs, at most ``per_task`` to one copy of b; rows come sorted with b first, so a
    task holds one b and one row at a time.
    """
    large = pairs.groupBy("b").count().where(F.col("count") > per_task).select("b", "count", F.ceil(F.col("count") / per_task).cast("long").alias("n"))
    dealt = with_bucket(pairs, large, "b", "a", "left", "count").withColumn("salt", F.pmod(F.xxhash64("a"), F.coalesce("n", F.lit(1)))).drop("n", "count")
    ways = dealt.select(F.col("a").alias("doc_id"), "b", "salt").unionByName(dealt.select(F.col("b").alias("doc_id"), "b", "salt").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lv, at, hubs = levels.value, None, []
        for batch in batches:
            out = []
            for b, salt, doc, text in zip(*(batch.column(c).to_pylist() for c in ("b", "salt", "doc_id", "text")), strict=True):
                if (b, salt) != at:
                    at, hubs = (b, salt), []
                own = weighted(shingles(word_hashes(text), k), lv)
                if doc == b:
                    hubs.append(own)
                elif any(weighted_jaccard(own, h) >= threshold for h in hubs):
                    out.append((doc, b))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    routed = ways.join(texts.select("doc_id", "text"), "doc_id").select("b", "salt", "doc_id", "text").repartition("b", "salt").sortWithinPartitions("b", "salt", F.expr("doc_id <> b"), "doc_id")
    return routed.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, k: int = 5, bands: int = 12, rows: int = 4, idf_strength: float = 0.1) -> DataFrame:
    """(doc_id, class_id) for every distinct doc_id of ``docs`` (doc_id, text).

    class_id is the smallest doc_id that links of similarity ``threshold`` or more reach. Weights are
    tf * (1 + idf_strength * idf) with idf from 0 to 1: shared passages count somewhat less than rare ones, while an edit,
    whose shingles are all rare, does not outweigh the text it stands in (at 1.0 it does). A text without words
    (null and empty ones) is a class of its own; rows of one doc_id are one document; a null doc_id gives a row with a
    null class; texts of any length count whole. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    n_docs = docs.count()
    levels = spark.sparkContext.broadcast(idf_levels(document_frequencies(docs, k), n_docs, idf_strength))
    sigs = stored(signatures(docs, levels, k, bands, rows), "signatures")
    # copies of a word sequence: one text goes on
    groups = stored(sigs.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    copies = stored(sigs.select("doc_id", "k1", "k2").join(groups, ["k1", "k2"]).where("doc_id <> rep").distinct(), "copied")
    reps = sigs.select("doc_id", "k1", "k2", "bands").join(copies.select("doc_id", "k1", "k2"), ["doc_id", "k1", "k2"], "left_anti")
    members = reps.select(F.explode("bands").alias("key"), "doc_id").distinct()
    buckets = stored(members.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("hub")).where("n > 1"), "buckets")
    members = stored(with_bucket(members, buckets), "members")
    # what is involved grows with the corpus: texts are sorted and merged with it at every size, never broadcast
    involved = members.select("doc_id").hint("merge")
    texts = docs.join(involved, "doc_id", "left_semi").join(sigs.select("doc_id", "bands", "sums").hint("merge"), "doc_id")
    texts = stored(texts.select("doc_id", "text", "bands", "sums"), "texts")
    pairs = members.where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    pairs = stored(likely(pairs, sigs, threshold), "pairs")
    comps = components(stored(similar(pairs, texts, levels, k, threshold), "links"))
    links = stored(cross_links(members, comps, texts, levels, k, threshold), "cross-links")
    if not links.isEmpty():
        comps = components(links.unionByName(comps.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    ids = docs.select("doc_id").distinct()
    if n_docs > ids.count():  # texts of one id tie their classes together
        classes = components(comps.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    else:
        own = copies.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(F.col("doc_id").alias("id"), F.coalesce("component", "rep").alias("component"))
        classes = comps.unionByName(own)
    return ids.join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("class_id"))


def cross_links(members: DataFrame, comps: DataFrame, texts: DataFrame, levels, k: int, threshold: float, rest_block: int = 100, block: int = 200) -> DataFrame:
    """Links (a, b) between texts of one bucket that are not connected yet.

    The texts of a bucket that are not connected with its smallest id are the rest. Blocks of the rest meet blocks of
    the whole bucket, so a large bucket is many small groups, and a pair never becomes a row: it is looked at in the
    bucket of its first common band, if its components differ there and its bound is high enough.
    """
    with_c = members.select("key", "doc_id").join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("c"))
    hubs = with_c.groupBy("key").agg(F.count("*").alias("n"), F.min_by("c", "doc_id").alias("hub_c"), F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    open_ = stored(with_bucket(with_c, hubs.drop("low", "high")), "open")
    rests = open_.where("c <> hub_c").groupBy("key").agg(F.count("*").alias("m"), F.max("n").alias("size"))
    sized = with_bucket(open_, rests, size="size").select("key", "doc_id", "c", (F.col("c") != F.col("hub_c")).alias("rest"), F.ceil(F.col("m") / rest_block).alias("rows"), F.ceil(F.col("n") / block).alias("cols"))
    own_row, own_col = (F.pmod(F.xxhash64("doc_id"), F.col(x)) for x in ("rows", "cols"))
    left = sized.where("rest").select("key", "doc_id", "c", own_row.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols") - 1)).alias("j"), F.lit(0).alias("side"))
    right = sized.select("key", "doc_id", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("i"), own_col.alias("j"), F.lit(1).alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lv, at = levels.value, None
        held: list[tuple] = []
        done: set[tuple[int, int]] = set()
        table: tuple = ()
        for batch in batches:
            out = []
            for key, i, j, side, doc, c, text, bands, sums in zip(*(batch.column(x).to_pylist() for x in ("key", "i", "j", "side", "doc_id", "c", "text", "bands", "sums")), strict=True):
                if (key, i, j) != at:
                    at, held, done, table = (key, i, j), [], set(), ()
                own = (doc, c, text, np.array(bands, np.int64), sums)
                if side == 0:
                    held.append(own)
                    continue
                if not held:
                    continue
                if not table:
                    table = (np.array([h[1] for h in held]), np.array([h[3] for h in held]), opened([h[4] for h in held]), {})
                cs, all_bands, all_sums, sets = table
                same = all_bands == own[3]
                first = np.where(same.any(axis=1), own[3][same.argmax(axis=1)], 0) == key
                mine = None
                met = np.flatnonzero((cs != c) & first)
                if not len(met):
                    continue
                bound = most_similar(all_sums[0][met], all_sums[1][met], *opened([sums]))
                for x in met[bound >= threshold].tolist():
                    other = held[x]
                    if (other[0], c) in done:
                        continue
                    mine = weighted(shingles(word_hashes(text), k), lv) if mine is None else mine
                    if x not in sets:
                        sets[x] = weighted(shingles(word_hashes(other[2]), k), lv)
                    if weighted_jaccard(mine, sets[x]) >= threshold:
                        done.add((other[0], c))
                        out.append((max(doc, other[0]), min(doc, other[0])))
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], pa.int64()) for n in (0, 1)], ["a", "b"])

    blocks = left.unionByName(right).join(texts, "doc_id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "doc_id")
    return blocks.select("key", "i", "j", "side", "doc_id", "c", "text", "bands", "sums").mapInArrow(run, "a long, b long")
