"""Repeated passages by a sparse suffix array.

Suffixes are kept at content-selected positions only: where a gram of words has the least hash of a window of grams,
so that every passage of ``least`` words holds one. Suffixes whose gram stands in two documents are sorted by what
follows; neighbours in that order are compared, and matches extended to the left and right. All suffixes of a gram meet
in one task, but for those of hot grams, whose windows of ``least`` words are counted by a grouped exchange. Both are
exact, so results do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, stored
from .shingles import mixed, word_hashes

BASE = 0x9E3779B97F4A7C15
#: Over so many tasks the rows of one window are spread where it is met again.
SALTS = 16


def grams(w: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` words in a row, by joining hashes of runs of half the length."""
    if len(w) < k:
        return w[:0]
    out, size, run, length = None, 0, w, 1
    rest = k
    while rest:
        if rest & 1:
            out = run[: len(run)] if out is None else out[: len(run) - size] * np.uint64(pow(BASE, length, 1 << 64)) + run[size:]
            size += length
        rest >>= 1
        if rest:
            run = run[:-length] * np.uint64(pow(BASE, length, 1 << 64)) + run[length:]
            length *= 2
    return mixed(out[: len(w) - k + 1])


def anchors(w: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the least gram of each ``least`` words in a row, and the grams' hashes."""
    g, width = grams(w, k), least - k + 1
    if len(g) < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.lib.stride_tricks.sliding_window_view(g, width).argmin(axis=1)
    at = np.unique(at + np.arange(len(at)))
    return at, g[at]


def contexts(w: np.ndarray, at: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """32 bits of the ``reach`` words after each gram, and of those before it, nearest first; 0 beyond the text."""
    short = np.concatenate([np.zeros(reach, np.uint32), (w >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.zeros(reach, np.uint32)])
    step = np.arange(reach)
    return short[at[:, None] + reach + k + step], short[at[:, None] + reach - 1 - step]


def agreed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading words two contexts share, row by row; places beyond the text agree with nothing."""
    return np.cumprod((a == b) & (a != 0), axis=1).sum(axis=1)


def window_keys(h: np.ndarray, right: np.ndarray, left: np.ndarray, need: int, a: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with ``a`` words before and ``need`` - a words after the gram, and a hash of the window they make with it."""
    ok = np.flatnonzero((left[:, :a] != 0).all(axis=1) & (right[:, : need - a] != 0).all(axis=1))
    key = h[ok]
    for part in (left[ok, :a], right[ok, : need - a]):
        for c in range(part.shape[1]):
            key = mixed(key * np.uint64(BASE) + part[:, c])
    return ok, key


def matched(h: np.ndarray, doc: np.ndarray, right: np.ndarray, left: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted suffixes: by how many words a match with another document reaches beyond the gram to the left and right.

    Both are -1 without a match of ``need`` words beyond the gram. Each suffix is held against its next
    neighbours of other documents and, where a gram has three or more suffixes, against all that share the rest of some
    window.
    """
    n, reach = len(h), right.shape[1]
    lo, hi = np.full(n, -1), np.full(n, -1)
    if n < 2:
        return lo, hi
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
    run = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [n]])
    for other in (first[run] - 1, last[run]):
        i = np.flatnonzero((other >= 0) & (other < n))
        i = i[h[other[i]] == h[i]]
        r, l_ = agreed(right[i], right[other[i]]), agreed(left[i], left[other[i]])
        ok = r + l_ >= need
        i, r, l_ = i[ok], r[ok], l_[ok]
        lo[i], hi[i] = np.maximum(lo[i], l_), np.maximum(hi[i], r)
    group = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
    own = np.flatnonzero((np.bincount(group) > 2)[group])
    if len(own):
        for a in range(min(reach, need) + 1):
            ok, key = window_keys(h[own], right[own], left[own], need, a)
            ok = own[ok]
            order = np.lexsort((doc[ok], key))
            k, d, o = key[order], doc[ok][order], ok[order]
            begin = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1]) if len(k) else np.empty(0, np.int64)
            size = np.diff(np.concatenate([begin, [len(k)]]))
            two = np.repeat(d[begin] != d[begin + size - 1], size) if len(k) else np.empty(0, bool)
            o = o[two]
            lo[o], hi[o] = np.maximum(lo[o], a), np.maximum(hi[o], need - a)
    return lo, hi


def repeated_passages(docs: DataFrame, least: int = 50, k: int = 32, rows_per_task: int = 100_000) -> DataFrame:
    """The passages of ``least`` or more words that stand in another document too: doc_id, start_word, n_words.

    Words are lower-cased and without punctuation. Overlapping and adjoining passages of a document are one row. Copies
    repeat as a whole; repeats within one document do not count, nor do rows of one doc_id among each other, and
    rows with a null doc_id are left out. Texts of fewer than ``least`` words (null and empty ones too) have none. Other
    columns are not read. The result is the same for repeated rows. A gram with more than ``rows_per_task`` suffixes is hot.
    """
    spark, reach = docs.sparkSession, least - k
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, ids, ns = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                h, n = np.unique(anchors(word_hashes(text), k, least)[1], return_counts=True)
                hs.append(h)
                ids.append(np.full(len(h), doc, np.int64))
                ns.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(ns))], ["h", "doc_id", "n"])

    own = docs.mapInArrow(grams_of, "h long, doc_id long, n long")
    several = own.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum("n").alias("n")).where("a <> b")
    several = stored(several.select("h", (F.col("n") > rows_per_task).alias("hot")), "grams")
    listed = own.select("h", "doc_id").join(several, "h").groupBy("doc_id").agg(F.collect_set("h").alias("hs"), F.collect_set(F.when(F.col("hot"), F.col("h"))).alias("hot"))
    wanted = stored(listed, "wanted")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                b, out = whole.slice(i, 500), []
                for doc, text, hs, hot in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("hs"), b.column("hot"), strict=True):
                    w = word_hashes(text)
                    at, h = anchors(w, k, least)
                    keep = np.isin(h.view(np.int64), hs.values.to_numpy())
                    at, h = at[keep], h[keep]
                    out.append((h.view(np.int64), np.full(len(at), doc, np.int64), at, np.isin(h.view(np.int64), hot.values.to_numpy()), *contexts(w, at, k, reach)))
                h, doc, at, hot, right, left = (np.concatenate(x) for x in zip(*out, strict=True))
                # big-endian, so that bytes sort as the words' numbers do
                packed = [pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * reach), len(h), [None, pa.py_buffer(x.astype(">u4").tobytes())]).cast(pa.binary()) for x in (right, left)]
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(doc), pa.array(at), pa.array(hot), *packed], ["h", "doc_id", "at", "hot", "r", "l"])

    schema = "h long, doc_id long, at long, hot boolean, r binary, l binary"
    sparse = stored(docs.join(wanted, "doc_id").select("doc_id", "text", "hs", "hot").mapInArrow(suffixes, schema), "suffixes")
    rare, hot = sparse.where("NOT hot"), sparse.where("hot")
    tasks = max(1, -(-rare.count() // rows_per_task))
    ordered = rare.repartition(tasks, "h").sortWithinPartitions("h", "r", "l", "doc_id", "at").select("h", "doc_id", "at", "r", "l")

    def unpacked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
        raw = column.to_pylist()
        return np.frombuffer(b"".join(raw), ">u4").astype(np.uint32).reshape(len(raw), reach)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        t = pa.Table.from_batches(parts) if parts else None
        if t is None or not t.num_rows:
            return
        h, doc, at = (t.column(c).to_numpy() for c in ("h", "doc_id", "at"))
        lo, hi = matched(h.view(np.uint64), doc, unpacked(t.column("r")), unpacked(t.column("l")), reach)
        i = np.flatnonzero(lo >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[i], at[i] - lo[i], at[i] + k + hi[i])], ["doc_id", "s", "e"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h, doc, at = (b.column(c).to_numpy() for c in ("h", "doc_id", "at"))
            right, left = unpacked(b.column("r")), unpacked(b.column("l"))
            for a in range(reach + 1):
                ok, key = window_keys(h.view(np.uint64), right, left, reach, a)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key.view(np.int64), doc[ok], at[ok] - a)], ["key", "doc_id", "s"])

    spans = ordered.mapInArrow(compared, "doc_id long, s long, e long")
    if several.where("hot").isEmpty():
        spans = stored(spans, "matches")
    else:
        seen = hot.select("h", "doc_id", "at", "r", "l").mapInArrow(windows, "key long, doc_id long, s long")
        shared = seen.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salted = seen.withColumn("salt", F.pmod(F.xxhash64("doc_id", "s"), F.lit(SALTS)).cast("int"))
        spans = stored(spans.unionByName(salted.join(shared, ["key", "salt"], "left_semi").select("doc_id", "s", (F.col("s") + least).alias("e"))), "matches")
    dropped(sparse)
    spans = spans.distinct()
    by_doc = Window.partitionBy("doc_id").orderBy("s", "e")
    begun = spans.withColumn("before", F.max("e").over(by_doc.rowsBetween(Window.unboundedPreceding, -1)))
    islands = begun.withColumn("island", F.sum(F.when(F.col("before") >= F.col("s"), 0).otherwise(1)).over(by_doc))
    return islands.groupBy("doc_id", "island").agg(F.min("s").alias("start_word"), (F.max("e") - F.min("s")).alias("n_words")).drop("island")
