"""Hashed word shingles, counts of them in a fixed-size sketch, and consistent weighted samples."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import words_of

MIX1, MIX2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """64-bit hashes of words, remembered up to a bound."""

    limit = 200_000

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = h
        return h


HASHES = WordHash()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def shingles(w: np.ndarray, k: int) -> np.ndarray:
    """A hash for each ``k`` words in a row; one for all words where there are fewer; none without words."""
    if not len(w):
        return w
    n = max(1, len(w) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(k, len(w))):
        h = h * STEP + w[j : j + n]
    return mixed(h)


def counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and how often each stands there."""
    return np.unique(h, return_counts=True)


BLOCK = 1 << 14


def document_frequencies(docs: DataFrame, k: int, cells: int = 1 << 20) -> np.ndarray:
    """In how many texts a shingle stands, for each of ``cells`` cells of hashes, over all rows.

    The size is fixed: every task counts into its own cells, the sums go through two rounds of adding up
    blocks, and only the ``cells`` sums reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(cells, np.int64)
        for b in batches:
            held, n = [], 0
            for text in b.column("text").to_pylist():
                h = np.unique(shingles(word_hashes(text), k)) & np.uint64(cells - 1)
                held.append(h)
                n += len(h)
                if n > 1 << 20:
                    sums += np.bincount(np.concatenate(held).astype(np.int64), minlength=cells)
                    held, n = [], 0
            if held:
                sums += np.bincount(np.concatenate(held).astype(np.int64), minlength=cells)
        yield from blocks(dict(enumerate(sums.reshape(-1, min(BLOCK, cells)))))

    def blocks(by: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, x in by.items():
            if x.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.astype("<i8").tobytes()], pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column("block").to_pylist(), b.column("sums").to_pylist(), strict=True):
                v = np.frombuffer(x, "<i8")
                by[i] = by[i] + v if i in by else v
        yield from blocks(by)

    schema = "block int, sums binary"
    part = docs.select("text").mapInArrow(count, schema)
    some = part.withColumn("salt", F.spark_partition_id() % 16).repartition("block", "salt").select("block", "sums").mapInArrow(add, schema)
    out = np.zeros(cells, np.int64).reshape(-1, min(BLOCK, cells))
    for r in some.repartition("block").mapInArrow(add, schema).toLocalIterator():
        out[r.block] = out[r.block] + np.frombuffer(bytes(r.sums), "<i8")
    return out.reshape(-1)


#: Weights stand on a logarithmic scale of this many steps for a factor of two.
SCALE = 64


def idf_levels(df: np.ndarray, n_docs: int, strength: float) -> np.ndarray:
    """Levels (SCALE * log2) of 1 + strength * idf, idf from 0 to 1, for each cell.

    A cell's count holds other shingles too; the mean count is taken off, and one text is left at least.
    """
    own = np.maximum(1.0, df - df.mean())
    idf = np.log1p(n_docs / own) / np.log1p(max(1, n_docs))
    return np.rint(SCALE * np.log2(1 + strength * np.minimum(1.0, idf))).astype(np.int16)


def weighted(h: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles with the level of tf * idf; tf counts in quarters of a power of two."""
    u, n = counted(h)
    tf = np.rint(4 * np.log2(n)).astype(np.int64) * (SCALE // 4)
    return u, tf + levels[(u & np.uint64(len(levels) - 1)).astype(np.int64)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger ones; 0 where one has no shingles."""
    wa, wb = np.exp2(a[1] / SCALE), np.exp2(b[1] / SCALE)
    if not len(wa) or not len(wb):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(wa[i], wb[j]).sum()
    return float(low / (wa.sum() + wb.sum() - low))


class WeightedSampler:
    """Improved consistent weighted sampling: ``k`` samples of a weighted set.

    A sample takes the shingle of least a = c / (y e^r), where r and c are gamma(2, 1), b is uniform,
    t = floor(ln(w) / r + b) and y = e^(r (t - b)). The triples (r, c, b) are drawn once into a table of 2^15
    entries, which a hash of shingle and sample number chooses from; ln(a) is then a table by weight level.
    """

    BITS = 15

    def __init__(self, k: int, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        n = 1 << self.BITS
        self.k, self.r, self.b, self.lnc = k, rng.gamma(2, 1, n), rng.random(n), np.log(rng.gamma(2, 1, n))
        self.mult = rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.row: dict[int, int] = {}
        self.table = np.zeros((0, n), np.float32)

    def steps(self, level: np.ndarray | int, entry: np.ndarray | slice) -> np.ndarray:
        return np.floor(level * np.log(2) / SCALE / self.r[entry] + self.b[entry])

    def rows(self, levels: np.ndarray) -> np.ndarray:
        u, inv = np.unique(levels, return_inverse=True)
        for q in u.tolist():
            if q not in self.row:
                self.row[q] = len(self.table)
                lna = self.lnc - self.r * (self.steps(q, slice(None)) - self.b) - self.r
                self.table = np.vstack([self.table, lna.astype(np.float32)[None]])
        return np.array([self.row[q] for q in u.tolist()], np.int64)[inv]

    def samples(self, h: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """``k`` 64-bit sample ids of a non-empty set."""
        base = (self.rows(levels) << self.BITS).astype(np.uint64)
        flat, shift = self.table.reshape(-1), np.uint64(64 - self.BITS)
        best, at, all_ = np.full(self.k, np.inf, np.float32), np.zeros(self.k, np.int64), np.arange(self.k)
        for i in range(0, len(h), 2048):
            place = h[i : i + 2048] * self.mult[:, None]
            place >>= shift
            place += base[i : i + 2048]
            v = flat.take(place.view(np.int64))
            x = v.argmin(axis=1)
            low = v[all_, x]
            less = low < best
            best[less], at[less] = low[less], i + x[less]
        entry = ((h[at] * self.mult) >> shift).astype(np.int64)
        t = self.steps(levels[at], entry).astype(np.int64).astype(np.uint64)
        return mixed(h[at] * STEP + t)


@lru_cache(maxsize=4)
def sampler(k: int, seed: int = 1) -> WeightedSampler:
    return WeightedSampler(k, seed)
