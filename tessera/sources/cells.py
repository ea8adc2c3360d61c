"""A stored index of vectors: cells around centres, with eight-bit codes for the scan and the vectors for exact scores.

A vector of length one stands in the cell of its nearest centre, in the cell's folder, with its distance to the centre and its
code: a byte for each component, the step between codes, and how far the decoded vector is from the vector. A query can
be no nearer to anything in a cell than its distance to the centre less the cell's radius, and no further from what a
code says than the code's error; so whatever both leave out can't be among the best, and the rest is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settled

#: Vectors that centres are fitted on, cells at most, and queries that go to the tasks at a time.
SAMPLE, MOST_CELLS, QUERIES = 8192, 1024, 2000
#: Scores are rounded to six decimals: what is nearer to the k-th than this may still be among the best.
MARGIN = 2e-6
ROWS = "doc long, cell int, distance double, codes binary, step double, error double, embedding array<double>"


def comparable(column: str = "embedding") -> str:
    return f"{column} IS NOT NULL AND size({column}) > 0 AND forall({column}, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity')) AND exists({column}, c -> c <> 0)"


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres_of(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Centres of ``k`` groups of the sample by rounds of nearest centres and means; empty groups go."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = sums[n > 0] / n[n > 0, None]
    return centres


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, steps and errors of vectors; an error is the length of what the code leaves out, rounded up."""
    step = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / step[:, None]).astype(np.int8)
    return codes, step, np.linalg.norm(x - codes * step[:, None], axis=1) * (1 + 1e-9) + 1e-12


@dataclass
class Reading:
    """How many cells queries had, how many of them they read, and vectors scanned and scored exactly."""

    cells: int = 0
    read: int = 0
    scanned: int = 0
    scored: int = 0


class CellIndex:
    """Cells of vectors in a folder: ``vectors`` by cell, and ``manifest`` with each cell's centre, radius and size."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def build(self, vectors: DataFrame, doc: str = "vec_id", cells: int | None = None) -> CellIndex:
        """Writes the index of all comparable vectors (doc, embedding) of the length that most have; others link with nothing.

        Centres are fitted on SAMPLE vectors chosen by a hash of their components; every vector is indexed.
        """
        own = vectors.where(f"{doc} IS NOT NULL AND {comparable()}").select(F.col(doc).cast("long").alias("doc"), F.col("embedding").cast("array<double>").alias("embedding"))
        sizes = own.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
        d, n = (sizes.d, sizes.n) if sizes else (0, 0)
        own = own.where(F.size("embedding") == d)
        drawn = own.orderBy(F.xxhash64("embedding")).limit(SAMPLE).select("embedding").collect()
        centres = centres_of(units(np.array([r.embedding for r in drawn])), cells or min(MOST_CELLS, max(1, int(n**0.5)))) if drawn else np.zeros((0, 0))
        shared = self.spark.sparkContext.broadcast(centres)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value
            for b in (whole.slice(i, 2000) for whole in batches for i in range(0, whole.num_rows, 2000)):
                x = units(matrix(b.column("embedding")))
                cell = np.argmax(x @ c.T - (c**2).sum(axis=1) / 2, axis=1)
                codes, step, error = coded(x)
                far = np.linalg.norm(x - c[cell], axis=1)
                yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(cell, pa.int32()), pa.array(far), pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(step), pa.array(error), b.column("embedding")], [f.split()[0] for f in ROWS.split(", ")])

        own.mapInArrow(run, ROWS).repartition("cell").sortWithinPartitions("cell", "distance").write.partitionBy("cell").parquet(f"{self.folder}/vectors")
        held = self.spark.read.parquet(f"{self.folder}/vectors") if n else own.mapInArrow(run, ROWS)
        radii = held.groupBy("cell").agg(F.max("distance").alias("radius"), F.count("*").alias("n"))
        where = self.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
        radii.join(where, "cell").coalesce(1).write.parquet(f"{self.folder}/manifest")
        return self

    def top(self, queries: DataFrame, k: int, query: str = "query_id", doc: str = "vec_id", same_ids: bool = True, prune: bool = True) -> tuple[DataFrame, Reading]:
        """(query, doc, score): the ``k`` vectors of greatest cosine for each query (query, embedding) and few more, and what was read.

        Each query first reads the cells that can hold the nearest and have ``k`` vectors; what is the k-th best there cuts the
        other cells. Without ``prune`` all cells are read. Where ids are of one kind, the query's own is left out.
        Queries go to the tasks in blocks. Vectors that can't be compared, and those of another length, match nothing.
        """
        schema, work = f"{query} long, {doc} long, score double", Reading()
        cells = sorted(self.spark.read.parquet(f"{self.folder}/manifest").collect(), key=lambda r: r.cell)
        asked = queries.where(f"{query} IS NOT NULL AND {comparable()}").select(F.col(query).cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
        if cells:
            asked = asked.where(F.size("embedding") == len(cells[0].centre))
        n = asked.count() if cells else 0
        blocks, out = max(1, -(-n // QUERIES)), None
        for i in range(blocks if n else 0):
            rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).orderBy("id").collect()
            if not rows:
                continue
            ids, q = np.array([r.id for r in rows]), units(np.array([r.embedding for r in rows]))
            far = np.sqrt(np.maximum(0, 2 - 2 * (q @ np.array([c.centre for c in cells]).T) + np.array([np.dot(c.centre, c.centre) for c in cells]) - 1))
            bound = 1 - np.maximum(0, far - np.array([c.radius for c in cells]) - 1e-9) ** 2 / 2
            order = np.argsort(-bound + far * 1e-3, axis=1)
            sizes = np.array([c.n for c in cells])
            enough = np.cumsum(sizes[order], axis=1) >= min(k + same_ids, int(sizes.sum()))
            first = np.zeros(bound.shape, bool)
            np.put_along_axis(first, order, np.arange(len(cells)) <= enough.argmax(axis=1)[:, None], axis=1)
            if not prune:
                first[:] = True
            work.cells += first.size
            part = self._scored(ids, q, first, np.full(len(ids), -2.0), cells, k, query, doc, same_ids, work)
            if not first.all():
                best = Window.partitionBy(query).orderBy(F.desc("score"))
                kth = {r[query]: r.score for r in part.withColumn("n", F.row_number().over(best)).where(F.col("n") == k).select(query, "score").collect()}
                floor = np.array([kth.get(i, -2.0) for i in ids.tolist()])
                rest = ~first & (bound >= floor[:, None] - MARGIN)
                if rest.any():
                    part = part.unionByName(self._scored(ids, q, rest, floor, cells, k, query, doc, same_ids, work))
            out = part if out is None else out.unionByName(part)
        return (self.spark.createDataFrame([], schema) if out is None else out), work

    def _scored(self, ids: np.ndarray, q: np.ndarray, wanted: np.ndarray, floor: np.ndarray, cells: list, k: int, query: str, doc: str, same_ids: bool, work: Reading) -> DataFrame:
        """Exact scores of what the codes of the wanted cells leave open."""
        by_cell = {c.cell: np.flatnonzero(wanted[:, j]) for j, c in enumerate(cells) if wanted[:, j].any()}
        work.read += int(wanted.sum())
        work.scanned += int((wanted * np.array([c.n for c in cells])).sum())
        shared = self.spark.sparkContext.broadcast((ids, q, by_cell, floor))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, x, near, low_bar = shared.value
            lows = np.full((len(own), k), -2.0)
            bar = low_bar.copy()
            held: list[tuple] = []
            for b in (whole.slice(i, 4000) for whole in batches for i in range(0, whole.num_rows, 4000)):
                cell_of = b.column("cell").to_numpy()
                docs, steps, errors = (b.column(c).to_numpy() for c in ("doc", "step", "error"))
                codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.int8).reshape(len(docs), -1)
                for cell in np.unique(cell_of).tolist():
                    r, who = np.flatnonzero(cell_of == cell), near[cell]
                    s = x[who] @ (codes[r] * steps[r, None]).T
                    low, high = s - errors[r], s + errors[r]
                    if same_ids:
                        low[own[who][:, None] == docs[r][None]] = -2
                        high[own[who][:, None] == docs[r][None]] = -9
                    merged = np.hstack([lows[who], low])
                    lows[who] = -np.partition(-merged, k - 1, axis=1)[:, :k]
                    bar[who] = np.maximum(bar[who], lows[who].min(axis=1))
                    i, j = np.nonzero(high >= bar[who][:, None] - MARGIN)
                    held.append((who[i], docs[r][j], low[i, j], high[i, j]))
            if held:
                who, docs, low, high = (np.concatenate(c) for c in zip(*held, strict=True))
                keep = high >= bar[who] - MARGIN
                yield pa.RecordBatch.from_arrays([pa.array(own[who[keep]]), pa.array(docs[keep]), pa.array(low[keep]), pa.array(high[keep])], ["id", "doc", "low", "high"])

        rows = self.spark.read.parquet(f"{self.folder}/vectors").where(F.col("cell").isin(sorted(by_cell)))
        open_ = rows.select("cell", "doc", "codes", "step", "error").mapInArrow(scan, "id long, doc long, low double, high double")
        by_low = Window.partitionBy("id").orderBy(F.desc("low"))
        bars = open_.withColumn("n", F.row_number().over(by_low)).where(F.col("n") == k).select("id", F.col("low").alias("bar"))
        left = settled(open_.join(bars, "id", "left").where(F.col("bar").isNull() | (F.col("high") >= F.col("bar") - MARGIN)).select("id", "doc"))
        work.scored += left.count()
        asked = self.spark.sparkContext.broadcast((dict(zip(ids.tolist(), range(len(ids)), strict=True)), q))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, x = asked.value
            for b in batches:
                if b.num_rows:
                    own = np.array([at[i] for i in b.column("id").to_pylist()])
                    cos = (x[own] * units(matrix(b.column("embedding")))).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([b.column("id"), b.column("doc"), pa.array(np.round(cos, 6))], [query, doc, "score"])

        return left.join(rows.select("doc", "embedding"), "doc").select("id", "doc", "embedding").mapInArrow(score, f"{query} long, {doc} long, score double")
