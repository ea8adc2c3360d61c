"""Near-duplicate embeddings over a robust-pruned flat graph.

Vectors of a label go to overlapping cluster shards of bounded size. Each shard builds a pruned neighbour graph, the
adjacency lists of a vector are united over its shards, and each vector is searched for in the graph of its home shard:
greedily from the medoid and its own node, then expanding through all that is in range. An exact pass follows over
the other shards that may hold a partner; clusters that the triangle inequality settles as a whole are only counted.
Recall is audited against brute force. Cosines in double precision decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .shingles import mixed


def robust_prune(sims: np.ndarray, cand: np.ndarray, x: np.ndarray, alpha: float, degree: int) -> list[int]:
    """Of candidates in descending similarity, those that no kept one is ``alpha`` times nearer to than the vector is."""
    keep: list[int] = []
    dist = np.sqrt(np.maximum(0.0, 2 - 2 * sims))
    alive = np.ones(len(cand), bool)
    own = x[cand]
    for i in range(len(cand)):
        if not alive[i]:
            continue
        keep.append(int(cand[i]))
        if len(keep) == degree:
            break
        alive &= alpha * np.sqrt(np.maximum(0.0, 2 - 2 * (own @ own[i]))) > dist
    return keep


def build_graph(x: np.ndarray, degree: int = 24, near: int = 48, alpha: float = 1.2) -> list[set[int]]:
    """The pruned graph of the rows of ``x``, with edges both ways."""
    n = len(x)
    out: list[set[int]] = [set() for _ in range(n)]
    for i in range(0, n, 512):
        g = x[i : i + 512] @ x.T
        g[np.arange(len(g)), np.arange(i, i + len(g))] = -2
        m = min(near, n - 1)
        if m < 1:
            break
        top = np.argpartition(-g, m - 1, axis=1)[:, :m]
        for r in range(len(g)):
            s = g[r, top[r]]
            o = np.argsort(-s, kind="stable")
            for j in robust_prune(s[o], top[r][o], x, alpha, degree):
                out[i + r].add(j)
                out[j].add(i + r)
    return out


class Graph:
    """Adjacency lists as rows of one array, padded with -1."""

    def __init__(self, x: np.ndarray, lists: list[np.ndarray]) -> None:
        self.x, self.adj = x, np.full((len(x), max(1, max(map(len, lists), default=1))), -1, np.int64)
        for i, own in enumerate(lists):
            self.adj[i, : len(own)] = own
        self.medoid = int((x @ x.mean(axis=0)).argmax())

    def in_range(self, q: int, least: float, beam: int = 24, slack: float = 0.04) -> np.ndarray:
        """The nodes of cosine ``least`` or more with node ``q``, itself left out."""
        seen = np.zeros(len(self.x), bool)
        ids = np.unique([self.medoid, q])
        seen[ids] = True
        sims = self.x[ids] @ self.x[q]
        open_ = np.ones(len(ids), bool)
        while True:
            # the best unexpanded nodes of the beam, and all within the range or just outside
            bar = np.partition(sims, -beam)[-beam] if len(sims) > beam else -2.0
            pick = open_ & ((sims >= least - slack) | (sims >= bar))
            if not pick.any():
                break
            open_ &= ~pick
            nb = self.adj[ids[pick]].ravel()
            nb = np.unique(nb[nb >= 0])
            nb = nb[~seen[nb]]
            seen[nb] = True
            ids, sims, open_ = np.concatenate([ids, nb]), np.concatenate([sims, self.x[nb] @ self.x[q]]), np.concatenate([open_, np.ones(len(nb), bool)])
        hit = ids[sims >= least]
        return hit[hit != q]


def roots(n: int, links: list[np.ndarray]) -> np.ndarray:
    """The smallest row each row reaches by links."""
    up = list(range(n))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, own in enumerate(links):
        for j in own.tolist():
            a, b = find(i), find(j)
            if a != b:
                up[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)], np.int64)


def unit(raw: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in raw])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


RANGE = 0.93
#: Roles of a row of a shard: an edge alone, a vector at home, an overlapping copy, a visitor.
EDGE, HOME, COPY, VISITOR = range(4)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, v) of the vectors that can link, one for each vec_id."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    one = vectors.where("vec_id IS NOT NULL").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.struct("label", F.col("embedding").cast("array<double>").alias("v"))).alias("s"))
    return one.select("vec_id", "s.label", "s.v").where(F.col("label").isNotNull() & F.col("v").isNotNull()).where(finite).withColumn("dim", F.size("v"))


@dataclass
class Cells:
    """The centres of the labels of more than one cell, with what is known of each cell."""

    centres: dict[tuple[int, int], np.ndarray]
    spread: dict[tuple[int, int], float]  # the share of the border test's width that is kept
    blocks: dict[tuple[int, int], np.ndarray] | None = None
    radius: dict[tuple[int, int], np.ndarray] | None = None
    weight: dict[tuple[int, int], np.ndarray] | None = None
    low: dict[tuple[int, int], np.ndarray] | None = None


def chosen_centres(reps: DataFrame, target: int, most: int, deviations: float | None) -> Cells:
    """Vectors chosen by a hash, about one for ``target`` vectors of a label (together ``most`` at most, then cells are larger).

    The direction from a vector to a partner is taken to be ``deviations`` standard deviations at most from the border's
    plane, in as many dimensions as the centres of the label spread over; None: nothing is taken, the border test is exact.
    """
    sizes = reps.groupBy("label", "dim").agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum(F.ceil(F.col("size") / target))).first()[0] or 0
    target = target * max(1, -(-total // most))
    wanted = sizes.where(F.col("size") > target).select("label", "dim", F.lit(1.0 / target).alias("share"))
    chosen = reps.join(F.broadcast(wanted), ["label", "dim"]).where((F.xxhash64("vec_id") / F.lit(2.0**64) + 0.5) < F.col("share")).select("label", "dim", "v")
    by: dict[tuple[int, int], list] = {}
    for r in chosen.toLocalIterator():
        by.setdefault((r.label, r.dim), []).append(np.array(r.v))
    cells = Cells({}, {})
    for key, own in by.items():
        c = unit(own)
        cells.centres[key] = c
        eigen = np.linalg.eigvalsh(np.atleast_2d(np.cov(c[:4096].T))) if len(c) > 1 else np.ones(1)
        dims = max(1.0, eigen.sum() ** 2 / max(1e-300, (eigen**2).sum()))
        cells.spread[key] = 1.0 if deviations is None else min(1.0, deviations / np.sqrt(dims))
    return cells


def matrix(lists: pa.Array, rows: np.ndarray) -> np.ndarray:
    """Unit vectors of some rows of a list column, all of one length."""
    own = lists.take(pa.array(rows))
    x = own.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def keyed(b: pa.RecordBatch, size: int = 256) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """(label, dim) and the rows of a batch that have it, in parts of at most ``size``."""
    lab, dim = b.column("label").to_numpy(), b.column("dim").to_numpy()
    order = np.lexsort((dim, lab))
    cut = np.flatnonzero((np.diff(lab[order]) != 0) | (np.diff(dim[order]) != 0)) + 1
    for rows in np.split(order, cut):
        for i in range(0, len(rows), size):
            part = rows[i : i + size]
            yield (int(lab[part[0]]), int(dim[part[0]])), part


def homes(reps: DataFrame, shared) -> DataFrame:  # noqa: ANN001
    """``reps`` with cell (of the nearest centre), second (of the next one, or -1) and angle to the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            cell, second, angle = np.zeros(n, np.int32), np.full(n, -1, np.int32), np.full(n, np.pi)
            for key, rows in keyed(b) if n else ():
                c = shared.value.centres.get(key)
                if c is None:
                    continue
                s = matrix(b.column("v"), rows) @ c.T
                cell[rows] = first = s.argmax(axis=1)
                angle[rows] = np.arccos(np.clip(s[np.arange(len(rows)), first], -1, 1))
                if len(c) > 1:
                    s[np.arange(len(rows)), first] = -2
                    second[rows] = s.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(second), pa.array(angle)], [*b.schema.names, "cell", "second", "angle"])

    return reps.mapInArrow(run, "label long, dim int, vec_id long, n long, v array<double>, cell int, second int, angle double")


def surveyed(cells: Cells, at_home: DataFrame, target: int) -> Cells:
    """``cells`` with the number of blocks, the radius, the vectors and the smallest id of each cell."""
    own = at_home.groupBy("label", "dim", "cell").agg(F.count("*").alias("n_home"), F.sum("n").alias("weight"), F.max("angle").alias("radius"), F.min("vec_id").alias("low"))
    over = at_home.where("second >= 0").groupBy("label", "dim", F.col("second").alias("cell")).agg(F.count("*").alias("n_over"))
    both = own.join(over, ["label", "dim", "cell"], "left").withColumn("blocks", F.ceil((F.col("n_home") + F.coalesce("n_over", F.lit(0))) / (2 * target)).cast("int"))
    n_cells = {key: len(c) for key, c in cells.centres.items()}
    out = Cells(cells.centres, cells.spread, *({key: np.full(n, fill) for key, n in n_cells.items()} for fill in (1, np.pi, 0, -1)))
    for r in both.where((F.col("blocks") > 1) | (F.col("radius") < np.pi)).toLocalIterator():
        key = (r.label, r.dim)
        if key not in n_cells:
            for of, fill in ((out.blocks, 1), (out.radius, np.pi), (out.weight, 0), (out.low, -1)):
                of[key] = np.full(1, fill)
        out.blocks[key][r.cell], out.weight[key][r.cell], out.low[key][r.cell] = r.blocks, r.weight, r.low
        out.radius[key][r.cell] = r.radius
    return out


DEALT = "label long, dim int, cell int, block int, role int, vec_id long, n long, base long, low long, tight boolean, v array<double>"


def dealt(at_home: DataFrame, shared, least: float) -> DataFrame:  # noqa: ANN001
    """Rows of shards (label, dim, cell, block): each vector at home in one block, copied to one of its second cell, and visiting
    all blocks that may hold a partner.

    A cell is visited where a partner may be nearer to its centre, and within its radius. A tight cell, of which
    any two vectors link, is counted as a whole (base) by those that link with all of it, which get an edge to its
    smallest id. That is exact by the triangle inequality.
    """
    reach, edge = float(np.arccos(least)), float(np.sin(np.arccos(least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        one = np.zeros(1)
        for b in batches:
            if not b.num_rows:
                continue
            ids, n_all = b.column("vec_id").to_numpy(), b.column("n").to_numpy()
            home_all, second_all = b.column("cell").to_numpy(), b.column("second").to_numpy()
            for key, rows in keyed(b):
                c, blocks = cells.centres.get(key), cells.blocks.get(key, np.ones(1, np.int64))
                h, second, n, k = home_all[rows], second_all[rows], n_all[rows], len(rows)
                spot = mixed(ids[rows].view(np.uint64))
                base, tight_home = np.zeros(k, np.int64), np.zeros(k, bool)
                visits, full = np.zeros((k, 1), bool), np.zeros((k, 1), bool)
                if c is not None:
                    radius, weight = cells.radius[key], cells.weight[key]
                    s = matrix(b.column("v"), rows) @ c.T
                    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (c[h] @ c.T)))
                    gap = s[np.arange(k), h][:, None] - s
                    angle = np.arccos(np.clip(s, -1, 1))
                    tight = 2 * radius <= reach - SLACK
                    other = np.arange(len(c))[None] != h[:, None]
                    full = other & tight[None] & (angle + radius[None] <= reach - SLACK)
                    visits = other & ~full & (gap <= cells.spread[key] * edge * apart + SLACK) & (angle - radius[None] <= reach + SLACK)
                    tight_home = tight[h]
                    base = full @ weight + np.where(tight_home, weight[h] - n, 0)
                mine = (spot % blocks[h].astype(np.uint64)).astype(np.int64)
                i, j = np.nonzero(visits)
                # own cell: the other blocks are visited too, unless all of the cell links
                inner = np.flatnonzero(~tight_home & (blocks[h] > 1))
                i, j, own = np.concatenate([i, inner]), np.concatenate([j, h[inner]]), np.repeat([False, True], [len(i), len(inner)])
                times = blocks[j].astype(np.int64)
                block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                i, j, own = np.repeat(i, times), np.repeat(j, times), np.repeat(own, times)
                keep = ~own | (block != mine[i])
                i, j, block = i[keep], j[keep], block[keep]
                o = np.flatnonzero(second >= 0)
                fi, fj = np.nonzero(full)
                at = np.concatenate([np.arange(k), o, i, fi])
                cell = np.concatenate([h, second[o], j, fj])
                blk = np.concatenate([mine, (spot[o] % blocks[second[o]].astype(np.uint64)).astype(np.int64), block, np.zeros(len(fi), np.int64)])
                role = np.repeat([HOME, COPY, VISITOR, EDGE], [k, len(o), len(i), len(fi)])
                lows = cells.low.get(key, one)
                low = np.where((role == EDGE) | ((role == HOME) & tight_home[at]), lows[cell], ids[rows][at])
                lists = b.column("v").take(pa.array(rows[at], mask=role == EDGE))
                count = len(at)
                arrays = [np.full(count, key[0]), np.full(count, key[1], np.int32), cell.astype(np.int32), blk.astype(np.int32), role.astype(np.int32), ids[rows][at], n[at], np.where(role == HOME, base[at], 0).astype(np.int64), low.astype(np.int64), tight_home[at] & (role == HOME)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), lists], [f.split()[0] for f in DEALT.split(", ")])

    return at_home.mapInArrow(run, DEALT)


#: Angles are held against each other with this much to spare, far more than rounding takes; what is between is verified.
SLACK = 1e-6


def counted_links(groups: DataFrame, least: float, target: int, most_centres: int, deviations: float | None, part_rows: int, exact: bool) -> tuple[DataFrame, DataFrame]:
    """(vec_id, links) and edges (a, b) between distinct vectors (label, dim, vec_id, n, v)."""
    spark, at = groups.sparkSession, ["label", "dim", "cell", "block"]
    reps = groups.select(F.col("label").cast("long"), "dim", "vec_id", F.col("n").cast("long"), "v")
    cells = chosen_centres(reps, target, most_centres, deviations)
    first = spark.sparkContext.broadcast(cells)
    at_home = stored(homes(reps, first), "homes")
    shared = spark.sparkContext.broadcast(surveyed(cells, at_home, target))
    rows = stored(dealt(at_home, shared, least), "shards")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf.vec_id.to_numpy()
        lists = build_graph(unit(pdf.v.tolist()))
        return pd.DataFrame({"vec_id": ids, "nbrs": [ids[sorted(x)] for x in lists]})

    # a shard all of whose vectors are settled by its tightness needs no graph
    open_ = rows.where((F.col("role") == HOME) & ~F.col("tight")).select(*at).distinct()
    nodes = rows.where(F.col("role").isin(HOME, COPY)).select(*at, "vec_id", "v").join(open_, at, "left_semi")
    united = stored(nodes.groupBy(at).applyInPandas(build, "vec_id long, nbrs array<long>").groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs")), "graph")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        """Graph search for the vectors at home (part 0), an exact pass for the visitors."""
        is_node = pdf.role.to_numpy() != VISITOR
        pdf = pd.concat([pdf[is_node].sort_values("vec_id", kind="stable"), pdf[~is_node]])
        m = int(is_node.sum())
        ids, n, home, part = pdf.vec_id.to_numpy(), pdf.n.to_numpy(), pdf.role.to_numpy()[:m] == HOME, int(pdf.part.iloc[0])
        x = unit(pdf.v.tolist())
        links: list[np.ndarray] = [np.empty(0, np.int64)] * len(ids)
        asking = np.flatnonzero(home & ~pdf.tight.to_numpy()[:m]) if part == 0 else []
        if len(asking) and exact:
            for i in range(0, len(asking), 512):
                q = asking[i : i + 512]
                for k, r in zip(q, x[q] @ x[:m].T >= least, strict=True):
                    links[k] = (hit := np.flatnonzero(r))[hit != k]
        elif len(asking):
            lists = []
            for own_ids in pdf.nbrs.iloc[:m]:
                want = np.asarray([] if own_ids is None else own_ids, np.int64)
                j = np.searchsorted(ids[:m], want).clip(max=m - 1)
                lists.append(j[ids[j] == want])
            graph = Graph(x[:m], lists)
            for i in asking:
                links[i] = graph.in_range(i, least)
        links = [k[home[k]] for k in links]
        at_home = np.flatnonzero(home)
        for i in range(m, len(ids), 512) if len(at_home) else ():
            for k, r in enumerate(x[i : i + 512] @ x[at_home].T >= least, i):
                links[k] = at_home[r]
        low = ids[roots(len(ids), links)] if len(ids) else ids
        return pd.DataFrame({"vec_id": ids, "low": low, "links": [int(n[k].sum()) for k in links]})

    crowds = rows.where(F.col("role") == VISITOR).groupBy(at).agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts")).where("parts > 1")
    placed = rows.where(F.col("role") != EDGE).join(crowds, at, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    placed = placed.withColumn("part", F.explode(F.when(F.col("role") == VISITOR, F.array(F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))))
    asked = placed.join(united, "vec_id", "left").withColumn("nbrs", F.when(F.col("role") != VISITOR, F.col("nbrs")))
    found = stored(asked.select(*at, "part", "role", "vec_id", "n", "tight", "v", "nbrs").groupBy(*at, "part").applyInPandas(search, "vec_id long, low long, links long"), "found")
    settled = rows.where(F.col("role").isin(HOME, EDGE)).select("vec_id", "low", F.col("base").alias("links"))
    both = found.unionByName(settled)
    links = both.groupBy("vec_id").agg(F.sum("links").alias("links"))
    return links, both.where("vec_id <> low").select(F.col("vec_id").alias("a"), F.col("low").alias("b"))


def near_vectors(vectors: DataFrame, least: float = RANGE, target: int = 2048, most_centres: int = 1 << 15, deviations: float = 4.0, part_rows: int = 16_384, least_recall: float = 0.99, audit_rows: int = 1000) -> DataFrame:
    """vec_id, n_links, component_id and kept for every distinct vec_id of ``vectors`` (vec_id, embedding, label).

    Vectors of equal label link where their cosine is ``least`` or more. Vectors that are null, zero or hold null or
    non-finite components, and those of a null label, link with nothing; so do vectors of unequal lengths. Rows of one
    vec_id count as one (the smallest label and vector); a null vec_id gives a row with a null component, not
    kept. Equal vectors go on as one with their number. Other columns are not read. The links of ``audit_rows`` vectors,
    chosen by a hash, are held against brute force; below ``least_recall`` of them, all is done again with exact tests.
    """
    own = stored(usable(vectors), "vectors")
    key = F.xxhash64("v")
    groups = own.groupBy("label", "dim", key.alias("k1"), F.md5(F.concat_ws(",", F.col("v").cast("array<string>"))).alias("k2")).agg(F.min(F.struct("vec_id", "v")).alias("m"), F.count("*").alias("n"))
    groups = stored(groups.select("label", "dim", "k1", "k2", "m.vec_id", "n", "m.v"), "distinct")
    with_key = own.select("vec_id", "label", "dim", key.alias("k1"), F.md5(F.concat_ws(",", F.col("v").cast("array<string>"))).alias("k2"))
    of_group = stored(with_key.join(groups.select("label", "dim", "k1", "k2", F.col("vec_id").alias("rep"), "n"), ["label", "dim", "k1", "k2"]).select("vec_id", "rep", "n"), "groups")
    for exact in (False, True):
        links, edges = counted_links(groups, least, target, most_centres, None if exact else deviations, part_rows, exact)
        links = stored(of_group.join(links.withColumnRenamed("vec_id", "rep"), "rep").select("vec_id", "rep", (F.col("links") + F.col("n") - 1).alias("n_links")), "links")
        if exact or recall_of(own, links, least, audit_rows) >= least_recall:
            break
    comps = components(edges)
    result = links.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select("vec_id", "n_links", F.coalesce("component", "rep").alias("component"))
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    return every.join(result, "vec_id", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"), F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))


def recall_of(own: DataFrame, counted: DataFrame, least: float, rows: int) -> float:
    """The share of the links of ``rows`` vectors, chosen by a hash, that ``counted`` (vec_id, n_links) has; all vectors are looked at."""
    chosen = own.select("vec_id", "label", "dim", "v").orderBy(F.xxhash64(F.lit(3), "vec_id")).limit(rows).collect()
    by: dict = {}
    for r in chosen:
        by.setdefault((r.label, r.dim), []).append((r.vec_id, r.v))
    shared = own.sparkSession.sparkContext.broadcast({k: (np.array([i for i, _ in q]), unit([v for _, v in q])) for k, q in by.items()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = 0
        for b in batches:
            for key, part in keyed(b, 2048) if b.num_rows else ():
                if key in shared.value:
                    ids, q = shared.value[key]
                    hits += int(((q @ matrix(b.column("v"), part).T >= least) & (ids[:, None] != b.column("vec_id").to_numpy()[part][None])).sum())
        yield pa.RecordBatch.from_arrays([pa.array([hits])], ["hits"])

    total = own.select(F.col("label").cast("long"), "dim", "vec_id", "v").mapInArrow(count, "hits long").agg(F.sum("hits")).first()[0] or 0
    wanted = own.sparkSession.createDataFrame([(r.vec_id,) for r in chosen], "vec_id long")
    got = counted.join(F.broadcast(wanted), "vec_id").agg(F.sum("n_links")).first()[0] or 0
    return got / total if total else 1.0


def audited_recall(vectors: DataFrame, result: DataFrame, least: float = RANGE, rows: int = 1000) -> float:
    """The share of links that ``result`` counts, against brute force over all vectors, for ``rows`` vectors chosen by a hash."""
    return recall_of(usable(vectors), result, least, rows)
