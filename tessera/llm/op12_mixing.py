"""Mixing sources to target weights by a tree of multivariate hypergeometric splits.

A source's documents stand in an order by hash; its words in that order are cut into blocks of equal size, of which the
source's target takes an exact number, the last one in part. The quotas of all sources are dealt to output shards by a
tree: a node's blocks are split between its halves as a draw without replacement, so that every shard has the
same number of blocks and every source its quota to the block. A shard draws its blocks of a source from a permutation of them,
a range of its own, and shuffles what it drew. Passes over a source are permuted anew.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import numbered, stored

WEIGHTS, SHARE, MOST_PASSES = (5, 2, 1), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, blocks of a shard; blocks grow where there would be more than MOST_BLOCKS.
BLOCK, PER_SHARD, MOST_BLOCKS = 4096, 1024, 500_000_000
#: Children of a node in one task: sub-nodes of the shards' tree, and bits of a group of sources.
FAN_OUT, GROUP_BITS = 64, 10
COPIES = 65_536


def before(size: Column | str, keys: list[str], order: str) -> Column:
    """The sum of ``size`` over the rows of the same ``keys`` that come before."""
    return F.coalesce(F.sum(size).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def kinds_of(docs: DataFrame, seed: int) -> DataFrame:
    """(g, bucket, h, doc_id, size, m): the distinct rows with their number, hashed; ``g`` sorts as the sources do, null last."""
    g = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~")).alias("g")
    rows = docs.select(g, "doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    return rows.groupBy("g", "h", "doc_id", "size").agg(F.count("*").alias("m")).withColumn("bucket", F.shiftright("h", 48))


def with_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> DataFrame:
    """``sources`` (place, total) with ``target``: ``share`` of all words by weight, at most ``most`` times the total.

    What is over goes to the others by weight until none is above: each round finds the words a unit of weight gets
    from the sums over those that are not full, and ends when no more are.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows, cap = sources.withColumn("weight", weight), F.col("total") * float(most)
    n, words, unit, full = *rows.agg(F.count("*"), F.sum("total")).first(), math.inf, None
    if not n:
        return rows.withColumn("target", F.lit(0.0)).drop("weight")
    budget, unit = share * words, None
    while True:
        over = F.lit(False) if unit is None else F.col("weight") * unit > cap
        now, taken, free = rows.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if now == full or not free:
            break
        full, unit = now, (budget - taken) / free
    return rows.withColumn("target", F.least(F.col("weight") * F.lit(unit), cap)).drop("weight")


PLAN = "place long, g string, total long, target double, blocks long, quota long, cut long, steps array<struct<a:long,c:long>>"


def planned(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """The plan of each source (place, g, total, target): its blocks, how many draws meet its target to the word, what the last
    draw leaves of its block, and the permutation of each pass, (a * i + c) mod blocks."""

    def plan(place: int, total: int, target: float) -> tuple[int, int, int, list[dict[str, int]]]:
        want = min(round(target), 2**62)
        if not total or not want:
            return 0, 0, 0, []
        n, passes = -(-total // block), want // total
        short = n * block - total  # words that the last block lacks
        steps = []
        for e in range(passes + 1):
            rng = np.random.default_rng([seed, place, e])
            a, c = int(rng.integers(1, n + 1)), int(rng.integers(n))
            while math.gcd(a, n) != 1:
                a = a % n + 1
            steps.append({"a": a % n if n > 1 else 0, "c": c})
        rest = want - passes * total
        q = -(-rest // block)
        if q:
            at = (n - 1 - steps[-1]["c"]) * pow(steps[-1]["a"], -1, n) % n if n > 1 else 0
            if at < q:  # the short block is drawn in the last pass
                q = -(-(rest + short) // block)
                cut = q * block - short - rest
            else:
                cut = q * block - rest
        else:
            cut = 0
        return n, passes * n + q, cut, steps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            plans = [plan(r["place"], r["total"], r["target"]) for r in rows]
            yield pa.RecordBatch.from_pylist([r | dict(zip(("blocks", "quota", "cut", "steps"), p, strict=True)) for r, p in zip(rows, plans, strict=True)], schema=pa.schema([("place", pa.int64()), ("g", pa.string()), ("total", pa.int64()), ("target", pa.float64()), ("blocks", pa.int64()), ("quota", pa.int64()), ("cut", pa.int64()), ("steps", pa.list_(pa.struct([("a", pa.int64()), ("c", pa.int64())])))]))

    return sources.select("place", "g", "total", "target").mapInArrow(run, PLAN)


def halves(rng: np.random.Generator, counts: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """A table with rows that sum to ``counts`` and columns that sum to ``caps``: what goes to the left half of the columns is
    a multivariate hypergeometric draw, and each half is split further."""
    if len(caps) == 1:
        return counts[:, None]
    mid = len(caps) // 2
    left = rng.multivariate_hypergeometric(counts, int(caps[:mid].sum()), method="marginals")
    return np.hstack([halves(rng, left, caps[:mid]), halves(rng, counts - left, caps[mid:])])


def splitter(seed: int, stage: int, level: int, capacity: Callable[[int], np.ndarray] | None) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Deals the counts of a group of children in a node to its sub-nodes; ``capacity`` gives those of a node at the top."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("child")
        node, parent = int(rows.node.iloc[0]), int(rows.parent.iloc[0])
        caps = capacity(node) if capacity else np.asarray(rows.caps.iloc[0], np.int64)
        table = halves(np.random.default_rng([seed, stage, level, node, parent]), rows.n.to_numpy(np.int64), caps)
        return pd.DataFrame({"node": rows.node, "child": rows.child, "caps": list(table)})

    return run


def dealt(quotas: DataFrame, n: int, blocks: int, shards: int, seed: int, fan_out: int = FAN_OUT, bits: int = GROUP_BITS) -> DataFrame:
    """(shard, place, q): the quotas (place, quota) of ``n`` sources, ``blocks`` together, over ``shards`` of equal size.

    Every stage deals a node to ``fan_out`` sub-nodes. Where there are over 2^bits sources, groups of them are dealt first and
    then what is in a group, so that a task has a table of 2^bits by ``fan_out`` at most.
    """
    heights = max(1, math.ceil(math.log(max(n, 2), 1 << bits) - 1e-9))
    stages = max(1, math.ceil(math.log(max(shards, 2), fan_out) - 1e-9))
    cells = quotas.select(F.lit(0).cast("long").alias("node"), F.col("place").alias("child"), F.col("quota").alias("n"))
    for stage in range(stages):
        width = fan_out ** (stages - stage - 1)

        def capacity(node: int, width=width) -> np.ndarray:
            edges = [min((node * fan_out + i) * width, shards) * blocks // shards for i in range(fan_out + 1)]
            return np.diff(np.array(edges, np.int64))

        held: DataFrame | None = None
        for level in reversed(range(heights)):
            low = cells.groupBy("node", F.shiftright("child", bits * level).alias("child")).agg(F.sum("n").alias("n")).withColumn("parent", F.shiftright("child", bits))
            if held is not None:
                low = low.join(held.select("node", F.col("child").alias("parent"), "caps"), ["node", "parent"])
            held = low.groupBy("node", "parent").applyInPandas(splitter(seed, stage, level, None if held is not None else capacity), "node long, child long, caps array<long>")
        each = held.select("node", "child", F.posexplode("caps").alias("i", "n")).where("n > 0")
        cells = stored(each.select((F.col("node") * fan_out + F.col("i")).alias("node"), "child", "n"), f"shards{stage}")
    return cells.select(F.col("node").alias("shard"), F.col("child").alias("place"), F.col("n").alias("q"))


@dataclass
class Mix:
    """What a mix takes: ``rows`` (doc_id, key, size, place, start, total, target) are the documents in their sources'
    orders, ``spans`` (shard, slot, pass, place, doc_start, doc_id, key, first, words) the runs of their words."""

    rows: DataFrame
    spans: DataFrame


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES, seed: int = 12, block: int = BLOCK, per_shard: int = PER_SHARD, **tree) -> Mix:
    """The mix of ``docs`` (doc_id, text, source).

    A null text has no words; a null source is a source, after all others; null ids and repeated rows are documents of their own. Words are counted in
    whole texts. A source takes its target, rounded to a word; a document cut by the border of a block is taken from
    both, and a document's words come as often as its source is passed over. Other columns are not read. An
    empty table gives no rows and no spans. The order is by hash of id and text, so that runs agree.
    """
    seen = Observation()
    kinds = stored(kinds_of(docs, seed).observe(seen, F.sum(F.col("m") * F.col("size")).alias("words")), "mix-kinds")
    block = max(block, math.ceil(share * (seen.get["words"] or 0) / MOST_BLOCKS))
    buckets = kinds.groupBy("g", "bucket").agg(F.sum(F.col("m") * F.col("size")).alias("words"))
    sources = numbered(buckets.groupBy("g").agg(F.sum("words").alias("total")), "g", name="mix-sources")
    sums = Observation()
    plan = stored(planned(with_targets(sources, weights, share, most), block, seed).observe(sums, F.count("*").alias("n"), F.sum("quota").alias("blocks")), "mix-plan")
    at = buckets.withColumn("at", before("words", ["g"], "bucket")).join(plan.select("g", "place", "total", "target"), "g").drop("words")
    own = kinds.withColumn("own", before(F.col("m") * F.col("size"), ["g", "bucket"], "h")).join(at, ["g", "bucket"])
    steps = own.withColumn("step", F.explode(F.expr(f"sequence(0L, (m - 1) div {COPIES})")))
    each = steps.withColumn("copy", F.explode(F.expr(f"sequence(step * {COPIES}, least(m, (step + 1) * {COPIES}) - 1)")))
    rows = stored(each.select("doc_id", F.col("h").alias("key"), "size", "place", (F.col("at") + F.col("own") + F.col("copy") * F.col("size")).alias("start"), "total", "target"), "mix-rows")

    n, blocks = sums.get["n"] or 0, sums.get["blocks"] or 0
    quotas = dealt(plan.where("quota > 0").select("place", "quota"), n, blocks, max(1, -(-blocks // per_shard)), seed, **tree)
    drawn = quotas.withColumn("first", before("q", ["place"], "shard")).join(plan, "place").withColumn("i", F.explode(F.expr("sequence(first, first + q - 1)")))
    drawn = drawn.withColumn("pass", F.expr("i div blocks")).withColumn("step", F.expr("steps[cast(pass AS int)]"))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "place", "i"), "place", "i")
    drawn = drawn.select("shard", F.row_number().over(local).alias("slot"), "pass", "place", F.expr("(step.a * (i % blocks) + step.c) % blocks").alias("block"), F.expr("CASE WHEN i = quota - 1 THEN cut ELSE 0L END").alias("cut"), "total")
    drawn = drawn.select("shard", "slot", "pass", "place", "block", F.expr(f"least((block + 1) * {block}, total) - cut").alias("stop"))

    pieces = rows.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    met = pieces.join(drawn, ["place", "block"]).withColumn("from", F.expr(f"greatest(start, block * {block})"))
    met = met.withColumn("words", F.expr(f"least(start + size, (block + 1) * {block}, stop) - from")).where("words > 0")
    return Mix(rows, met.select("shard", "slot", "pass", "place", F.col("start").alias("doc_start"), "doc_id", "key", (F.col("from") - F.col("start")).alias("first"), "words"))


def taken(mix: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document: how many words of it the mix takes, repeats counted."""
    sums = mix.spans.groupBy("place", F.col("doc_start").alias("start")).agg(F.sum("words").alias("taken"))
    cols = ["doc_id", "size", F.col("total").alias("source_size"), "target"]
    full = mix.rows.where("size > 0").join(sums, ["place", "start"], "left").select(*cols, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return full.unionByName(mix.rows.where("size = 0").select(*cols, F.lit(0).cast("long").alias("taken")))


def shard_texts(docs: DataFrame, mix: Mix, seed: int = 12) -> DataFrame:
    """(shard, slot, doc_id, text) of the spans, a shard in one partition and in the order it shuffled to."""
    texts = docs.select(F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"), "text").dropDuplicates(["key"])
    words = F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), (F.col("first") + 1).cast("int"), F.col("words").cast("int"))
    out = mix.spans.join(texts, "key").select("shard", "slot", "doc_start", "doc_id", F.array_join(words, " ").alias("text"))
    return out.repartition("shard").sortWithinPartitions("shard", "slot", "doc_start").drop("doc_start")
