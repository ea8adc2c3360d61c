"""Merkle manifest of a dataset: a tree for each source, and one over the sources.

A leaf's place among its source's leaves comes from bitmaps: the ids of a source are bits of 64-bit words, 64 words are
a container that leaves empty words out and counts the ids before each word, and containers are summed up in a
directory of three levels. A row's place is the directory's sum, the count before its word and the bits below its
own; rows are never sorted. Runs of nodes are arrays keyed by (tree, run), one slot for each node; a level's runs
hash to the nodes of the next. Proofs are built from the root down, a step for each run, and meet the
rows only in the arrays of the lowest level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import numbered, stored

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a null id count as a container of their own before all others.
NULLS = -(1 << 51) - 1
#: Copies of one row are made in steps of so many.
COPIES = 65_536


def digest_of(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field of a leaf: its bytes' count, a colon and the value; a null is a hyphen."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    """The digest of a row's fields, some of which may be replaced."""
    return digest_of(*(field(changed.get(c, F.col(c))) for c in FIELDS))


def leaves(docs: DataFrame, seen: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, seen) of each row; ``seen`` is what a reader finds in its place (the leaf itself by default).

    ``tree`` is a hyphen for a null source, or an equals sign and the source, so that its order is that of the sources.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("tree")
    own = docs.withColumn("_leaf", leaf_of())
    return own.select(tree, "doc_id", F.col("_leaf").alias("leaf"), (F.col("_leaf") if seen is None else F.coalesce(seen, F.col("_leaf"))).alias("seen"))


def before(size: str, keys: list[str], order: str) -> Column:
    """The sum of ``size`` over the rows of the same ``keys`` that come before."""
    return F.coalesce(F.sum(size).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def directory(containers: DataFrame) -> DataFrame:
    """(tree, c, at, total): the rows before each container (tree, c, n), and those of its whole tree.

    Sums go up by 16 bits of the container's number at a time, so that no group has over 65,536 rows (at the top a million,
    one for each 2^44 ids).
    """
    mid = containers.groupBy("tree", F.shiftright("c", 16).alias("c2")).agg(F.sum("n").alias("n2"))
    top = mid.groupBy("tree", F.shiftright("c2", 16).alias("c3")).agg(F.sum("n2").alias("n3"))
    top = top.select("tree", "c3", before("n3", ["tree"], "c3").alias("at3"), F.sum("n3").over(Window.partitionBy("tree")).alias("total"))
    mid = mid.withColumn("c3", F.shiftright("c2", 16)).withColumn("at2", before("n2", ["tree", "c3"], "c2")).join(top, ["tree", "c3"])
    low = containers.select("tree", "c", "n").withColumn("c2", F.shiftright("c", 16)).withColumn("at1", before("n", ["tree", "c2"], "c")).join(mid, ["tree", "c2"])
    return low.select("tree", "c", (F.col("at1") + F.col("at2") + F.col("at3")).alias("at"), "total")


def bitmaps(words: DataFrame, ties: DataFrame | None) -> DataFrame:
    """(tree, c, present, words, counts, ties, at, total): the containers of 64 words, with their directory.

    ``present`` has a bit for each word that is not empty, ``words`` are those, ``counts`` the rows before each; ``ties`` the
    ids of more than one row, with how many more.
    """
    held = words.groupBy("tree", "c").agg(F.sort_array(F.collect_list(F.struct("k", "bits", "n"))).alias("w"), F.sum("n").alias("n"), F.expr("bit_or(shiftleft(1L, k))").alias("present"))
    held = held.select("tree", "c", "n", "present", F.expr("transform(w, x -> x.bits)").alias("words"), F.expr("transform(w, (x, i) -> aggregate(slice(w, 1, i), 0L, (s, y) -> s + y.n))").alias("counts"))
    out = held.join(directory(held), ["tree", "c"]).drop("n")
    none = F.expr("CAST(array() AS array<struct<low:int,more:bigint>>)")
    if ties is None:
        return out.withColumn("ties", none)
    listed = ties.groupBy("tree", "c").agg(F.collect_list(F.struct("low", (F.col("m") - 1).alias("more"))).alias("ties"))
    return out.join(listed, ["tree", "c"], "left").withColumn("ties", F.coalesce("ties", none))


#: The place in ``words`` of a row's word, and the rows before the row's id.
RANK = """at + element_at(counts, i) + bit_count(element_at(words, i) & ~shiftleft(-1L, low & 63))
 + CASE WHEN size(ties) = 0 THEN 0L ELSE aggregate(filter(ties, t -> t.low < low AND shiftright(t.low, 6) = shiftright(low, 6)), 0L, (s, t) -> s + t.more) END"""


def placed(rows: DataFrame) -> DataFrame:
    """(tree, pos, n, leaf, doc_id, seen): each leaf's place in its tree of ``n``, by ascending id (nulls first).

    Rows of one source and id go by leaf. They are counted by the first four letters of the leaf and then within
    those, and rows that are equal in all fields are made from their count, so a group of any size is dealt out.
    """
    rows = rows.select("*", F.coalesce(F.shiftright("doc_id", 12), F.lit(NULLS)).alias("c"), F.coalesce(F.col("doc_id").bitwiseAND(4095).cast("int"), F.lit(0)).alias("low"))
    word = F.shiftright("low", 6).alias("k")
    seen = Observation()
    words = rows.groupBy("tree", "c", word).agg(F.expr("bit_or(shiftleft(1L, low & 63))").alias("bits"), F.count("*").alias("n"))
    words = stored(words.observe(seen, F.sum(F.col("n") - F.bit_count("bits")).alias("tied")), "bitmap-words")
    if not seen.get["tied"]:
        return ranked(rows, bitmaps(words, None), F.lit(0))
    key = ["tree", "c", "low"]
    shared = words.where(F.col("n") > F.bit_count("bits")).select("tree", "c", "k")
    kinds = rows.withColumn("k", word).join(shared, ["tree", "c", "k"], "left_semi").groupBy(*key, "doc_id", "leaf", "seen").agg(F.count("*").alias("m"))
    kinds = stored(kinds, "tied-leaves")
    ties = stored(kinds.groupBy(*key).agg(F.sum("m").alias("m")).where("m > 1"), "tied-ids")
    start = F.substring("leaf", 1, 4).alias("start")
    tied = kinds.join(ties.select(*key), key).select("*", start)
    starts = tied.groupBy(*key, "start").agg(F.sum("m").alias("n")).withColumn("first", before("n", key, "start")).drop("n")
    tied = tied.withColumn("next", before("m", [*key, "start"], "leaf")).join(starts, [*key, "start"])
    copies = tied.withColumn("step", F.explode(F.expr(f"sequence(0L, (m - 1) div {COPIES})"))).repartition("tree", "c", "low", "leaf", "step")
    copies = copies.withColumn("copy", F.explode(F.expr(f"sequence(step * {COPIES}, least(m, (step + 1) * {COPIES}) - 1)")))
    held = stored(bitmaps(words, ties), "bitmaps")
    single = ranked(rows.join(ties.select(*key), key, "left_anti"), held, F.lit(0))
    return single.unionByName(ranked(copies, held, F.col("first") + F.col("next") + F.col("copy")))


def ranked(rows: DataFrame, held: DataFrame, more: Column) -> DataFrame:
    """The rows with their place: a lookup in their id's container, and ``more``."""
    at = rows.join(held, ["tree", "c"]).withColumn("i", F.expr("1 + bit_count(present & ~shiftleft(-1L, shiftright(low, 6)))"))
    return at.select("tree", (F.expr(RANK) + more).alias("pos"), F.col("total").alias("n"), F.col("leaf").alias("digest"), "doc_id", "seen")


def slots(nodes: DataFrame, fan_out: int, payload: tuple[str, ...] = ()) -> DataFrame:
    """(tree, run, n, slots, node): the runs of a level's nodes (tree, pos, n, digest) and their own digests.

    A tree of one node is done: its run's digest is the node's.
    """
    runs = nodes.groupBy("tree", F.expr(f"pos div {fan_out}").alias("run"), "n").agg(F.sort_array(F.collect_list(F.struct((F.col("pos") % fan_out).cast("int").alias("slot"), "digest", *payload))).alias("slots"))
    return runs.withColumn("node", F.expr("CASE WHEN n = 1 THEN slots[0].digest ELSE sha2(array_join(transform(slots, s -> s.digest), ''), 256) END"))


def levels(nodes: DataFrame, fan_out: int, payload: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The stored runs of each level, the lowest first, and the roots (tree, digest, height)."""
    out, roots, cur = [], None, nodes
    while True:
        seen = Observation()
        held = stored(slots(cur, fan_out, payload if not out else ()).observe(seen, F.max("n").alias("n")), f"merkle-level{len(out)}")
        out.append(held)
        up = held.select("tree", F.col("run").alias("pos"), F.expr(f"(n + {fan_out - 1}) div {fan_out}").alias("n"), F.col("node").alias("digest"))
        done = up.where("n = 1").select("tree", "digest", F.lit(len(out)).alias("height"))
        roots = done if roots is None else roots.unionByName(done)
        if (seen.get["n"] or 0) <= fan_out:
            return out, roots
        cur = up.where("n > 1")


def paths(runs: list[DataFrame], roots: DataFrame, fan_out: int) -> DataFrame:
    """(tree, pos, item, path, subroot) of the lowest level's nodes: the siblings before and after, from there up to the root.

    ``roots`` (tree, height, path, subroot) have the path above each tree.
    """
    step = F.expr("struct(array_join(transform(slice(slots, 1, i), s -> s.digest), '') AS before, array_join(transform(slice(slots, i + 2, size(slots)), s -> s.digest), '') AS after)")
    nodes: DataFrame | None = None
    for k in reversed(range(len(runs))):
        above = roots.where(F.col("height") == k + 1).select("tree", F.lit(0).cast("long").alias("run"), "path", "subroot")
        if nodes is not None:
            above = above.unionByName(nodes.select("tree", F.col("pos").alias("run"), "path", "subroot"))
        each = runs[k].join(above, ["tree", "run"]).select("tree", "run", "n", "slots", "path", "subroot", F.posexplode("slots").alias("i", "item"))
        own = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(F.array(step), F.col("path")))
        nodes = each.select("tree", (F.col("run") * fan_out + F.col("i")).alias("pos"), "item", own.alias("path"), "subroot")
    return nodes


@dataclass
class Manifest:
    """The levels of all sources' trees and of the tree over them, as stored tables."""

    sources: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    over: DataFrame
    fan_out: int

    def root(self) -> str | None:
        """The digest over all sources; None for an empty table."""
        row = self.over.first()
        return row.digest if row else None

    def proofs(self) -> DataFrame:
        """(tree, pos, doc_id, leaf, seen, path, subroot) of every row: a step of the path has the siblings before and after."""
        empty = F.expr("CAST(array() AS array<struct<before:string,after:string>>)")
        start = self.over.select("tree", "height", empty.alias("path"), F.lit(None).cast("string").alias("subroot"))
        above = paths(self.top, start, self.fan_out).select(F.col("pos").alias("place"), "path")
        roots = self.subroots.join(above, "place").select("tree", "height", "path", F.col("digest").alias("subroot"))
        own = paths(self.sources, roots, self.fan_out)
        return own.select("tree", "pos", F.col("item.doc_id").alias("doc_id"), F.col("item.digest").alias("leaf"), F.col("item.seen").alias("seen"), "path", "subroot")


def manifest(docs: DataFrame, seen: Column | None = None, fan_out: int = FAN_OUT) -> Manifest:
    """The trees of ``docs`` (doc_id, source, lang, n_chars, text).

    ``seen`` is the digest of what a reader finds in a row's place, null for the leaf itself. Nulls in any column are hyphens
    in the leaf; a null source is a source, before all others, and a null doc_id stands before all ids of its source.
    Rows of one source and id are told apart by their leaf; equal rows are leaves of their own. Texts are hashed
    whole, other columns are not read. An empty table has no root.
    """
    rows = stored(leaves(docs, seen), "leaves")
    sources, subroots = levels(placed(rows), fan_out, ("doc_id", "seen"))
    subroots = stored(numbered(subroots, "tree", name="subroots"), "subroots")
    n = subroots.count()
    top, over = levels(subroots.select(F.lit("").alias("tree"), F.col("place").alias("pos"), F.lit(n).cast("long").alias("n"), "digest"), fan_out)
    return Manifest(sources, subroots, top, over, fan_out)


def verified(docs: DataFrame, seen: Column | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: the proof's siblings hashed together,
    and the root that ``seen`` and the siblings lead to."""
    made = manifest(docs, seen, fan_out)
    rows = made.proofs().withColumn("root", F.lit(made.root()))
    siblings = F.expr("sha2(array_join(transform(path, p -> concat(p.before, p.after)), ''), 256)")
    folded = F.expr("aggregate(path, seen, (d, p) -> sha2(concat(p.before, d, p.after), 256))")
    out = rows.select("doc_id", "leaf", "subroot", "root", siblings.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case, and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audited(docs: DataFrame, every: int = 5) -> DataFrame:
    """``verified`` where every fifth row by its id's CRC-32 was tampered with: its text went to lower case."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return verified(docs, F.when(hit, leaf_of(text=lowered(F.col("text")))))
