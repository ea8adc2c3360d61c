"""Change detection against a saved state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import short_digest
from ..session import settled

STATE = "resource_id string, checksum string"


def resources(raw: DataFrame) -> DataFrame:
    """``raw`` (resource_id, url, checksum, ...) with missing ids and checksums made from the URL."""
    digest = short_digest(F.coalesce("url", F.lit("")))
    return raw.withColumn("resource_id", F.coalesce("resource_id", digest)).withColumn("checksum", F.coalesce(F.nullif("checksum", F.lit("")), digest))


def is_unchanged(last_modified: str | None, state_modified: str | None, force: bool = False) -> bool:
    """Whether a run can stop because the data set is as it was."""
    return not force and last_modified == state_modified


def changed(current: DataFrame, known: DataFrame, force: bool = False) -> DataFrame:
    """The resources whose id and checksum are not both known; all of them if ``force``."""
    return current if force else current.join(known.select("resource_id", "checksum"), ["resource_id", "checksum"], "left_anti")


def next_state(known: DataFrame, current: DataFrame, order: str | None = None) -> DataFrame:
    """The state after a run: the newest checksum of each resource."""
    both = known.select("resource_id", "checksum").withColumn("_n", F.lit(-1).cast("long"))
    new = current.select("resource_id", "checksum", (F.col(order).cast("long") if order else F.lit(0).cast("long")).alias("_n"))
    return both.unionByName(new).groupBy("resource_id").agg(F.max_by("checksum", F.struct("_n", "checksum")).alias("checksum"))


def unseen(items: DataFrame, seen: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first by ``order`` of the items of each key that is not in ``seen``; forcing a run doesn't change this."""
    first = Window.partitionBy(key).orderBy(*order)
    return items.join(seen.select(key).distinct(), key, "left_anti").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def change_feed(datasets: DataFrame | None, gazette: DataFrame | None) -> DataFrame:
    """Change records of one or both kinds as one table; fields of the other kind are null."""
    named = [rows.withColumn("source", F.lit(kind)) for rows, kind in ((datasets, "dataset"), (gazette, "gazette")) if rows is not None]
    return named[0] if len(named) == 1 else named[0].unionByName(named[1], allowMissingColumns=True)


#: What marks a part of a gazette as one on education, and its texts as ones on programmes (the last in lower case).
ON_EDUCATION, ON_TEACHING, PROGRAMME = "ducation", "enseignement", "programme"


def nested_texts(issues: DataFrame, marks: tuple[str, str] = (ON_EDUCATION, ON_TEACHING), word: str = PROGRAMME) -> DataFrame:
    """(jorftext_id, titre, jo_titre): the texts on programmes in gazette issues (jo_titre, content), whose content is JSON.

    An issue has items, each with a tree of parts (``tms``) that hold links to texts (``liensTxt``). A part's mark, a title
    that holds the first of ``marks``, or the second in lower case, goes on to all parts below it. A level of the trees is one
    step over all issues, to any depth. Content that is no JSON, and parts of another form, hold nothing.
    """
    def titled(part: Column) -> Column:
        return F.coalesce(F.try_variant_get(part, "$.titre", "string"), F.lit(""))

    def parts(of: Column, path: str) -> Column:
        return F.explode(F.try_variant_get(of, path, "array<variant>"))

    def marked(part: Column) -> Column:
        return titled(part).contains(marks[0]) | F.lower(titled(part)).contains(marks[1])

    items = issues.select("jo_titre", parts(F.try_parse_json("content"), "$.items").alias("item"))
    level = items.select("jo_titre", parts(F.col("item"), "$.joCont.structure.tms").alias("part")).withColumn("on", marked(F.col("part")))
    out = None
    while True:
        level = settled(level.select("jo_titre", F.to_json("part").alias("part"), "on")).withColumn("part", F.parse_json("part"))
        links = level.where("on").select("jo_titre", parts(F.col("part"), "$.liensTxt").alias("link"))
        texts = links.select(F.coalesce(F.try_variant_get("link", "$.id", "string"), F.lit("")).alias("jorftext_id"), titled(F.col("link")).alias("titre"), "jo_titre").where(F.lower("titre").contains(word))
        out = texts if out is None else out.unionByName(texts)
        below = level.select("jo_titre", "on", parts(F.col("part"), "$.tms").alias("part"))
        if below.isEmpty():
            return out
        level = below.withColumn("on", F.col("on") | marked(F.col("part")))


def programme_texts(tree: DataFrame, key: str, parent: str, title: str) -> DataFrame:
    """The texts of a tree (rows of key, parent, title, kind) below a node on education or teaching whose title speaks of a programme.

    A node's mark is that of any node above it, at any depth: each round doubles the steps that a row looks up, until all have
    reached a root. Nodes that no root leads to (a missing parent, a circle) are left out.
    """
    name = F.coalesce(title, F.lit(""))
    on_education = name.contains("ducation") | F.lower(name).contains("enseignement")
    nodes = tree.withColumn("_own", (F.col("kind") != "text") & on_education)
    up = settled(nodes.select(F.col(key).alias("_node"), F.col(parent).alias("_above"), F.col("_own").alias("_marked")))
    for _ in range(max(1, up.count()).bit_length()):
        climbing = up.where(F.col("_above").isNotNull())
        if climbing.isEmpty():
            break
        above = up.select(F.col("_node").alias("_above"), F.col("_above").alias("_next"), F.col("_marked").alias("_over"))
        moved = climbing.join(above, "_above").select("_node", F.col("_next").alias("_above"), (F.col("_marked") | F.col("_over")).alias("_marked"))
        up = settled(up.where(F.col("_above").isNull()).unionByName(moved))
    marked = up.where(F.col("_above").isNull() & F.col("_marked")).select(F.col("_node").alias(key))
    return tree.where((F.col("kind") == "text") & F.lower(name).contains("programme")).join(marked, key, "left_semi").select(key, title)
