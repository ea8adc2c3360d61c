"""Coverage audit: which titles and how much text of the sources an index holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import HEADING, WHITE, mostly_upper, stripped, title_key, title_like, unwrapped
from ..session import settled
from .containment import held_terms


def titles(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, title, source): the section titles of each text in order, the first of equal ones in lower case.

    Headings of level 2 to 4 are titles of source markdown (3 to 100 characters). Other lines of 5 to 80 characters are
    titles of source heuristic where letters are mostly upper case or the lines around are blank.
    """
    rows = texts.select(*keys, F.split("text", "\n").alias("raw")).withColumn("blank", F.transform("raw", lambda x: stripped(x) == ""))
    rows = rows.withColumn("line", F.transform("raw", lambda x: F.ltrim(F.rtrim(x, F.lit(WHITE)), F.lit("\f"))))
    n, end = F.size("blank"), F.array(F.lit(True))
    rows = rows.withColumn("before", F.concat(end, F.slice("blank", F.lit(1), n - 1))).withColumn("after", F.concat(F.slice("blank", F.lit(2), n), end))
    rows = rows.withColumn("pos", F.sequence(F.lit(0), n - 1))
    # lines that can't be titles go while they are in the array: what follows costs much more, and Spark would do it for all
    short = lambda x: x["line"].startswith("##") | F.length(x["line"]).between(5, 80)
    rows = rows.select(*keys, F.explode(F.filter(F.arrays_zip("pos", "line", "before", "after"), lambda x: short(x) & title_like(x["line"]))).alias("x"))
    rows = rows.select(*keys, "x.pos", "x.line", (F.col("x.before") & F.col("x.after")).alias("alone"))
    heading = F.col("line").rlike(HEADING)
    rows = rows.withColumn("title", unwrapped(F.col("line")))
    marked = heading & F.length("title").between(3, 100)
    guessed = ~heading & F.length("line").between(5, 80) & (mostly_upper(F.col("line")) | F.col("alone")) & (F.length("title") >= 3)
    rows = rows.where(marked | guessed).withColumn("source", F.when(heading, "markdown").otherwise("heuristic"))
    first = Window.partitionBy(*keys, F.lower("title")).orderBy("pos")
    return rows.withColumn("n", F.row_number().over(first)).where("n = 1").select(*keys, "pos", "title", "source")


def occurrences(terms: DataFrame, texts: DataFrame, group: str, term: str) -> DataFrame:
    """(group, term, n): how often a term stands in the normalised texts of its group, parts of words included."""
    own = settled(terms.select(F.col(group).alias("g"), F.col(term).alias("term")).distinct().withColumn("k", title_key(F.col("term"))))
    held = held_terms(own, texts.select(F.col(group).alias("g"), title_key(F.col("text")).alias("text")))
    return own.join(held, ["g", "k"], "left").select(F.col("g").alias(group), F.col("term").alias(term), F.coalesce("n", F.lit(0)).alias("n"))


def covered_titles(wanted: DataFrame, texts: DataFrame, group: str, share: float = 0.7) -> DataFrame:
    """(group, title, source, covered) for titles (group, title, source) against all texts (group, text) of the group.

    A title of one distinct word is covered by 1 occurrence (markdown) or 3 (heuristic), parts of words included; any
    other where a text holds it, or ``share`` of its distinct words if it has three or more. A title without words is held by any text.
    """
    own = settled(wanted.select(F.col(group).alias("g"), "title", "source").distinct().withColumn("k", title_key(F.col("title"))))
    keyed = texts.select(F.col(group).alias("g"), title_key(F.coalesce("text", F.lit(""))).alias("text"))
    held = held_terms(own, keyed, share, count_all=False)
    some = keyed.select("g").distinct().withColumn("some", F.lit(True))
    rows = own.join(held, ["g", "k"], "left").join(some, "g", "left")
    one = (F.size(F.array_distinct(F.split("k", " "))) == 1) & (F.col("k") != "")
    need = F.when(F.col("source") == "markdown", 1).otherwise(3)
    inside = F.when(F.col("k") == "", F.col("some")).otherwise(F.col("inside"))
    return rows.select(F.col("g").alias(group), "title", "source", F.when(one, F.coalesce("n", F.lit(0)) >= need).otherwise(F.coalesce(inside, F.lit(False))).alias("covered"))


def coverage(sources: DataFrame, chunks: DataFrame, covered: DataFrame, group: str) -> DataFrame:
    """A row for each group: characters of source and index, titles, and both shares in percent with one decimal.

    Characters of chunks that several levels repeat all count, and the share stops at 100; text_distinct counts each
    text once.
    """
    s = sources.groupBy(group).agg(F.sum(F.length("text")).alias("source_chars"))
    # digests stand for equal texts, which don't travel
    each = chunks.groupBy(group, F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.max(F.length("text")).alias("once"))
    c = each.groupBy(group).agg(F.sum("n").alias("n_chunks"), F.sum("chars").alias("index_chars"), F.sum("once").alias("distinct_chars"))
    t = covered.groupBy(group).agg(F.count("*").alias("n_titles"), F.count_if("covered").alias("n_covered"))
    rows = s.join(c, group, "left").join(t, group, "left").fillna(0)

    def share(a: str, b: str):  # noqa: ANN202
        return F.when(F.col(b) > 0, F.round(F.least(F.lit(100.0), 100.0 * F.col(a) / F.col(b)), 1)).otherwise(0.0)

    return rows.select(group, "source_chars", "index_chars", "n_chunks", "n_titles", "n_covered", share("index_chars", "source_chars").alias("text_pct"), share("distinct_chars", "source_chars").alias("text_distinct_pct"), share("n_covered", "n_titles").alias("titles_pct"))


def report(rows: DataFrame, group: str) -> DataFrame:
    """(group, line): a row of a Markdown table for each group, with a word on text (80 %) and titles (70 and 50 %)."""
    text = F.when(F.col("text_pct") >= 80, "ok").otherwise("low")
    title = F.when(F.col("titles_pct") >= 70, "ok").when(F.col("titles_pct") >= 50, "warn").otherwise("fail")
    cells = [F.col(group), F.col("n_chunks").cast("string"), F.format_string("%.1f %%", "text_pct"), text, F.format_string("%d/%d", "n_covered", "n_titles"), title]
    return rows.select(group, F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def missing_titles(covered: DataFrame, group: str, shown: int = 4) -> DataFrame:
    """(group, missing): the first titles that are not covered, and how many more there are."""
    lost = covered.where(~F.col("covered")).groupBy(group).agg(F.sort_array(F.collect_set("title")).alias("m"))
    more = F.size("m") - shown
    return lost.select(group, F.concat(F.array_join(F.slice("m", 1, shown), ", "), F.when(more > 0, F.format_string(", … %d more", more)).otherwise("")).alias("missing"))
