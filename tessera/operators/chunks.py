"""From source texts to validated chunks."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TOKEN, contextual, stripped
from ..functions.vocab import LEVELS, SUBJECTS, cycle_of, label_of, levels_of_file

PAYLOAD = ["text", "source_file", "matiere", "niveau", "cycle", "section", "chunk_index"]
MIN_CHUNK, MIN_SECTION = 50, 200


def lines_of(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, line) of a text column."""
    return texts.select(*keys, F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def section_bounds(lines: DataFrame, keys: list[str], start: Column, end: Column | None, blank_after: bool = False) -> DataFrame:
    """(keys, first, stop): where a section begins and the line before which it ends.

    It begins at the first line that matches ``start`` (with a blank line or nothing after it if ``blank_after``, which
    passes over tables of contents) and ends before the first later line that matches ``end``, else with the text.
    """
    clean = F.regexp_replace(F.regexp_replace("line", r"^\f+", ""), r"(?U)\s+$", "")
    rows = lines.withColumn("clean", clean)
    begin = start
    if blank_after:
        rows = rows.withColumn("next", F.lead("line").over(Window.partitionBy(*keys).orderBy("pos")))
        begin = start & (stripped(F.coalesce("next", F.lit(""))) == "")
    marks = rows.groupBy(*keys).agg(
        F.min(F.when(begin, F.col("pos"))).alias("first"),
        F.sort_array(F.collect_list(F.when(end if end is not None else F.lit(False), F.col("pos")))).alias("ends"),
        F.max("pos").alias("last"))
    later = F.filter("ends", lambda p: p > F.col("first"))
    return marks.where(F.col("first").isNotNull()).select(*keys, "first", F.coalesce(F.get(later, F.lit(0)), F.col("last") + 1).alias("stop"))


def sections(texts: DataFrame, keys: list[str], start: Column, end: Column | None = None, blank_after: bool = False) -> DataFrame:
    """(keys, first, stop, text) of the section of each text that has one. ``start`` and ``end`` speak of column ``clean``."""
    bounds = section_bounds(lines_of(texts, keys), keys, start, end, blank_after)
    part = F.array_join(F.slice(F.split("text", "\n"), F.col("first") + 1, F.col("stop") - F.col("first")), "\n")
    return texts.join(bounds, keys).select(*keys, "first", "stop", part.alias("text"))


def guarded_sections(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (text, ...) with enough text, and the others with a reason: a section of fewer than 200 characters without the white
    space at its ends means that its pattern found the wrong place."""
    n = F.length(stripped(F.coalesce("text", F.lit(""))))
    marked = rows.withColumn("reason", F.when(n < MIN_SECTION, F.format_string("section of %d characters", n)))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def token_count(text: str) -> int:
    return len(re.findall(TOKEN, text.lower()))


#: What separates pieces, level by level, and whether it stays with the piece before it.
SEPARATORS = ((r"(?=\n###? )", False), (r"(?<=\n\n)", True), (r"(?<=\. )|(?<=! )|(?<=\? )", True), (r"(?<=\s)", True))


def split_text(text: str, size: int = 400, least: int = 100, count: Callable[[str], int] = token_count, level: int = 0) -> list[str]:
    """Pieces of at most ``size`` tokens whose concatenation is the text.

    Neighbouring pieces of a level are packed while they fit; one that is too large alone is split at the next level;
    a piece under ``least`` characters joins the one before it where it fits.
    """
    if count(text) <= size or level == len(SEPARATORS):
        return [text] if text else []
    out: list[str] = []
    held, n = "", 0
    for piece in re.split(SEPARATORS[level][0], text):
        c = count(piece)
        if held and n + c > size:
            out.append(held)
            held, n = "", 0
        if c > size:
            out += split_text(piece, size, least, count, level + 1)
        else:
            held, n = held + piece, n + c
    if held:
        out.append(held)
    merged: list[str] = []
    for piece in out:
        if merged and len(piece) < least and count(merged[-1]) + count(piece) <= size:
            merged[-1] += piece
        else:
            merged.append(piece)
    return merged


def pieces(texts: DataFrame, size: int = 400, least: int = 100, count: Callable[[str], int] = token_count) -> DataFrame:
    """``texts`` with a row for each piece that ``split_text`` makes: chunk_index and text. Joined in order they are the whole text."""
    @F.pandas_udf("array<string>")
    def cut(col: pd.Series) -> pd.Series:
        return col.map(lambda t: split_text(t, size, least, count) if t else [])

    rest = [c for c in texts.columns if c != "text"]
    return texts.select(*rest, F.posexplode(cut("text")).alias("chunk_index", "text"))


def chunked(texts: DataFrame, size: int = 400, least: int = 100, count: Callable[[str], int] = token_count) -> DataFrame:
    """The ``pieces`` that hold 50 characters or more without the white space at their ends.

    Others go after numbering, so numbers can have gaps. A null text has no chunks.
    """
    return pieces(texts, size, least, count).where(F.length(stripped(F.col("text"))) >= MIN_CHUNK)


def expanded(chunks: DataFrame, strict: bool = True) -> DataFrame:
    """A row for each level that a chunk's source file is for, with the level's cycle."""
    return chunks.withColumn("niveau", F.explode(levels_of_file(F.col("source_file"), strict))).withColumn("cycle", cycle_of(F.col("niveau")))


def fault() -> Column:
    """What is wrong with a chunk first, or null."""
    return (F.when(F.col("niveau").isNull() | ~F.col("niveau").isin(*LEVELS), "niveau")
            .when(F.col("text").isNull() | (F.length("text") < MIN_CHUNK), "text")
            .when(F.col("matiere").isNull() | ~F.col("matiere").isin(*SUBJECTS), "matiere")
            .when(F.col("chunk_index").isNull() | (F.col("chunk_index") < 0), "chunk_index"))


def validated(chunks: DataFrame) -> DataFrame:
    """The payload columns of valid chunks; the first invalid one is an error."""
    bad = fault()
    checked = chunks.withColumn("text", F.when(bad.isNotNull(), F.raise_error(F.concat(F.lit("invalid chunk: "), bad)).cast("string")).otherwise(F.col("text")))
    return payload(checked)


def payload(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("cycle", cycle_of(F.col("niveau"))).select(*PAYLOAD)


def divided(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid chunks, and the others with a reason."""
    marked = chunks.withColumn("reason", fault())
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def faceted(chunks: DataFrame, matiere: str | None = None, niveau: str | None = None, cycle: str | None = None) -> DataFrame:
    """The chunks of the given facets; one that is None or empty doesn't matter."""
    for column, value in (("matiere", matiere), ("niveau", niveau), ("cycle", cycle)):
        if value:
            chunks = chunks.where(F.col(column) == value)
    return chunks
