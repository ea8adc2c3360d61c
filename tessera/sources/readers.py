"""Readers: whole texts, the catalog of sources, question files, state, and file checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import stripped
from .state import read_state  # noqa: F401 - read here before

CATALOG = "file string, matiere string, section_pattern string, section_end string, blank_line_after_header boolean, section_name string"
#: Formats of a source text, the preferred one first.
FORMATS = (".md", ".txt")


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, text): one row per source, from its preferred format; bytes that are no UTF-8 become U+FFFD."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.(?:md|txt)$", 1)
    rank = F.when(F.col("path").endswith(FORMATS[0]), 0).otherwise(1)
    best = Window.partitionBy("source_file").orderBy("rank", "path")
    rows = raw.where(F.col("path").rlike(r"\.(md|txt)$")).select(name.alias("source_file"), rank.alias("rank"), "path", "content")
    return rows.withColumn("n", F.row_number().over(best)).where("n = 1").select("source_file", stripped(F.make_valid_utf8(F.col("content").cast("string"))).alias("text"))


def multi_subject_sources(spark: SparkSession, file: str, order: list[tuple[str | None, str]], exclude: frozenset[str] = frozenset()) -> DataFrame:
    """Catalog rows for a file that holds a section per subject under ``## **label**`` headings, in this order.

    A section ends at the first of all later labels, also of subjects that are left out (None or in ``exclude``).
    """
    rows = []
    for i, (subject, label) in enumerate(order):
        if subject is None or subject in exclude:
            continue
        later = "|".join(re.escape(x) for _, x in order[i + 1 :])
        rows.append((file, subject, rf"^## \*\*{re.escape(label)}\*\*", rf"^## \*\*(?:{later})\*\*" if later else None, False, label))
    return spark.createDataFrame(rows, CATALOG)


def whole_file_sources(spark: SparkSession, entries: list[tuple[str, str, str]]) -> DataFrame:
    """Catalog rows (file, subject, section name) for files of one subject."""
    return spark.createDataFrame([(f, m, None, None, False, s) for f, m, s in entries], CATALOG)


def chosen_sources(catalog: DataFrame, subject: str | None) -> DataFrame:
    """The sources of a subject, or all; an unknown subject is an error that lists those there are."""
    if not subject:
        return catalog
    own = catalog.where(F.col("matiere") == subject)
    if own.isEmpty():
        known = [r[0] for r in catalog.select("matiere").distinct().orderBy("matiere").collect()]
        raise ValueError(f"unknown subject {subject}; there are {', '.join(known)}")
    return own


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Questions of a JSON list; an older ``question`` field stands in for a missing ``query``."""
    raw = spark.read.option("multiLine", "true").json(path)
    if "question" not in raw.columns:
        return raw
    query = F.coalesce(F.col("query"), F.col("question")) if "query" in raw.columns else F.col("question")
    return raw.withColumn("query", query).drop("question")


def indexed_texts(index: DataFrame, subject: str | None = None) -> DataFrame:
    """(matiere, text) of an index; empty texts go, and a missing subject is called inconnu."""
    rows = index.select(F.coalesce("matiere", F.lit("inconnu")).alias("matiere"), "text").where(F.coalesce("text", F.lit("")) != "")
    return rows.where(F.col("matiere") == subject) if subject else rows


def is_pdf(content: Column) -> Column:
    """Whether bytes begin as a PDF file does."""
    return F.coalesce(F.substring(content, 1, 5) == F.unhex(F.lit("255044462D")), F.lit(False))


def downloads(files: DataFrame, folder: str) -> DataFrame:
    """Which of ``files`` (url) stand in ``folder`` as valid PDFs: url, path (null: missing), valid.

    The download itself is left to whoever has a network; a file is looked for under the last part of its URL.
    """
    held = files.sparkSession.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", is_pdf(F.col("content")).alias("pdf"))
    named = files.withColumn("name", F.element_at(F.split("url", "/"), -1))
    return named.join(held, "name", "left").select("url", "path", F.coalesce("pdf", F.lit(False)).alias("valid"))


def is_download(url: Column, host: str, ending: str = ".pdf") -> Column:
    return F.coalesce(url.endswith(ending) & url.contains(host), F.lit(False))
