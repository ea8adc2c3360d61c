"""How the given tables stand in for chunks, questions, resources and seen ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import contextual
from ..functions.vocab import LEVELS, label_of
from ..operators.search import index_of
from ..session import table
from ..sources.postings import InvertedIndex


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks: the source is the subject, the language the section, levels and files go by id."""
    mark = F.element_at(F.array(*map(F.lit, ("_cycle4_", "_cycle3_", "_college_", "_lycee_"))), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    level = F.element_at(F.array(*map(F.lit, LEVELS)), (F.pmod("doc_id", F.lit(7)) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat(F.lit("programme_"), "source", mark, F.lit("BO")).alias("source_file"),
        F.col("source").alias("matiere"), level.alias("niveau"), F.col("lang").alias("section"), F.col("doc_id").cast("int").alias("chunk_index"))


#: The same in DuckDB's SQL, as a common table expression.
CHUNKS_SQL = """chunks AS (SELECT doc_id, text,
  'programme_' || source || (['_cycle4_', '_cycle3_', '_college_', '_lycee_'])[doc_id % 4 + 1] || 'BO' AS source_file, source AS matiere,
  (['sixieme', 'cinquieme', 'quatrieme', 'troisieme', 'seconde', 'premiere', 'terminale'])[doc_id % 7 + 1] AS niveau,
  lang AS section, doc_id::INT AS chunk_index FROM documents)"""


_INDEXES: dict[tuple, InvertedIndex] = {}


def index(spark: SparkSession, sf_dir: str) -> InvertedIndex:
    """The index of the chunks, with vectors of their contexts; made once for a session and the table's present files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/documents.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stamp = tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files.listStatus(path))
    key = (spark.sparkContext.applicationId, sf_dir, stamp)
    if key not in _INDEXES:
        context = contextual(label_of(F.col("matiere")), F.col("section"), F.col("text"))
        _INDEXES[key] = index_of(chunks(spark, sf_dir), "doc_id", ("matiere", "niveau", "source_file"), dense=True, context=context)
    return _INDEXES[key]


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as questions: their rarest tokens are keywords, the first document that holds an item is its gold."""
    from ..operators.golden import keyword_guesses

    items = table(spark, sf_dir, "benchmark")
    words = keyword_guesses(items.withColumnRenamed("item_id", "query_id"), "query_id")
    rows = items.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"), F.concat(F.lit("m"), F.pmod("item_id", F.lit(5))).alias("matiere"))
    return rows.join(words, "query_id", "left")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as resources: a user's newest properties are the resource's content."""
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("resource_id"), F.col("props").alias("url"), F.lit("").alias("checksum"), "event_type", "value")
