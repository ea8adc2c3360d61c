"""The corpus pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import scratch, stored, table
from tessera.llm.op03_quality import accepted
from tessera.llm.op04_decontaminate import decontaminate
from tessera.llm.op05_minhash import near_duplicates
from tessera.llm.op06_secrets import redact_secrets
from tessera.llm.op09_packing import pack_documents

#: Stages on similarity and tokens can't be written in SQL; tests hold them against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither junk nor toxic."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates; rows of a null id stay."""
    gone = near_duplicates(docs).where(F.col("class_id") < F.col("doc_id")).select("doc_id")
    return docs.join(stored(gone, "duplicates"), "doc_id", "left_anti").select(docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced; all stay."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their sequence and place in it."""
    return pack_documents(docs)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", clean), ("secret scans", secrets), ("best-fit packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
