"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .op01_licenses import scan_licenses
from .op02_token_orc import token_table
from .op03_quality import REJECT, judged
from .op04_decontaminate import contaminated
from .op05_minhash import near_duplicates
from .op06_secrets import scan_secrets
from .op07_template_extract import extracted
from .op08_embedding_dedup import near_vectors
from .op09_packing import pack_documents
from .op10_suffix_dedup import repeated_passages
from .op11_manifest import audited
from .op12_mixing import mixed, taken
from .op13_whitening import whitened


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with their probabilities."""
    out = judged(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), table(spark, sf_dir, "labels"))
    return out.where(F.col("judged.bad") < REJECT).select("doc_id", "judged.junk", "judged.toxic", "judged.bad")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op7_template_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and check; every fifth one by the CRC-32 of its id was tampered with."""
    return audited(table(spark, sf_dir, "documents"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(mixed(table(spark, sf_dir, "documents")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_token_orc, op3_quality_classifier, op4_decontamination, op5_minhash_near_dedup, op6_secret_scan, op7_template_extract, op8_embedding_near_dedup, op9_best_fit_packing, op10_suffix_array_dedup, op11_merkle_manifest, op12_source_mixing, op13_embedding_whitening)}


def oracle_sql() -> dict[str, str]:
    return {}
