"""Vectors as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """A vector of length one in the same direction; an error for the zero vector."""
    n = F.when(norm(v) == 0, F.raise_error(F.lit("a zero vector has no direction")).cast("double")).otherwise(norm(v))
    return F.transform(v, lambda x: x.cast("double") / n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def quantized(v: Column, bound: Column) -> Column:
    """Eight-bit codes of a vector whose components are cut at ``bound``."""
    return F.transform(v, lambda x: F.round(F.greatest(-bound, F.least(bound, x.cast("double"))) / bound * 127).cast("tinyint"))


def hashed_components(term_counts: DataFrame, keys: list[str], dims: int = 64) -> DataFrame:
    """(keys, dim, val): signed feature hashing of term counts (keys, term_id, tf).

    The default embedder without a model: a term's hash chooses dimension and sign, and counts add up.
    """
    sign = F.when((F.floor(F.col("term_id") / dims) % 2) == 0, 1).otherwise(-1)
    return term_counts.groupBy(*keys, (F.col("term_id") % dims).alias("dim")).agg(F.sum(F.col("tf") * sign).alias("val")).where("val <> 0")


def hashed_vectors(term_counts: DataFrame, key: str, dims: int = 64) -> DataFrame:
    """(key, embedding): the components of ``hashed_components`` as arrays; a text without any has no row."""
    by_dim = hashed_components(term_counts, [key], dims).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.col("dim").cast("int"), F.col("val").cast("double")))).alias("m"))
    return by_dim.select(key, F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("embedding"))
