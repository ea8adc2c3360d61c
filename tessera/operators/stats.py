"""Exact order statistics without a sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percentile(rows: DataFrame, value: Column, share: float, bins: int = 4096) -> float | None:
    """The exact percentile with linear interpolation, as a sort of all values would give; None without values.

    Each pass counts values in ``bins`` equal bins of a range and goes on within the bin that holds the rank, so the driver
    and a task's buffer see ``bins`` rows at most. Nulls and NaN do not count.
    """
    x = rows.select(value.cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    n, low, high = x.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not n:
        return None
    rank, over = divmod(share * (n - 1), 1)
    first = value_at(x, int(rank), low, high, bins)
    return first if not over else first + over * (value_at(x, int(rank) + 1, low, high, bins) - first)


def value_at(x: DataFrame, rank: int, low: float, high: float, bins: int) -> float:
    """The value (x) of a rank, counted from 0, among values between ``low`` and ``high``."""
    while low < high:
        width = (high - low) / bins
        if low + width == low:  # no number lies between
            values = x.where(F.col("x").between(low, high)).groupBy("x").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("x").collect()
        else:
            own = x.where(F.col("x").between(low, high)).withColumn("bin", F.least(F.lit(bins - 1), F.floor((F.col("x") - low) / width)))
            values = own.groupBy("bin").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("bin").collect()
        for r in values:
            if rank < r.n:
                low, high = r.low, r.high
                break
            rank -= r.n
    return low
