"""Shared pieces of the training-data operators: shared storage, word rules and grouping of linked rows."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of ASCII letters, digits and characters beyond ASCII. Texts are lower-cased (A-Z only) first.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased words of a whole text; none for null."""
    if not text:
        return []
    return WORD.findall(text.encode().lower().decode())  # bytes are lower-cased in ASCII alone


#: Bytes of texts as words are cut from them: A-Z in lower case, a space for bytes of no word.
FOLDED = bytes(ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20 for b in range(256))


def word_bytes(text: str | None) -> list[bytes]:
    """``words_of`` in UTF-8, without a pattern."""
    return text.encode().translate(FOLDED).split() if text else []


#: UTF-8 bytes of the texts that tasks take together.
GROUP_BYTES = 2 << 20


def text_groups(column: pa.Array, more: int = 0) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of at most GROUP_BYTES bytes (or one text), each with the place of its first; a text counts ``more`` bytes more."""
    first, held = 0, 0
    for i, size in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
        if i > first and held + size + more > GROUP_BYTES:
            yield first, column.slice(first, i - first).to_pylist()
            first, held = i, 0
        held += size + more
    if len(column):
        yield first, column.slice(first).to_pylist()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode where that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tessera-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: cuts lineage and outlives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.tessera_path = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Deletes tables made by ``stored`` which nothing will read again."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.tessera_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the smallest id reachable.

    Alternates large-star and small-star steps, each a grouped minimum and a join, until the
    edges stop changing. Every step is written to the shared folder. Nulls and loops are ignored.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, name)

    def star(e: DataFrame, large: bool) -> DataFrame:
        # u gets all neighbours (large) or the smaller ones (small); they are re-hung below u's minimum
        both = e if not large else e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        hung = both.join(low, "u")
        if large:
            out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    sig = None
    while True:
        seen = Observation()
        nxt = stored(star(star(edges, True), False).observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")), name)
        now = (seen.get["n"], seen.get["h"])
        dropped(edges)
        edges = nxt
        if now == sig or not now[0]:
            break
        sig = now
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def numbered(rows: DataFrame, *order: str, name: str = "numbered", per_task: int = 200_000) -> DataFrame:
    """``rows`` with ``place``, their number from 0 by the columns ``order`` (nulls first).

    Range partitions of about ``per_task`` rows are sorted on their own; a row's place is its number there and the sum
    of the partitions before, one small row each. Rows that are equal in all of ``order`` come in any order.
    """
    parts = max(1, -(-rows.count() // per_task))
    spread = rows.repartitionByRange(parts, *order) if parts > 1 else rows.coalesce(1)
    held = stored(spread.sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), name)
    sums = held.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sums.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return held.join(before, "_part").withColumn("place", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_at", "_before")
