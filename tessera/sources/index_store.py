"""The index as Parquet snapshots: creating, upserting, counting and reporting."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import point_id
from .postings import InvertedIndex


def points(chunks: DataFrame) -> DataFrame:
    """Chunks (text, matiere, niveau, ...) with their point_id."""
    return chunks.withColumn("point_id", point_id(F.col("matiere"), F.col("niveau"), F.col("text")))


def upserted(old: DataFrame, new: DataFrame, order: str = "chunk_index") -> DataFrame:
    """``old`` with the rows of ``new`` written over those of the same point; among equals the last by ``order`` stays.

    A text that changed makes a new point; the former one stays, as there is no deletion.
    """
    both = old.withColumn("_version", F.lit(0)).unionByName(new.withColumn("_version", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy("point_id").orderBy(F.desc("_version"), F.desc(order))
    return both.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank", "_version")


def z_order(rows: DataFrame, columns: list[str], bits: int = 4) -> Column:
    """A number that near values of all ``columns`` share most of: the bits of each value's bin, taken in turn.

    A column's bins are cut at 2^bits - 1 of its distinct values at most, which a sketch of fixed size spreads over the rows.
    """
    cuts = {}
    for c in columns:
        own = rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        least = own.orderBy(F.xxhash64(c)).limit(1024).orderBy(c).collect()  # all values where there are few, else a spread of them
        total, seen, at = sum(r.n for r in least), 0, []
        for r in least[:-1]:
            seen += r.n
            if seen * (1 << bits) >= total * (len(at) + 1) and len(at) < (1 << bits) - 1:
                at.append(r[c])
        cuts[c] = at
    out = F.lit(0).cast("long")
    for k, c in enumerate(columns):
        level = sum((F.coalesce(F.col(c) > v, F.lit(False)).cast("int") for v in cuts[c]), F.lit(0))
        level = F.floor(level * (1 << bits) / (len(cuts[c]) + 1)).cast("int")  # few bins are spread over all bits
        for b in range(bits):
            bit = F.shiftright(level, b).bitwiseAND(1).cast("long")
            out = out + F.shiftleft(bit, b * len(columns) + k)
    return out


class Store:
    """Numbered snapshots of an index in a folder: a whole one, and after it what changed.

    A snapshot counts once its commit marker is there, which Spark writes last, so readers see the former or the new
    one and never half of one. An upsert writes its own rows only; readers merge: the last version of a point counts.
    ``compact`` writes a whole snapshot again, which happens by itself after MOST_DELTAS. Two writers at once make two
    snapshots; the later number, then name, wins.
    """

    #: Payload columns that readers filter by. Rows of a snapshot are clustered by all of them.
    FACETS = ("matiere", "niveau", "cycle", "source_file")
    MOST_DELTAS = 8

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def index(self) -> InvertedIndex:
        """The postings and dense vectors of the points, by chunk_id (a hash of the point's id)."""
        return InvertedIndex(self.spark, f"{self.folder}/index", self.FACETS, dense=True)

    def snapshots(self) -> list[str]:
        """Names of the complete snapshots, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path(self.folder)):
            return []
        names = [f.getPath().getName() for f in files.listStatus(path(self.folder))]
        return sorted(n for n in names if n.startswith("snapshot-") and files.exists(path(f"{self.folder}/{n}/_SUCCESS")))

    def _parts(self) -> tuple[str | None, list[str]]:
        """The last whole snapshot, and those of changes after it."""
        names = self.snapshots()
        whole = max((i for i, n in enumerate(names) if not n.endswith("-delta")), default=None)
        return (None, []) if whole is None else (names[whole], names[whole + 1 :])

    def read(self, name: str, **facets: str) -> DataFrame:
        """A snapshot's rows of the given facets; files that can't hold them by the manifest are not opened."""
        at = f"{self.folder}/{name}"
        asked = {c: v for c, v in facets.items() if v}
        rows = self.spark.read.parquet(at)
        if asked:
            files = self.spark.read.parquet(f"{at}/_manifest")
            for c, v in asked.items():
                files = files.where((F.col(f"{c}_low") <= v) & (F.col(f"{c}_high") >= v))
            own = [f"{at}/{r.file}" for r in files.select("file").collect()]
            rows = self.spark.read.schema(rows.schema).parquet(*own) if own else rows.limit(0)
            for c, v in asked.items():
                rows = rows.where(F.col(c) == v)
        return rows

    def current(self, **facets: str) -> DataFrame | None:
        """The points, of the given facets if there are any: those of the last whole snapshot that did not change, and what did."""
        whole, deltas = self._parts()
        if whole is None:
            return None
        rows = self.read(whole, **facets)
        if not deltas:
            return rows
        new = None
        for i, n in enumerate(deltas):
            part = self.spark.read.parquet(f"{self.folder}/{n}").withColumn("_version", F.lit(i))
            new = part if new is None else new.unionByName(part, allowMissingColumns=True)
        last = Window.partitionBy("point_id").orderBy(F.desc("_version"))
        new = new.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank", "_version")
        kept = rows.join(new.select("point_id"), "point_id", "left_anti")
        for c, v in facets.items():
            new = new.where(F.col(c) == v) if v else new
        return kept.unionByName(new, allowMissingColumns=True)

    def write(self, rows: DataFrame, files: int | None = None, delta: bool = False) -> None:
        """A new snapshot: files clustered by all facets (Z-order), a Bloom filter on point ids, and the manifest of their extremes."""
        names = self.snapshots()
        name = f"snapshot-{int(names[-1].split('-')[1]) + 1 if names else 0:012d}-{uuid.uuid4().hex}{'-delta' if delta else ''}"
        facets = [c for c in self.FACETS if c in rows.columns]
        at = f"{self.folder}/{name}"
        if not delta and facets:
            rows = rows.withColumn("_z", z_order(rows, facets))
            rows = (rows.repartitionByRange(files, "_z") if files else rows.repartitionByRange("_z")).sortWithinPartitions("_z").drop("_z")
        staged = f"{self.folder}/_staged-{uuid.uuid4().hex}"  # no reader looks there; the rename at the end is what counts
        out = rows.write if delta else rows.write.option("parquet.bloom.filter.enabled#point_id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        out.parquet(staged)
        if not delta:
            ends = [f(c).alias(f"{c}_{n}") for c in facets for f, n in ((F.min, "low"), (F.max, "high"))]
            held = self.spark.read.parquet(staged).select(*facets, F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
            held.groupBy("file").agg(*ends, F.count("*").alias("n")).coalesce(1).write.parquet(f"{staged}/_manifest")
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        if not path(at).getFileSystem(self.spark._jsc.hadoopConfiguration()).rename(path(staged), path(at)):
            raise OSError(f"{staged} could not become {at}")

    def create(self, rows: DataFrame, recreate: bool = False) -> bool:
        """The first snapshot; does nothing where there is one, unless ``recreate``. Tells whether it wrote."""
        if self._parts()[0] is not None and not recreate:
            return False
        self.write(rows)
        return True

    def upsert(self, rows: DataFrame) -> None:
        """Writes ``rows`` over those of the same points; among equals in ``rows`` the last by chunk_index stays."""
        whole, deltas = self._parts()
        if whole is None:
            raise ValueError(f"no index in {self.folder}; create it first")
        self.write(upserted(rows.limit(0), rows), delta=True)
        if len(deltas) + 1 > self.MOST_DELTAS:
            self.compact()

    def compact(self) -> None:
        """The current points as one whole snapshot."""
        if self._parts()[1]:
            self.write(self.current())


def status(index: DataFrame, facet: str) -> DataFrame:
    """Points, distinct texts and characters by a facet."""
    return index.groupBy(facet).agg(F.count("*").alias("n_points"), F.countDistinct("text").alias("n_texts"), F.sum(F.length("text")).alias("n_chars"))


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines with the time of writing (UTC); fields without a value are left out."""
    rows = rows.withColumn("generated_at", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    rows.write.mode("overwrite").option("ignoreNullFields", "true").json(path)
