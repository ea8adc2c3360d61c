"""State of recurring jobs as numbered snapshots of small tables."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Conditions under which a Parquet file is corrupt; any other error of a read is one.
CORRUPT = ("CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "FILE_CORRUPT")


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state table; an empty one where there is none yet or a file's footer is corrupt, which one pass over it finds out.

    Any other error, such as columns of another type or files that can't be reached, is raised: an empty state
    would report everything as new.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path)
    try:
        rows.agg(F.max(F.xxhash64(*rows.columns))).collect()
    except (PySparkException, Py4JJavaError) as e:
        if any(c in str(e) for c in CORRUPT):
            return spark.createDataFrame([], schema)
        raise
    return rows


class Snapshots:
    """Numbered snapshots of named tables in a folder; the last complete one counts, so a crash leaves the former one.

    A snapshot is complete with its table ``about`` (name, value), which is written last.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        if not self._files.exists(self._path(self.folder)):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._path(self.folder))]
        return sorted(int(n.split("-")[1]) for n in names if n.startswith("state-") and self._files.exists(self._path(f"{self.folder}/{n}/about/_SUCCESS")))

    def at(self, number: int) -> str:
        return f"{self.folder}/state-{number:012d}"

    def read(self, name: str, schema: str) -> DataFrame:
        numbers = self.numbers()
        return read_state(self.spark, f"{self.at(numbers[-1])}/{name}", schema) if numbers else self.spark.createDataFrame([], schema)

    def about(self) -> dict[str, str]:
        return {r.name: r.value for r in self.read("about", "name string, value string").collect()}

    def write(self, tables: dict[str, DataFrame], about: dict[str, str | None]) -> None:
        """The next snapshot; the two before it stay."""
        numbers = self.numbers()
        at = self.at(numbers[-1] + 1 if numbers else 0)
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{at}/{name}")
        self.spark.createDataFrame(list(about.items()), "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{at}/about")
        for old in numbers[:-2]:
            self._files.delete(self._path(self.at(old)), True)
