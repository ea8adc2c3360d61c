"""The Spark session and where tables come from."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "tessera", **conf: str) -> SparkSession:
    """A session with UTC times, adaptive plans and Arrow transfer; settings can be added or replaced."""
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    builder = SparkSession.builder.appName(app)
    for k, v in (base | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode, where that is unset, a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tessera-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def settled(rows: DataFrame) -> DataFrame:
    """``rows`` computed once and written to the checkpoint folder, which all executors share."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written as Parquet in the shared folder and read back, for tables too large for ``settled``."""
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    back = rows.sparkSession.read.schema(rows.schema).parquet(path)
    back.tessera_path = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Deletes tables made by ``stored`` which nothing will read again."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.tessera_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
