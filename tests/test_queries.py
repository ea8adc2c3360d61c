"""Every query with SQL against DuckDB, and the plans of the searches."""

import duckdb
import pandas as pd
import pytest

from tessera.plans import catalog

from .conftest import SF

TABLES = ("events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(frame):
    cols = sorted(frame.columns)
    plain = [tuple(None if pd.isna(v) else v if isinstance(v, str) else float(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False)]
    return cols, sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, db, name):
    assert rows_of(catalog.QUERIES[name](spark, SF).toPandas()) == rows_of(db.sql(catalog.SQL[name]).df())


def test_top_k_is_cut_before_the_sort(spark):
    plan = catalog.sparse_topk(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan


def test_facets_reach_the_scan(spark):
    from tessera.operators.chunks import faceted
    from tessera.plans.views import chunks

    plan = faceted(chunks(spark, SF), matiere="src3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,src3)" in plan


def test_recursive_chunks_cover_documents(spark):
    out = catalog.recursive_chunks(spark, SF)
    assert out.select("doc_id").distinct().count() > 150 and out.where("length(trim(text)) < 50").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    from tessera.operators.watch import STATE, changed, resources
    from tessera.plans.views import events
    from tessera.streaming.watcher import StateTable, watch_resources

    src = f"file://{tmp_path}/src"
    resources(events(spark, SF)).select("resource_id", "checksum", "event_id").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("resource_id string, checksum string, event_id long").parquet(src)
    state = StateTable(spark, f"file://{tmp_path}/state")
    watch_resources(stream, state, f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination(120)
    got = spark.read.parquet(f"file://{tmp_path}/out/batch-0")
    users = spark.read.parquet(src).select("resource_id").distinct().count()
    assert got.count() == users == state.before(1).count()
    assert changed(got, spark.createDataFrame([], STATE)).count() == users
