"""The pipeline's stages on the smallest tables, each on what the one before kept."""

import corpus_pipeline
import pytest

from tessera.llm.common import scratch

SF = "/root/testdata/sf0.01"  # the smallest tables hold too few labels to learn from


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path_factory.mktemp('stage')}/out"
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_decisions_take_effect(spark, stages):
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in stages]
    assert all(a >= b for a, b in zip(ids, ids[1:], strict=False))
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    toxic, clean = ({r.doc_id for r in labels if test(r)} for test in (lambda r: r.toxic == 1, lambda r: r.toxic == 0 and r.quality == 1))
    assert len(toxic & ids[1]) <= 0.2 * len(toxic) and len(clean & ids[1]) >= 0.95 * len(clean)
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    assert len(set(texts.values())) == len(texts)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {d for d, t in texts.items() if any(i in t for i in items)} <= ids[2] - ids[3]
    assert ids[3] == ids[4] == ids[5]
    changed = [r for r in stages[4].collect() if r.text != texts[r.doc_id]]
    assert all("[SECRET]" in r.text and r.n_chars == len(r.text) for r in changed)


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages[-1].count()


def test_odd_rows_pass_all_stages(spark):
    """Nulls, empty and long texts, repeated rows and ids, extra columns with names that the operators use themselves."""
    from pyspark.sql import functions as F

    base = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(None, "some text without an id"), (900_001, None), (900_002, ""), (900_003, "word " * 30_000), (900_004, "same words here"), (900_004, "same words here"), (900_005, "password = hunter2222")], "doc_id long, text string")
    docs = base.unionByName(odd, allowMissingColumns=True)
    for name in ("at", "shift", "key", "n", "judged", "class_id", "h", "salt", "item_id", "kept"):
        docs = docs.withColumn(name, F.lit(1))
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, out, SF)
        assert set(done.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}
        path = scratch(spark, "odd")
        done.write.parquet(path)
        out = spark.read.parquet(path)
    rows = out.collect()
    assert {None, 900_001, 900_002, 900_005} <= {r.doc_id for r in rows}
    assert [r.text for r in rows if r.doc_id == 900_005] == ["[SECRET]"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, out, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in rows}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
