"""The store: changes as small snapshots, merged by readers, and files that facets pass over."""

import os

from pyspark.sql import functions as F

from tessera.sources.index_store import Store, points, upserted, z_order

LEVELS = ("sixieme", "cinquieme", "quatrieme", "troisieme", "seconde", "premiere", "terminale")


def rows_of(spark, n, mark=""):
    i = F.col("id")
    return points(spark.range(n).select(
        F.concat(F.lit("text "), i, F.lit(f" {mark}")).alias("text"), F.concat(F.lit("f"), F.pmod(F.xxhash64("id"), F.lit(40))).alias("source_file"), F.concat(F.lit("m"), F.pmod(i, F.lit(10))).alias("matiere"),
        F.element_at(F.array(*map(F.lit, LEVELS)), (F.pmod(F.floor(i / 10), F.lit(7)) + 1).cast("int")).alias("niveau"), F.concat(F.lit("c"), F.pmod(F.floor(i / 70), F.lit(3))).alias("cycle"), F.lit("s").alias("section"), i.cast("int").alias("chunk_index")))


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def state(df):
    return sorted(tuple(r) for r in df.select("point_id", "section", "chunk_index").collect())


def test_an_upsert_writes_what_changed_and_readers_merge(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    rows = rows_of(spark, 20_000)
    assert store.create(rows)
    whole = size(tmp_path)
    want = rows
    for k in range(3):
        change = rows.where(F.pmod(F.xxhash64("text"), F.lit(100)) == 2 * k).withColumn("section", F.lit(f"changed {k}")).unionByName(rows_of(spark, 50, f"new {k}"))
        before = size(tmp_path)
        store.upsert(change.unionByName(change.limit(5).withColumn("chunk_index", F.lit(10**6))))
        assert size(tmp_path) - before < whole * 0.05
        want = upserted(want, change.unionByName(change.limit(5).withColumn("chunk_index", F.lit(10**6))))
        assert state(store.current()) == state(want)
    asked = want.where("matiere = 'm3' AND niveau = 'seconde'")
    assert state(store.current(matiere="m3", niveau="seconde", cycle="")) == state(asked)
    store.compact()
    assert state(store.current()) == state(want) and not store.snapshots()[-1].endswith("-delta")
    assert state(store.current(matiere="m3", niveau="seconde")) == state(asked)


def test_many_upserts_are_compacted(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.MOST_DELTAS = 2
    store.create(rows_of(spark, 10))
    for k in range(3):
        store.upsert(rows_of(spark, 5, str(k)))
    assert not store.snapshots()[-1].endswith("-delta") and store.current().count() == 25


def test_a_filter_on_any_facet_reads_a_share_of_the_files(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    rows = rows_of(spark, 21_000)
    store.write(rows, files=64)
    name = store.snapshots()[-1]
    n = store.read(name).select(F.input_file_name()).distinct().count()
    assert n > 50
    for facet, value in (("matiere", "m4"), ("niveau", "seconde"), ("cycle", "c1"), ("source_file", "f7")):
        own = store.read(name, **{facet: value})
        assert own.count() == rows.where(F.col(facet) == value).count()
        assert len(own.inputFiles()) <= 0.7 * n, (facet, len(own.inputFiles()), n)
    both = store.read(name, matiere="m4", niveau="seconde")
    assert len(both.inputFiles()) <= 0.45 * n and both.count() == rows.where("matiere = 'm4' AND niveau = 'seconde'").count()
    assert store.read(name, matiere="none").count() == 0


def test_z_order_takes_the_bits_in_turn(spark):
    rows = spark.createDataFrame([(a, b) for a in "abcd" for b in "wxyz"] + [(None, "w")], "a string, b string")
    z = {(r.a, r.b): r.z for r in rows.withColumn("z", z_order(rows, ["a", "b"], 2)).collect()}
    assert z[None, "w"] == z["a", "w"] == 0 and z["b", "w"] == 1 and z["a", "x"] == 2 and z["d", "z"] == 15 and len(set(z.values())) == 16
