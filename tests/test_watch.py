"""State, nested feeds and the keyed stream."""

import json

import pytest

from tessera import jobs
from tessera.operators import watch
from tessera.sources.state import Snapshots, read_state
from tessera.streaming.watcher import first_sightings, watch_keyed

FEED = "resource_id string, url string, checksum string"


def test_a_state_of_other_types_is_an_error(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "resource_id string, checksum long").write.parquet(f"file://{tmp_path}/state")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader raises
        read_state(spark, f"file://{tmp_path}/state", watch.STATE)
    assert read_state(spark, f"file://{tmp_path}/none", watch.STATE).count() == 0


def test_a_snapshot_counts_once_it_is_whole(spark, tmp_path):
    held = Snapshots(spark, f"file://{tmp_path}/s")
    for i in range(4):
        held.write({"known": spark.createDataFrame([("a", str(i))], watch.STATE)}, {"modified": str(i), "none": None})
    assert held.about() == {"modified": "3", "none": None} and held.numbers() == [1, 2, 3]
    spark.createDataFrame([("a", "x")], watch.STATE).write.parquet(f"{held.at(4)}/known")  # a crash before the last table
    assert held.read("known", watch.STATE).first().checksum == "3"


def issue(title, *parts):
    return title, json.dumps({"items": [{"joCont": {"structure": {"tms": list(parts)}}}]})


def part(title, links=(), below=()):
    return {"titre": title, "liensTxt": [{"id": i, "titre": t} for i, t in links], "tms": list(below)}


ISSUES = [
    issue("JO 1", part("Ministère de l'éducation", [("t1", "Le Programme de svt"), ("t2", "Autre")], [part("Arrêtés", [("t3", "PROGRAMME")], [part("x", [("t4", "programmes")])])]), part("Agriculture", [("t5", "programme")], [part("Enseignement", [("t6", "programme")])])),
    issue("JO 2", part("ENSEIGNEMENT", [("t1", "Le Programme de svt")]), {"autre": 1}),
    ("JO 3", "no json"), ("JO 4", None), ("JO 5", '{"items": 5}'),
]


def test_marks_go_down_nested_feeds_and_agree_with_flat_rows(spark):
    got = watch.nested_texts(spark.createDataFrame(ISSUES, "jo_titre string, content string")).collect()
    assert sorted((r.jorftext_id, r.jo_titre) for r in got) == [("t1", "JO 1"), ("t1", "JO 2"), ("t3", "JO 1"), ("t4", "JO 1"), ("t6", "JO 1")]
    rows, todo = [], [(None, p) for _, c in ISSUES[:1] for p in json.loads(c)["items"][0]["joCont"]["structure"]["tms"]]
    for up, p in todo:
        me = len(rows)
        rows.append((str(me), up, p["titre"], "node"))
        rows += [(x["id"], str(me), x["titre"], "text") for x in p["liensTxt"]]
        todo += [(str(me), b) for b in p["tms"]]
    flat = watch.programme_texts(spark.createDataFrame(rows, "id string, up string, titre string, kind string"), "id", "up", "titre")
    assert {r.id for r in flat.collect()} == {r.jorftext_id for r in got if r.jo_titre == "JO 1"}


def test_runs_keep_the_date_and_what_was_seen(spark, tmp_path):
    feed = spark.createDataFrame([("a", "u", "1"), ("b", "v", "2")], FEED)
    issues = spark.createDataFrame(ISSUES, "jo_titre string, content string")
    state, out = f"file://{tmp_path}/state", f"file://{tmp_path}/out"
    assert jobs.watch_run(spark, feed, state, out, "monday", issues=issues) == 6
    written = spark.read.json(out)
    assert {(r.source, r.jorftext_id) for r in written.where("source = 'gazette'").collect()} == {("gazette", t) for t in ("t1", "t3", "t4", "t6")}
    assert written.where("source = 'dataset'").first().dataset_last_modified == "monday"
    changed = feed.replace("2", "3")
    assert jobs.watch_run(spark, changed, state, out, "monday") == 0  # the date says nothing changed
    assert jobs.watch_run(spark, changed, state, out, "tuesday", issues=issues) == 1
    assert jobs.watch_run(spark, changed, state, out, "tuesday", force=True, issues=issues) == 2  # texts that were seen stay so


def test_keyed_stream_equals_batches_over_a_restart_and_a_forced_run(spark, tmp_path):
    src, out, checkpoint = (f"file://{tmp_path}/{n}" for n in ("src", "out", "cp"))
    schema = "resource_id string, checksum string, event_id long, modified string"
    batches = [[("a", "1", 1, "m1"), ("b", "1", 2, "m1"), ("a", "2", 3, "m1")], [("a", "2", 4, "m2"), ("b", "9", 5, "m2"), ("c", "1", 6, "m2")], [("b", "1", 3, "m3"), ("c", "2", 8, "m3"), ("d", "1", 9, None)]]
    known, want = spark.createDataFrame([], watch.STATE), []
    for rows in batches:  # each run is a restart on the same checkpoint
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(src)
        watch_keyed(spark.readStream.schema(schema).parquet(src), out, checkpoint).awaitTermination(180)
        newest = df.selectExpr("resource_id", "max_by(checksum, event_id) OVER (PARTITION BY resource_id) AS checksum", "max(event_id) OVER (PARTITION BY resource_id) AS event_id").distinct()
        newest = newest.where("NOT (resource_id = 'b' AND event_id = 3)")  # older than what is held
        want += [(r.resource_id, r.checksum, r.event_id) for r in watch.changed(newest, known).collect()]
        known = watch.next_state(known, newest, "event_id")
    got = spark.read.parquet(out).collect()
    assert sorted((r.resource_id, r.checksum, r.event_id) for r in got) == sorted(want) and {r.modified for r in got} == {"m1", "m2", "m3", None}
    forced = spark.createDataFrame([("a", "2", 10, "m4"), ("d", "1", 11, "m4")], schema)
    forced.coalesce(1).write.mode("append").parquet(src)
    watch_keyed(spark.readStream.schema(schema).parquet(src), out, checkpoint, force=True).awaitTermination(180)
    assert spark.read.parquet(out).where("modified = 'm4'").count() == 2


def test_first_sightings_drop_repeats_within_the_watermark(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2026-01-01 00:00:00", 1), ("a", "2026-01-01 00:10:00", 2), ("b", "2026-01-01 00:20:00", 3)], "key string, ts string, n long")
    rows.coalesce(1).write.parquet(f"file://{tmp_path}/src")
    stream = first_sightings(spark.readStream.schema("key string, ts string, n long").parquet(f"file://{tmp_path}/src"), "key", "ts")
    stream.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination(180)
    assert sorted(r.key for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["a", "b"]
