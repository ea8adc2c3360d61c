"""Operators on small tables, with the reference's edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import jobs
from tessera.functions import text
from tessera.operators import audit, chunks, evaluate, golden, search, stats, watch
from tessera.sources import index_store, readers

LONG = "Un texte assez long pour faire un morceau valable du programme officiel. "


def chunk_rows(spark, rows):
    return spark.createDataFrame(rows, "text string, source_file string, matiere string, niveau string, section string, chunk_index int")


def test_sections_end_before_any_later_label(spark):
    t = "intro\n## **A**\nfirst\n\n## **C**\nthird\n## **A**\nagain"
    texts = spark.createDataFrame([("f", t), ("g", "none")], "k string, text string")
    out = chunks.sections(texts, ["k"], F.col("clean").rlike(r"^## \*\*A\*\*"), F.col("clean").rlike(r"^## \*\*(?:B|C)\*\*")).collect()
    assert [(r.k, r.text) for r in out] == [("f", "## **A**\nfirst\n")]


def test_sections_pass_over_contents(spark):
    t = "Maths\nFrançais\nMaths\n\nbody"
    texts = spark.createDataFrame([("f", t)], "k string, text string")
    out = chunks.sections(texts, ["k"], F.col("clean") == "Maths", blank_after=True).first()
    assert out.text == "Maths\n\nbody"


def test_pieces_join_to_the_text():
    rng = random.Random(3)
    for _ in range(50):
        t = "".join(rng.choice(["mot ", "fin. ", "\n\n", "\n## Titre\n", "longmotsansfin" * 3, "! "]) for _ in range(rng.randrange(600)))
        parts = chunks.split_text(t, size=40)
        assert "".join(parts) == t
        assert all(chunks.token_count(p) <= 40 for p in parts)


def test_chunk_index_keeps_gaps(spark):
    t = "\n## a\n" + LONG * 3 + "\n## b\n" + "x" + "\n## c\n" + LONG * 3
    out = chunks.chunked(spark.createDataFrame([("s", t), ("n", None)], "k string, text string"), size=40, least=1).orderBy("chunk_index").collect()
    assert all(r.k == "s" and len(r.text.strip()) >= 50 for r in out)


def test_expansion_and_validation(spark):
    raw = chunk_rows(spark, [(LONG, "p_college_BO", "svt", None, "s", 0)]).drop("niveau")
    out = chunks.validated(chunks.expanded(raw).drop("cycle"))
    assert out.columns == chunks.PAYLOAD
    assert {(r.niveau, r.cycle) for r in out.collect()} == {("sixieme", "cycle3"), ("cinquieme", "cycle4"), ("quatrieme", "cycle4"), ("troisieme", "cycle4")}
    bad = chunk_rows(spark, [("Court.", "f", "svt", "sixieme", "s", 0), (LONG, "f", "musique", "sixieme", "s", 0), (LONG, "f", "svt", "maternelle", "s", 0), (LONG, "f", "svt", "seconde", "s", -1), (LONG, "f", "svt", "seconde", "s", 1)])
    good, rest = chunks.divided(bad)
    assert good.count() == 1 and sorted(r.reason for r in rest.collect()) == ["chunk_index", "matiere", "niveau", "text"]
    with pytest.raises(Exception, match="invalid chunk"):
        chunks.validated(bad).collect()


def test_facets(spark):
    rows = chunk_rows(spark, [(LONG, "f", "svt", "sixieme", "s", 0), (LONG, "f", "emc", "sixieme", "s", 0)])
    assert chunks.faceted(rows, matiere="svt", niveau="").count() == 1 and chunks.faceted(rows).count() == 2


def test_upsert_twice_is_once(spark):
    rows = index_store.points(chunk_rows(spark, [(LONG, "f", "svt", "sixieme", "a", 0), (LONG, "f", "svt", "sixieme", "b", 3), (LONG, "f", "svt", "seconde", "a", 1)]))
    once = index_store.upserted(rows.limit(0), rows)
    assert sorted((r.niveau, r.section) for r in once.collect()) == [("seconde", "a"), ("sixieme", "b")]
    twice = index_store.upserted(once, rows)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_store_snapshots(spark, tmp_path):
    store = index_store.Store(spark, f"file://{tmp_path}/index")
    rows = index_store.points(chunk_rows(spark, [(LONG, "f", "svt", "sixieme", "a", 0)]))
    with pytest.raises(ValueError, match="create it first"):
        store.upsert(rows)
    assert store.create(rows) and not store.create(rows)
    store.upsert(index_store.points(chunk_rows(spark, [(LONG, "f", "emc", "sixieme", "a", 0)])))
    assert store.current().count() == 2


def test_fusion(spark):
    a = spark.createDataFrame([(1, 10, 5.0, 1), (1, 11, 4.0, 2)], "q long, d long, score double, rank long")
    b = spark.createDataFrame([(1, 11, 0.9, 1)], "q long, d long, score double, rank long")
    rrf = {r.d: r.score for r in search.fused([a, b], "q", "d").collect()}
    assert rrf == pytest.approx({10: 1 / 61, 11: 1 / 62 + 1 / 61})
    scaled = {r.d: r.score for r in search.fused([a.withColumn("score", F.col("score") * 100), b], "q", "d").collect()}
    assert scaled == pytest.approx(rrf)
    dbsf = {r.d: r.score for r in search.fused([a, b], "q", "d", "dbsf").collect()}
    assert dbsf[11] == pytest.approx(0.5 + (4 - (4.5 - 3 * 0.5**0.5)) / (6 * 0.5**0.5))
    with pytest.raises(ValueError, match="unknown fusion"):
        search.fused([a], "q", "d", "sum")
    with pytest.raises(ValueError, match="needs the dense model"):
        search.check_models("other", "learned")
    assert search.prefetch_limit(5) == 20 and search.prefetch_limit(10) == 40


def test_dense_blocks_agree(spark):
    rng = random.Random(1)
    rows = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(60)], "vec_id long, embedding array<double>")
    q = rows.where("vec_id < 7").withColumnRenamed("vec_id", "query_id")
    whole, parts = (sorted(map(tuple, search.dense_top(q, rows, 3, block=b).select("query_id", "vec_id", "rank").collect())) for b in (100, 2))
    assert whole == parts and len(whole) == 21
    assert search.dense_top(q.limit(0), rows).count() == 0


QUESTIONS = "query_id long, matiere string, expected_keywords array<string>, gold_id string"
HITS = "query_id long, rank int, id string, text string"


def test_question_scores(spark):
    q = spark.createDataFrame([(1, "m", ["Alpha", "beta", "beta"], "b"), (2, "m", [], None), (3, "m", [], "z"), (4, "n", ["none"], None)], QUESTIONS)
    h = spark.createDataFrame([(1, 1, "a", "nothing"), (1, 2, "b", "ALPHA here"), (3, 1, "a", "x"), (4, 1, "a", "x")], HITS)
    out = {r.query_id: r for r in evaluate.question_scores(q, h).collect()}
    assert (out[1].hits, out[1].recall_at_k, out[1].first_hit_rank, out[1].mrr, out[1].chunk_id_hit_rank, out[1].chunk_id_mrr) == (1, 0.333, 2, 0.5, 2, 0.5)
    assert out[2].skipped and out[2].mrr is None and out[2].recall_at_k is None
    assert not out[3].skipped and out[3].mrr == 0.0 and out[3].chunk_id_mrr == 0.0 and out[3].recall_at_k is None
    assert out[4].recall_at_k == 0.0 and out[4].chunk_id_mrr is None
    s = evaluate.summary(evaluate.question_scores(q, h)).first()
    assert (s.n, s.n_skipped, s.n_scorable, s.cid_recall, s.cid_mrr, s.n_any_hit) == (4, 1, 2, 0.5, 0.25, 1)
    assert sorted(r.verdict for r in evaluate.verdict(evaluate.question_scores(q, h)).collect()) == ["none", "none", "skipped", "some"]


def test_ndcg(spark):
    hits = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "query_id long, rank int, id string")
    grades = spark.createDataFrame([(1, "b", 1), (1, "c", 1)], "query_id long, id string, grade int")
    assert evaluate.ndcg(hits, grades).first().ndcg == pytest.approx((1 / 1.584962500721156) / (1 + 1 / 1.584962500721156))


def test_stratified_sample(spark):
    rows = spark.createDataFrame([(i, f"m{i % 3}") for i in range(150)], "id long, m string")
    out = golden.stratified_sample(rows, 30, ["m"], "id")
    assert out.count() == 30 and out.select("m").distinct().count() == 3
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, golden.stratified_sample(rows.repartition(7), 30, ["m"], "id").collect()))
    assert golden.stratified_sample(rows, 1000, ["m"], "id").count() == 150
    assert golden.stratified_sample(rows.limit(0), 5, ["m"], "id").count() == 0


def test_grounded(spark):
    rows = spark.createDataFrame([("L’ﬁn de Straße et mot", "svt", "seconde", ["l'fin", "STRASSE", "absent", "mot"]), ("a", "svt", "seconde", ["a", "b"])], "text string, matiere string, niveau string, expected_keywords array<string>")
    out = golden.grounded(rows).collect()
    assert [r.expected_keywords for r in out] == [["l'fin", "STRASSE", "mot"]]


def test_question_faults(spark):
    rows = spark.createDataFrame([("short", "svt", "seconde", ["a", "b"]), ("x" * 20, "svt", "seconde", ["a"]), ("x" * 20, "svt", "seconde", ["a", "b"])], "query string, matiere string, niveau string, expected_keywords array<string>")
    assert [r[0] for r in rows.select(golden.question_fault()).collect()] == ["query", "expected_keywords", None]


def test_titles(spark):
    t = "## **Nombres**\ntexte courant.\n\nLigne seule\n\nMAJUSCULES ICI\nsuite\n- liste\n## nombres"
    out = audit.titles(spark.createDataFrame([("d", t)], "k string, text string"), ["k"]).orderBy("pos").collect()
    assert [(r.title, r.source) for r in out] == [("Nombres", "markdown"), ("Ligne seule", "heuristic"), ("MAJUSCULES ICI", "heuristic")]


def test_titles_are_cut_before_the_shuffle(spark):
    rows = spark.createDataFrame([("d", "## x\n" + "a line, with a full stop.\n" * 3)], "k string, text string")
    plan = audit.titles(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "lag(" not in plan and plan.count("Exchange") == 1


def test_coverage_counts_texts_once(spark):
    chunks = spark.createDataFrame([("g", "abc"), ("g", "abc"), ("g", "de"), ("g", None), ("h", "abc")], "grp string, text string")
    covered = spark.createDataFrame([("g", True), ("g", False)], "grp string, covered boolean")
    rows = audit.coverage(chunks, chunks, covered, "grp")
    assert {r.grp: (r.source_chars, r.index_chars, r.n_chunks, r.text_distinct_pct) for r in rows.collect()} == {"g": (8, 8, 4, 62.5), "h": (3, 3, 1, 100.0)}
    assert "sha2(" in rows._jdf.queryExecution().optimizedPlan().toString()  # texts themselves are not shuffled


def test_white_space_of_any_kind(spark):
    rows = spark.createDataFrame([("\u3000 a b\u00a0\x85",), ("\x1ca\x1c",), ("\t\n",), (None,)], "t string")
    assert [r[0] for r in rows.select(text.stripped(rows.t)).collect()] == ["a b", "\x1ca\x1c", "", None]
    keys = spark.createDataFrame([("L'Été\u3000NOËL\x0bœuf  \u212a9 ",), ("!",), (None,)], "t string")
    assert [r[0] for r in keys.select(text.title_key(keys.t)).collect()] == ["letenoel uf k9", "", None]


def test_coverage(spark):
    titles = spark.createDataFrame([("g", "Art", "markdown"), ("g", "Art", "heuristic"), ("g", "un deux trois", "heuristic"), ("g", "absent mot", "heuristic"), ("g", "!!!", "markdown"), ("h", "Art", "markdown")], "grp string, title string, source string")
    texts = spark.createDataFrame([("g", "Une partie, deux un"), ("g", "trois un deux")], "grp string, text string")
    out = {(r.grp, r.title, r.source): r.covered for r in audit.covered_titles(titles, texts, "grp").collect()}
    assert out == {("g", "Art", "markdown"): True, ("g", "Art", "heuristic"): False, ("g", "un deux trois", "heuristic"): True, ("g", "absent mot", "heuristic"): False, ("g", "!!!", "markdown"): True, ("h", "Art", "markdown"): False}
    assert audit.missing_titles(audit.covered_titles(titles, texts, "grp"), "grp", 1).where("grp = 'g'").first().missing == "Art, … 1 more"


def test_changes(spark):
    schema = "resource_id string, url string, checksum string, n long"
    now = watch.resources(spark.createDataFrame([("a", "u", "1", 1), ("b", "u", "2", 2), (None, "v", "", 3)], schema))
    known = spark.createDataFrame([("a", "1"), ("b", "old")], watch.STATE)
    assert sorted(r.url for r in watch.changed(now, known).collect()) == ["u", "v"]
    assert watch.changed(now, known, force=True).count() == 3
    state = watch.next_state(known, now, "n")
    assert watch.changed(now, state).count() == 0 and state.count() == 3
    assert watch.is_unchanged("x", "x") and not watch.is_unchanged("x", "x", force=True)


def test_programme_texts(spark):
    tree = spark.createDataFrame([(1, None, "Ministère de l'éducation", "node"), (2, 1, "Arrêtés", "node"), (3, 2, "Arrêté fixant le Programme", "text"), (4, 2, "Autre", "text"), (5, None, "Agriculture", "node"), (6, 5, "Programme d'éducation", "text")], "id long, up long, titre string, kind string")
    assert [r.id for r in watch.programme_texts(tree, "id", "up", "titre").collect()] == [3]


def test_readers(spark, tmp_path):
    (tmp_path / "a.md").write_bytes("  é﻿ ok ".encode() + b"\xff")
    (tmp_path / "a.txt").write_text("second")
    (tmp_path / "b.txt").write_text("only")
    out = {r.source_file: r.text for r in readers.read_texts(spark, f"file://{tmp_path}").collect()}
    assert out["b"] == "only" and out["a"].startswith("é") and out["a"].endswith("�")
    cat = readers.multi_subject_sources(spark, "f", [("a", "A (x)"), ("b", "B"), ("c", "C")], frozenset({"b"})).collect()
    assert [(r.matiere, r.section_end) for r in cat] == [("a", r"^## \*\*(?:B|C)\*\*"), ("c", None)]
    with pytest.raises(ValueError, match="unknown subject"):
        readers.chosen_sources(readers.whole_file_sources(spark, [("f", "a", "A")]), "zzz")
    assert readers.read_state(spark, f"file://{tmp_path}/none", watch.STATE).count() == 0
    pdf = spark.createDataFrame([(b"%PDF-1.7",), (b"<html",), (None,)], "c binary").select(readers.is_pdf(F.col("c")))
    assert [r[0] for r in pdf.collect()] == [True, False, False]
    (tmp_path / "q.json").write_text('[{"question": "old"}, {"query": "new"}]')
    assert sorted(r.query for r in readers.read_questions(spark, f"file://{tmp_path}/q.json").collect()) == ["new", "old"]


def test_percentile_equals_a_sort(spark):
    rng = random.Random(1)
    for values in ([3.0], [rng.gauss(0, 1) for _ in range(999)], [1e-300 * rng.randrange(5) for _ in range(50)], [float(rng.randrange(3)) for _ in range(100)] + [1e9]):
        df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
        for q in (0.0, 0.5, 0.99, 1.0):
            assert stats.percentile(df, F.col("v"), q, bins=7) == pytest.approx(float(np.quantile(values, q)), rel=1e-12)
    assert stats.percentile(df.limit(0), F.col("v"), 0.5) is None


def test_corrupt_state_counts_as_none(spark, tmp_path):
    spark.createDataFrame([("a", "1")], watch.STATE).coalesce(1).write.parquet(f"file://{tmp_path}/state")
    assert readers.read_state(spark, f"file://{tmp_path}/state", watch.STATE).count() == 1
    for f in (tmp_path / "state").glob("part-*"):
        f.write_bytes(b"no parquet")
    for f in (tmp_path / "state").glob(".part-*"):
        f.unlink()
    assert readers.read_state(spark, f"file://{tmp_path}/state", watch.STATE).count() == 0


def test_programme_texts_at_any_depth(spark):
    rows = [(0, None, "Enseignement", "node"), *((i, i - 1, "x", "node") for i in range(1, 40)), (40, 39, "Le programme", "text"), (50, 51, "Éducation", "node"), (51, 50, "Programme", "text"), (60, 99, "programme d'éducation", "text")]
    tree = spark.createDataFrame(rows, "id long, up long, titre string, kind string")
    assert [r.id for r in watch.programme_texts(tree, "id", "up", "titre").collect()] == [40]


def test_precision_and_recall(spark):
    hits = spark.createDataFrame([(1, r, f"d{r}") for r in range(1, 6)], "query_id long, rank long, id string")
    grades = spark.createDataFrame([(1, "d1", 2), (1, "d4", 1), (1, "d9", 1), (1, "d2", 0), (2, "d1", 1)], "query_id long, id string, grade long")
    assert {r.query_id: r.precision for r in evaluate.precision(hits, grades).collect()} == {1: 0.4, 2: 0.0}
    assert {r.query_id: r.recall for r in evaluate.recall(hits, grades, 3).collect()} == pytest.approx({1: 1 / 3, 2: 0.0})


def test_search_within_facets_and_by_a_model(spark):
    docs = spark.createDataFrame([(1, "chat noir", "svt"), (2, "chat blanc", "emc"), (3, "chien noir", "svt"), (4, None, "svt")], "doc_id long, text string, matiere string")
    asked = spark.createDataFrame([(7, "chat", "emc"), (8, "chat", None), (9, "chat", "")], "item_id long, text string, matiere string")
    for mode in ("sparse", "dense", "hybrid"):
        got = search.hybrid_search(asked, docs, mode=mode, within=("matiere",)).groupBy("item_id").agg(F.collect_set("doc_id").alias("d")).collect()
        found = {r.item_id: set(r.d) for r in got}
        assert found[7] == {2} and {1, 2} <= found[8] == found[9]
    search.EMBEDDERS["lengths"] = search.model_embedder(lambda texts: np.array([[len(t), 1.0] for t in texts]), batch=2)
    assert search.hybrid_search(asked, docs, mode="dense", embedder="lengths").where("item_id = 8").count() == 3
    with pytest.raises(ValueError, match="unknown embedder"):
        search.hybrid_search(asked, docs, embedder="none")
    terms = search.learned_terms(spark.createDataFrame([(1, {5: 0.5, 6: 0.0})], "k long, weights map<int,double>"), ["k"]).collect()
    assert [tuple(r) for r in terms] == [(1, 5, 0.5)]


def test_answers_of_a_model():
    assert golden.parsed_answer('{"query": "q", "expected_keywords": ["a"]}') == ("q", ["a"], None)
    assert [golden.parsed_answer(a)[2] for a in ("x", "[]", '{"query": "q"}', '{"query": 1, "expected_keywords": []}', '{"query": "q", "expected_keywords": [1]}')] == ["no JSON", "fields", "fields", "types", "types"]
    calls = []

    def ask(_):
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError("busy")
        return '{"query": "q", "expected_keywords": []}'

    assert golden.one_answer(ask, "r", 3) == ("q", [], None) and golden.one_answer(lambda r: 1 / 0, "r", 2)[2].startswith("provider")


def test_jobs_from_sources_to_questions(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    body = "\n".join(f"## Titre {i}\n\n" + LONG * 4 for i in range(6))
    (src / "p_cycle4_a.md").write_text(f"intro\n## **Sciences**\n{body}\n## **Autre**\nfin")
    (src / "p_lycee_b.txt").write_text(body)
    catalog = readers.multi_subject_sources(spark, "p_cycle4_a.md", [("svt", "Sciences"), ("emc", "Autre"), ("ses", "Absent")]).unionByName(
        readers.whole_file_sources(spark, [("p_lycee_b.txt", "snt", "SNT"), ("p_lycee_none.txt", "nsi", "NSI")]))
    store, folder = index_store.Store(spark, f"file://{tmp_path}/index"), f"file://{src}"
    counts, rejects = jobs.ingest(spark, catalog, folder, store, dry_run=True)
    assert counts["points"] == 0 and store.current() is None
    assert {(r.matiere, r.reason) for r in rejects.collect()} == {("emc", "section of 16 characters"), ("ses", "section not found"), ("nsi", "no text")}
    counts, _ = jobs.ingest(spark, catalog, folder, store)
    assert counts["expanded"] == 3 * counts["raw"] == counts["valid"] and counts["points"] == counts["unique"] and counts["errors"] == 3
    assert jobs.ingest(spark, catalog, folder, store)[0]["points"] == counts["points"] and len(store.snapshots()) == 2
    hit = jobs.query(store, "programme officiel", facets={"matiere": "snt"}).first()
    assert hit["rank"] == 1 and hit.matiere == "snt" and len(hit.text) <= 251
    ask = lambda _: '{"query": "Que dit le programme officiel ?", "expected_keywords": ["programme", "officiel", "absent"]}'
    good, bad = jobs.make_questions(store, 4, ask, out=f"file://{tmp_path}/golden")
    row = good.first()
    assert good.count() == 1 and row.expected_keywords == ["programme", "officiel"] and bad.count() == 0
    scores, rolled = jobs.run_evaluation(store, readers.read_questions(spark, f"file://{tmp_path}/golden").drop("generated_at"), by="matiere", out=f"file://{tmp_path}/eval")
    assert scores.first().verdict == "all" and rolled.first().n == 1
    rows, lines = jobs.audit_coverage(spark, catalog, folder, store)
    held = rows.where("message IS NULL").collect()
    assert {r.matiere for r in held} == {"svt", "snt"} and all(r.titles_pct == 100.0 for r in held) and lines.where("missing IS NULL").count() == 5
    lost = {r.matiere: (r.n_titles, r.text_pct, r.message) for r in rows.where("message IS NOT NULL").collect()}
    assert lost == {"emc": (0, 0.0, "p_cycle4_a: section of 16 characters"), "ses": (0, 0.0, "p_cycle4_a: section not found"), "nsi": (0, 0.0, "p_lycee_none: no text")}
    moved = index_store.Store(spark, f"file://{tmp_path}/moved")
    assert jobs.migrate(store, moved) and not jobs.migrate(store, moved) and jobs.status(moved).count() == 2
    feed = spark.createDataFrame([("a", "u", "1"), ("b", "v", "2")], "resource_id string, url string, checksum string")
    state = f"file://{tmp_path}/state"
    runs = [jobs.watch_run(spark, f, state, f"file://{tmp_path}/changes") for f in (feed, feed, feed.replace("2", "3"))]
    assert runs == [2, 0, 1] and jobs.watch_run(spark, feed, state, "none", "m", "m") == 0
    twice = spark.createDataFrame([("Que dit le programme ?",)] * 2, "query string")
    assert jobs.run_evaluation(store, twice)[0].count() == 2


def test_downloads(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    files = spark.createDataFrame([("http://x/a.pdf",), ("http://x/b.pdf",), ("http://x/c.pdf",)], "url string")
    assert {r.url[-5:]: r.valid for r in readers.downloads(files, f"file://{tmp_path}").collect()} == {"a.pdf": True, "b.pdf": False, "c.pdf": False}
