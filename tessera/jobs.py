"""One function for each job: ingest, search, evaluate, make questions, audit, migrate, watch, report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.text import contextual, question_request, shortened
from .functions.vocab import label_of
from .operators import audit, chunks, evaluate, golden, search, watch
from .session import settled
from .sources import index_store, readers
from .sources.state import Snapshots


def source_sections(catalog: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matiere, source_file, section, text) of the catalog's sources, and (source_file, matiere, reason) of those that fail.

    A source fails where its text is missing, its section is not found, or the section is too short. The others go on.
    """
    named = catalog.withColumn("source_file", F.regexp_replace("file", r"\.(md|txt)$", ""))
    both = named.join(texts, "source_file", "left")
    missing = both.where("text IS NULL").select("source_file", "matiere", F.lit("no text").alias("reason"))
    held = both.where("text IS NOT NULL")
    keys = ["source_file", "matiere", "section_name", "section_pattern", "section_end"]
    whole = held.where("section_pattern IS NULL").select("source_file", "matiere", "section_name", "text")
    found = whole
    for blank in (False, True):
        own = held.where(F.col("section_pattern").isNotNull() & (F.coalesce("blank_line_after_header", F.lit(False)) == blank)).select(*keys, "text")
        filled = own.fillna({"section_end": "(?!)"})
        part = chunks.sections(filled, keys, F.regexp_like("clean", F.col("section_pattern")), F.regexp_like("clean", F.col("section_end")), blank)
        found = found.unionByName(part.select("source_file", "matiere", "section_name", "text"))
    lost = held.select("source_file", "matiere", "section_name").join(found, ["source_file", "matiere", "section_name"], "left_anti")
    good, short = chunks.guarded_sections(found)
    faults = missing.unionByName(lost.select("source_file", "matiere", F.lit("section not found").alias("reason"))).unionByName(short.select("source_file", "matiere", "reason"))
    return good.withColumnRenamed("section_name", "section"), faults


def ingest(spark: SparkSession, catalog: DataFrame, folder: str, store: index_store.Store, subject: str | None = None, dry_run: bool = False, recreate: bool = False, embedder: str = "hashed") -> tuple[dict[str, int], DataFrame]:
    """Cuts the catalog's sources into chunks, upserts them and indexes what changed, terms and dense vectors in one pass; counts of
    each step, and what was left out with its reason.

    A source or chunk that fails does not stop the others. ``dry_run`` writes nothing.
    """
    sections, faults = source_sections(readers.chosen_sources(catalog, subject), readers.read_texts(spark, folder))
    raw, expanded, valid, unique = (Observation(n) for n in ("raw", "expanded", "valid", "unique"))
    n = F.count(F.lit(1)).alias("n")
    cut = chunks.chunked(sections).observe(raw, n)
    levels = chunks.expanded(cut, strict=False).observe(expanded, n)
    good, bad = chunks.divided(levels)
    rows = index_store.points(chunks.payload(good.observe(valid, n)))
    rows = index_store.upserted(rows.limit(0), rows).observe(unique, n)
    rejects = faults.unionByName(bad.select("source_file", "matiere", "reason"))
    if dry_run:
        rows.write.format("noop").mode("overwrite").save()
    else:
        if not store.create(rows, recreate):
            store.upsert(rows)
        indexed_points(store, embedder, recreate)
    counts = {"raw": raw.get["n"], "expanded": expanded.get["n"], "valid": valid.get["n"], "unique": unique.get["n"]}
    return counts | {"errors": rejects.count(), "points": 0 if dry_run else store.current().count()}, rejects


def indexed(store: index_store.Store) -> DataFrame:
    """The index with a numeric id for each point; an error where there is none."""
    rows = store.current()
    if rows is None:
        raise ValueError(f"no index in {store.folder}; create it first")
    return rows.withColumn("chunk_id", F.xxhash64("point_id"))


def indexed_points(store: index_store.Store, embedder: str = "hashed", anew: bool = False) -> int:
    """Indexes the points that are new or changed; how many they are."""
    return search.indexed_into(store.index(), indexed(store), "chunk_id", embedder, with_context(), anew)


def with_context() -> Column:
    return contextual(label_of(F.col("matiere")), F.col("section"), F.col("text"))


def query(store: index_store.Store, text: str, top_k: int = search.TOP_K, full: bool = False, facets: dict[str, str] | None = None, **options) -> DataFrame:
    """(rank, score, matiere, niveau, section, text): the best chunks for one question, texts cut to 250 characters unless ``full``."""
    own = indexed(store)
    one = store.spark.createDataFrame([(0, text)], "query_id long, text string")
    hits = search.hybrid_search(one, store.index(), "query_id", "chunk_id", top_k, facets=facets, **options)
    shown = search.with_payload(hits, own, "chunk_id")
    return shown.select("rank", F.round("score", 4).alias("score"), "matiere", "niveau", "section", (F.col("text") if full else shortened(F.col("text"))).alias("text")).orderBy("rank")


def run_evaluation(store: index_store.Store, questions: DataFrame, top_k: int = search.TOP_K, by: str | None = None, out: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Scores of questions (query, matiere, niveau, expected_keywords, gold_chunk_id) with a verdict, and their roll-up.

    Each question searches among the chunks of its subject and level, where it names them. ``out`` gets both as JSON.
    """
    for c, kind in (("matiere", "string"), ("niveau", "string"), ("expected_keywords", "array<string>"), ("gold_chunk_id", "string")):
        if c not in questions.columns:
            questions = questions.withColumn(c, F.lit(None).cast(kind))
    asked = settled(questions.withColumn("query_id", F.monotonically_increasing_id()))  # every question counts, also one asked twice
    own = indexed(store)
    hits = search.hybrid_search(asked.withColumn("text", F.col("query")), store.index(), "query_id", "chunk_id", top_k, within=("matiere", "niveau"), **options)
    found = search.with_payload(hits, own.select("chunk_id", "point_id", "text"), "chunk_id").select("query_id", "rank", F.col("point_id").alias("id"), "text")
    scores = evaluate.verdict(evaluate.question_scores(asked.withColumnRenamed("gold_chunk_id", "gold_id"), found))
    rolled = evaluate.summary(scores, by)
    if out:
        index_store.write_json(scores, f"{out}/questions")
        index_store.write_json(rolled, f"{out}/summary")
    return scores, rolled


def make_questions(store: index_store.Store, target: int, ask: Callable[[str], str], subject: str | None = None, seed: int = 42, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Grounded questions on chunks sampled over subjects and levels, by a language model; and the answers with a fault, which
    are left out as repeated questions are."""
    rows = golden.candidates(chunks.faceted(indexed(store), matiere=subject))
    sample = golden.stratified_sample(rows, target, ["matiere", "niveau"], "point_id", seed)
    request = question_request(label_of(F.col("matiere")), F.col("niveau"), F.col("section"), F.col("text"))
    answers = settled(golden.model_answers(sample, ask, request).withColumn("fault", F.coalesce("fault", golden.question_fault())))
    held = settled(golden.grounded(answers.where("fault IS NULL")))
    good = golden.distinct_questions(held, ["point_id"])
    if out:
        index_store.write_json(good.select("query", "matiere", "niveau", "expected_keywords", "gold_chunk_id", F.col("section").alias("gold_section"), F.col("source_file").alias("gold_source_file")), out)
    lost = answers.where("fault IS NULL").select("point_id")
    ungrounded = lost.join(held.select("point_id"), "point_id", "left_anti").withColumn("fault", F.lit("keywords not in the text"))
    return good, answers.where("fault IS NOT NULL").select("point_id", "fault").unionByName(ungrounded)


def audit_coverage(spark: SparkSession, catalog: DataFrame, folder: str, store: index_store.Store, subject: str | None = None) -> tuple[DataFrame, DataFrame]:
    """How much of the sources' titles and text the index holds, by subject; and the report's lines with the titles it lacks.

    A subject whose sources all fail has a row of zeros with a message.
    """
    chosen = readers.chosen_sources(catalog, subject)
    sections, faults = source_sections(chosen, readers.read_texts(spark, folder))
    index = readers.indexed_texts(indexed(store), subject)
    titles = audit.titles(sections, ["source_file", "matiere"]).select("matiere", "title", "source").distinct()
    covered = audit.covered_titles(titles, index, "matiere")
    rows = audit.coverage(sections, index, covered, "matiere").withColumn("message", F.lit(None).cast("string"))
    lost = faults.join(sections.select("matiere").distinct(), "matiere", "left_anti").groupBy("matiere").agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws(": ", "source_file", "reason"))), "; ").alias("message"))
    rows = settled(rows.unionByName(lost, allowMissingColumns=True).fillna(0))
    return rows, audit.report(rows, "matiere").join(audit.missing_titles(covered, "matiere"), "matiere", "left")


def migrate(old: index_store.Store, new: index_store.Store, recreate: bool = False) -> bool:
    """The current points of one store in another, cut and indexed anew; tells whether it wrote."""
    wrote = new.create(indexed(old).drop("chunk_id"), recreate)
    if wrote:
        indexed_points(new, anew=True)
    return wrote


def watch_run(spark: SparkSession, current: DataFrame, state: str, out: str, modified: str | None = None, known_modified: str | None = None, force: bool = False, issues: DataFrame | None = None) -> int:
    """Writes what changed since the last run, with the time, and moves the state on; how many changes there are.

    ``current`` are a data set's resources; they are passed over where ``modified``, when it was changed last, is what the state
    (or ``known_modified``) says. ``issues`` are those of a gazette, whose texts on programmes count once each; forcing a run does
    not change that.
    """
    held = Snapshots(spark, state)
    about = held.about()
    known, seen = held.read("known", watch.STATE), held.read("seen", "jorftext_id string")
    found, datasets, gazette, after = Observation(), None, None, known
    if modified is None or not watch.is_unchanged(modified, known_modified or about.get("modified"), force):
        rows, about = watch.resources(current), about | ({"modified": modified} if modified is not None else {})
        datasets = watch.changed(rows, known, force).withColumn("dataset_last_modified", F.lit(modified))
        after = watch.next_state(known, rows)
    if issues is not None:
        texts = settled(watch.unseen(watch.nested_texts(issues), seen, "jorftext_id", ["jo_titre", "titre"]))
        gazette = texts
        seen = seen.unionByName(texts.select("jorftext_id"))
    if datasets is None and gazette is None:
        return 0
    feed = watch.change_feed(datasets, gazette)
    index_store.write_json(feed.observe(found, F.count(F.lit(1)).alias("n")), out)
    held.write({"known": after, "seen": seen}, about)
    return found.get["n"]


def status(store: index_store.Store, facet: str = "matiere") -> DataFrame:
    """Points, texts and characters of the index by a facet."""
    return index_store.status(indexed(store), facet)
