"""The queries over the given tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids, text, vectors, vocab
from ..operators import audit, containment, evaluate, golden, search, stats, watch
from ..operators import chunks as ch
from ..session import fresh_path, table
from ..sources import index_store, readers
from ..sources.cells import CellIndex
from . import views
from .views import CHUNKS_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


TOKEN_SQL = "regexp_extract_all(lower({0}), '[a-zàâäéèêëïîôùûüÿœæç0-9]+')"
HASH_SQL = "list_reduce(list_prepend(2166136261::HUGEINT, list_transform(string_split({0}, ''), lambda c: ord(c)::HUGEINT)), lambda h, c: (xor(h, c) * 16777619) % 4294967296) % 2147483648"


def counts_sql(table: str, key: str, name: str) -> str:
    """Tables <name>_words (key, token, n), hashes of distinct tokens, and <name> (key, term_id, tf)."""
    return f"""{name}_words AS (SELECT {key}, token, count(*) AS n FROM (SELECT {key}, unnest({TOKEN_SQL.format('text')}) AS token FROM {table}) GROUP BY ALL),
{name}_hash AS (SELECT token, ({HASH_SQL.format('token')})::BIGINT AS term_id FROM (SELECT DISTINCT token FROM {name}_words)),
{name} AS (SELECT {key}, term_id, sum(n)::BIGINT AS tf FROM {name}_words JOIN {name}_hash USING (token) GROUP BY ALL)"""


IDF_SQL = "idf AS (SELECT term_id, count(*) AS df, ln(1 + ((SELECT count(*) FROM documents) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM d GROUP BY ALL)"
POSTINGS_SQL = f"{counts_sql('benchmark', 'item_id', 'q')}, {counts_sql('documents', 'doc_id', 'd')}, {IDF_SQL}"
TF_IDF_SQL = f"{POSTINGS_SQL}, scores AS (SELECT item_id, doc_id, round(sum(q.tf * idf * d.tf), 6) AS score FROM q JOIN idf USING (term_id) JOIN d USING (term_id) GROUP BY ALL)"
BM25_SQL = f"""{POSTINGS_SQL}, len AS (SELECT doc_id, len({TOKEN_SQL.format('text')}) AS dl FROM documents), mean AS (SELECT avg(dl) AS m FROM len),
scores AS (SELECT item_id, doc_id, round(sum(q.tf * idf * (d.tf * 2.2 / (d.tf + 1.2 * (1 - 0.75 + 0.75 * dl / m)))), 6) AS score FROM q JOIN idf USING (term_id) JOIN d USING (term_id) JOIN len USING (doc_id), mean GROUP BY ALL)"""


def rank_sql(scores: str, key: str, doc: str, k: int) -> str:
    return f"SELECT {key}, {doc}, score, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, {doc})::BIGINT AS rank FROM {scores} QUALIFY rank <= {k}"


#: Some sources stand for subjects of the vocabulary, the others are unknown; every ninth level is unknown, every seventh index wrong.
LABEL_SQL = "CASE matiere WHEN 'src1' THEN 'Sciences de la Vie et de la Terre' WHEN 'src2' THEN 'Enseignement Moral et Civique' WHEN 'src3' THEN 'Français' ELSE matiere END"


def with_subjects(rows: DataFrame) -> DataFrame:
    m = F.col("matiere")
    return rows.withColumn("matiere", F.when(m == "src1", "svt").when(m == "src2", "emc").when(m == "src3", "francais").otherwise(m))


# --- text, hashes and ids ---


@query(f"SELECT doc_id, len(t)::BIGINT AS n_tokens, len(list_distinct(t))::BIGINT AS n_terms FROM (SELECT doc_id, {TOKEN_SQL.format('text')} AS t FROM documents)")
def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = text.tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_terms"))


@query(f"SELECT token, ({HASH_SQL.format('token')})::BIGINT AS term_id FROM (SELECT DISTINCT unnest({TOKEN_SQL.format('text')}) AS token FROM benchmark)")
def fnv1a_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "benchmark").select(F.explode(text.tokens(F.col("text"))).alias("token")).distinct()
    return words.select("token", text.fnv1a(F.col("token")).alias("term_id"))


UUID_SQL = "substr(g, 1, 8) || '-' || substr(g, 9, 4) || '-5' || substr(g, 14, 3) || '-' || substr('89ab', (('0x' || substr(g, 17, 1))::INT % 4) + 1, 1) || substr(g, 18, 3) || '-' || substr(g, 21, 12)"
IDS_SQL = f"""{CHUNKS_SQL}, ids AS (SELECT *, {UUID_SQL} AS point_id FROM
  (SELECT *, sha1(unhex('{ids.URL_NAMESPACE}') || encode(sha256(matiere || ':' || niveau || ':' || text))) AS g FROM chunks))"""


@query(f"WITH {IDS_SQL} SELECT point_id, count(*) AS n, max(doc_id) AS doc_id FROM ids GROUP BY ALL")
def point_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_store.points(views.chunks(spark, sf_dir)).groupBy("point_id").agg(F.count("*").alias("n"), F.max("doc_id").alias("doc_id"))


@query(f"WITH {counts_sql('documents', 'doc_id', 'd')} SELECT doc_id, term_id, tf FROM d")
def sparse_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.term_counts(table(spark, sf_dir, "documents"), ["doc_id"])


@query(f"WITH {counts_sql('documents', 'doc_id', 'd')}, {IDF_SQL} SELECT term_id, df, round(idf, 6) AS idf FROM idf")
def idf_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search.inverse_frequencies(search.term_counts(docs, ["doc_id"]), docs.count()).select("term_id", "df", F.round("idf", 6).alias("idf"))


# --- search ---


@query(f"WITH {TF_IDF_SQL} {rank_sql('scores', 'item_id', 'doc_id', 5)}")
def sparse_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.sparse_top(table(spark, sf_dir, "benchmark"), views.index(spark, sf_dir))


@query(f"WITH {BM25_SQL} {rank_sql('scores', 'item_id', 'doc_id', 5)}")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.sparse_top(table(spark, sf_dir, "benchmark"), views.index(spark, sf_dir), scorer="bm25")


LEARNED_SQL = """ql AS (SELECT item_id, token, sqrt(len(token)) AS w FROM q_words), dl AS (SELECT doc_id, token, sqrt(len(token)) AS w FROM d_words),
lidf AS (SELECT token, ln(1 + ((SELECT count(*) FROM documents) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM dl GROUP BY ALL),
lscores AS (SELECT item_id, doc_id, round(sum(ql.w * idf * dl.w), 6) AS score FROM ql JOIN lidf USING (token) JOIN dl USING (token) GROUP BY ALL)"""


@query(f"WITH {counts_sql('benchmark', 'item_id', 'q')}, {counts_sql('documents', 'doc_id', 'd')}, {LEARNED_SQL} {rank_sql('lscores', 'item_id', 'doc_id', 5)}")
def learned_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search by weights that a model gave to tokens; the root of a token's length stands for the model."""
    def weighted(rows: DataFrame, key: str) -> DataFrame:
        each = F.transform(F.array_distinct(text.tokens(F.col("text"))), lambda t: F.struct(F.xxhash64(t).alias("term"), F.sqrt(F.length(t).cast("double")).alias("w")))
        return rows.select(key, "text", F.map_from_entries(each).alias("weights"))

    index = search.index_of(weighted(table(spark, sf_dir, "documents"), "doc_id"))
    return search.sparse_top(weighted(table(spark, sf_dir, "benchmark"), "item_id"), index, scorer="learned")


@query(f"WITH scores AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id) {rank_sql('scores', 'query_id', 'vec_id', 5)}")
def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search.dense_top(rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), rows)


def by_codes(spark: SparkSession, sf_dir: str, prune: bool) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    asked = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return search.ranked(CellIndex(spark, fresh_path(spark, "cells")).build(rows).top(asked, 5, prune=prune)[0], "query_id", "vec_id", 5)


@query(SQL["dense_topk"])
def int8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``dense_topk``: a scan of all eight-bit codes, and exact scores of what their errors leave open."""
    return by_codes(spark, sf_dir, prune=False)


@query(SQL["dense_topk"])
def cell_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``dense_topk``: the cells that may hold one of the best, the nearest first."""
    return by_codes(spark, sf_dir, prune=True)


@query("WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm FROM embeddings) SELECT vec_id, i::BIGINT AS pos, round(v[i] / norm, 6) AS val FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM n)")
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(vectors.unit(F.col("embedding"))).alias("pos", "val"))
    return rows.select("vec_id", (F.col("pos") + 1).cast("long").alias("pos"), F.round("val", 6).alias("val"))


DENSE_LEG_SQL = f"""{CHUNKS_SQL}, context AS (SELECT doc_id, 'Cet extrait provient du programme officiel Éduscol de ' || matiere || ', section « ' || section || ' ».' || chr(10) || chr(10) || text AS text FROM chunks),
{counts_sql('context', 'doc_id', 'x')},
xv AS (SELECT doc_id, term_id % 64 AS dim, sum(tf * CASE WHEN (term_id // 64) % 2 = 0 THEN 1 ELSE -1 END)::BIGINT AS val FROM x GROUP BY ALL HAVING val <> 0),
qv AS (SELECT item_id, term_id % 64 AS dim, sum(tf * CASE WHEN (term_id // 64) % 2 = 0 THEN 1 ELSE -1 END)::BIGINT AS val FROM q GROUP BY ALL HAVING val <> 0),
xn AS (SELECT doc_id, sqrt(sum(val * val)) AS n FROM xv GROUP BY ALL), qn AS (SELECT item_id, sqrt(sum(val * val)) AS n FROM qv GROUP BY ALL),
dots AS (SELECT item_id, doc_id, sum(qv.val * xv.val)::BIGINT AS dot FROM qv JOIN xv USING (dim) GROUP BY ALL),
dscores AS (SELECT item_id, doc_id, round(dot / (qn.n * xn.n), 6) AS score FROM dots JOIN qn USING (item_id) JOIN xn USING (doc_id))"""
LEGS_SQL = f"{TF_IDF_SQL}, {DENSE_LEG_SQL}, s_leg AS ({rank_sql('scores', 'item_id', 'doc_id', 20)}), d_leg AS ({rank_sql('dscores', 'item_id', 'doc_id', 20)}), legs AS (SELECT 1 AS leg, * FROM s_leg UNION ALL SELECT 2, * FROM d_leg)"
RRF_SQL = "fused AS (SELECT item_id, doc_id, round(sum(1 / (60.0::DOUBLE + rank)), 6) AS score FROM legs GROUP BY ALL)"


def hybrid(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Hybrid search of the benchmark's texts; the dense leg is over hashed vectors of texts with their context."""
    return search.hybrid_search(table(spark, sf_dir, "benchmark"), views.index(spark, sf_dir), **options)


@query(f"WITH {LEGS_SQL}, {RRF_SQL} {rank_sql('fused', 'item_id', 'doc_id', 5)}")
def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid(spark, sf_dir)


@query(f"""WITH {LEGS_SQL}, m AS (SELECT *, avg(score) OVER w AS mu, stddev_samp(score) OVER w AS sd FROM legs WINDOW w AS (PARTITION BY leg, item_id)),
fused AS (SELECT item_id, doc_id, round(sum(CASE WHEN coalesce(sd, 0) = 0 THEN 0.5 ELSE (score - (mu - 3 * sd)) / (6 * sd) END), 6) AS score FROM m GROUP BY ALL) {rank_sql('fused', 'item_id', 'doc_id', 5)}""")
def dbsf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid(spark, sf_dir, fusion="dbsf")


FACET_SQL = LEGS_SQL.replace("FROM documents", "FROM docs")


@query(f"WITH docs AS (SELECT * FROM documents WHERE source = 'src3'), {FACET_SQL}, {RRF_SQL} SELECT r.*, c.source_file, c.niveau FROM ({rank_sql('fused', 'item_id', 'doc_id', 5)}) r JOIN chunks c USING (doc_id)")
def hybrid_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = hybrid(spark, sf_dir, facets={"matiere": "src3"})
    return search.with_payload(hits, views.chunks(spark, sf_dir).select("doc_id", "source_file", "niveau"), "doc_id")


# --- chunks ---

LEVELS_SQL = "CASE WHEN source_file LIKE '%\\_cycle4\\_%' ESCAPE '\\' THEN ['cinquieme', 'quatrieme', 'troisieme'] WHEN source_file LIKE '%\\_cycle3\\_%' ESCAPE '\\' THEN ['sixieme'] WHEN source_file LIKE '%\\_college\\_%' ESCAPE '\\' THEN ['sixieme', 'cinquieme', 'quatrieme', 'troisieme'] ELSE ['seconde', 'premiere', 'terminale'] END"
CYCLE_SQL = "CASE WHEN niveau = 'sixieme' THEN 'cycle3' WHEN niveau IN ('cinquieme', 'quatrieme', 'troisieme') THEN 'cycle4' ELSE 'lycee' END"
EXPANDED_SQL = f"{CHUNKS_SQL}, expanded AS (SELECT * EXCLUDE (niveau), unnest({LEVELS_SQL}) AS niveau FROM chunks)"


@query(f"WITH {EXPANDED_SQL} SELECT doc_id, niveau, {CYCLE_SQL} AS cycle FROM expanded")
def level_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.expanded(views.chunks(spark, sf_dir)).select("doc_id", "niveau", "cycle")


@query(f"WITH {CHUNKS_SQL} SELECT {CYCLE_SQL} AS cycle, niveau, count(*) AS n FROM chunks GROUP BY ALL")
def cycle_of_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.chunks(spark, sf_dir).groupBy(vocab.cycle_of(F.col("niveau"), strict=True).alias("cycle"), "niveau").agg(F.count("*").alias("n"))


@query(f"WITH {CHUNKS_SQL} SELECT doc_id, md5(p) AS digest, length(p)::BIGINT AS n_chars FROM (SELECT doc_id, 'Cet extrait provient du programme officiel Éduscol de ' || {LABEL_SQL} || ', section « ' || section || ' ».' || chr(10) || chr(10) || text AS p FROM chunks)")
def contextual_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = text.contextual(vocab.label_of(F.col("matiere")), F.col("section"), F.col("text"))
    return with_subjects(views.chunks(spark, sf_dir)).select("doc_id", F.md5(p).alias("digest"), F.length(p).cast("long").alias("n_chars"))


@query(f"""WITH {CHUNKS_SQL}, c AS (SELECT *, CASE WHEN doc_id % 9 = 0 THEN 'maternelle' ELSE niveau END AS level, CASE WHEN doc_id % 7 = 0 THEN -1 ELSE chunk_index END AS i FROM chunks)
SELECT CASE WHEN level = 'maternelle' THEN 'niveau' WHEN length(text) < 50 THEN 'text' WHEN matiere NOT IN ('src1', 'src2', 'src3') THEN 'matiere' WHEN i < 0 THEN 'chunk_index' ELSE 'valid' END AS reason, count(*) AS n FROM c GROUP BY ALL""")
def validate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_subjects(views.chunks(spark, sf_dir)).withColumn("niveau", F.when(F.col("doc_id") % 9 == 0, "maternelle").otherwise(F.col("niveau")))
    good, bad = ch.divided(rows.withColumn("chunk_index", F.when(F.col("doc_id") % 7 == 0, -1).otherwise(F.col("chunk_index"))))
    return good.withColumn("reason", F.lit("valid")).unionByName(bad).groupBy("reason").agg(F.count("*").alias("n"))


@query("""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
a AS (SELECT doc_id, min(pos) AS first FROM lines WHERE regexp_matches(line, '^(The|En|Der|La|El) ') GROUP BY ALL),
b AS (SELECT a.doc_id, first, coalesce(min(pos) FILTER (regexp_matches(line, '^(Of|And|De|Und|Y) ') AND pos > first), max(pos) + 1) AS stop FROM a JOIN lines USING (doc_id) GROUP BY ALL)
SELECT doc_id, first::BIGINT AS first, stop::BIGINT AS stop, md5(string_agg(line, chr(10) ORDER BY pos)) AS digest FROM b JOIN lines USING (doc_id) WHERE pos >= first AND pos < stop GROUP BY doc_id, first, stop""")
def section_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ch.sections(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], F.col("clean").rlike("^(The|En|Der|La|El) "), F.col("clean").rlike("^(Of|And|De|Und|Y) "))
    return rows.select("doc_id", F.col("first").cast("long").alias("first"), F.col("stop").cast("long").alias("stop"), F.md5("text").alias("digest"))


@query()
def recursive_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.chunked(views.chunks(spark, sf_dir).select("doc_id", "text"))


@query("SELECT doc_id, md5(text) AS digest FROM documents WHERE text <> ''")
def pieces_join_to_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every text, put together again in their order."""
    cut = ch.pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    whole = cut.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk_index", "text"))).alias("p"))
    return whole.select("doc_id", F.md5(F.array_join(F.transform("p", lambda x: x["text"]), "")).alias("digest"))


@query("WITH one AS (SELECT source, lang, text, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY ALL) SELECT doc_id, first_doc, n FROM documents JOIN one USING (source, lang, text)")
def embed_unique_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.sha2("text", 256).alias("h"))
    one = docs.groupBy("source", "lang", "h").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))
    return docs.join(one, ["source", "lang", "h"]).select("doc_id", "first_doc", "n")


@query(f"""WITH {IDS_SQL}, edits AS (SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN text || ' edited' ELSE text END AS text, chunk_index + 1 AS chunk_index) FROM chunks),
edited AS (SELECT doc_id, chunk_index, 1 AS v, {UUID_SQL} AS point_id FROM (SELECT *, sha1(unhex('{ids.URL_NAMESPACE}') || encode(sha256(matiere || ':' || niveau || ':' || text))) AS g FROM edits)),
al AS (SELECT doc_id, chunk_index, 0 AS v, point_id FROM ids UNION ALL SELECT doc_id, chunk_index, v, point_id FROM edited)
SELECT point_id, doc_id, chunk_index FROM al QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY v DESC, chunk_index DESC) = 1""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.chunks(spark, sf_dir)
    edited = rows.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" edited"))).otherwise(F.col("text"))).withColumn("chunk_index", F.col("chunk_index") + 1)
    keep = ["point_id", "doc_id", "chunk_index"]
    return index_store.upserted(index_store.points(rows).select(keep), index_store.points(edited).select(keep))


@query(f"WITH {CHUNKS_SQL} SELECT matiere, count(*) AS n_points, count(DISTINCT text) AS n_texts, sum(length(text))::BIGINT AS n_chars FROM chunks GROUP BY ALL")
def index_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_store.status(views.chunks(spark, sf_dir), "matiere")


@query("SELECT source, doc_id, n, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '…' ELSE text END AS preview FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS n FROM documents) WHERE n <= 3")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = Window.partitionBy("source").orderBy("doc_id")
    rows = table(spark, sf_dir, "documents").withColumn("n", F.row_number().over(first).cast("long")).where("n <= 3")
    return rows.select("source", "doc_id", "n", text.shortened(F.col("text"), 200).alias("preview"))


# --- evaluation ---

QUESTIONS_SQL = f"""words AS (SELECT DISTINCT item_id, unnest({TOKEN_SQL.format('text')}) AS token FROM benchmark), wdf AS (SELECT token, count(*) AS df FROM words GROUP BY ALL),
kw AS (SELECT item_id, token AS keyword FROM words JOIN wdf USING (token) QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY df, token) <= 4),
gold AS (SELECT item_id, min(doc_id) AS gold_id FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY ALL),
hits AS ({rank_sql('scores', 'item_id', 'doc_id', 5)}), ht AS (SELECT hits.*, lower(text) AS t FROM hits JOIN documents USING (doc_id)),
kh AS (SELECT item_id, keyword, min(rank) AS r FROM kw JOIN ht USING (item_id) WHERE contains(t, keyword) GROUP BY ALL),
per AS (SELECT item_id, count(*) AS hits, min(r) AS fr FROM kh GROUP BY ALL), nk AS (SELECT item_id, count(*) AS n FROM kw GROUP BY ALL),
gh AS (SELECT item_id, min(rank) AS gr FROM gold JOIN hits USING (item_id) WHERE doc_id = gold_id GROUP BY ALL),
ev AS (SELECT item_id AS query_id, 'm' || (item_id % 5) AS matiere, coalesce(n, 0)::BIGINT AS n_keywords, coalesce(hits, 0)::BIGINT AS hits, CASE WHEN n > 0 THEN round_even(coalesce(hits, 0) / n, 3) END AS recall_at_k,
  CASE WHEN n > 0 THEN coalesce(hits, 0) = n END AS all_keywords_found, fr::BIGINT AS first_hit_rank, CASE WHEN coalesce(n, 0) > 0 OR gold_id IS NOT NULL THEN coalesce(round_even(1 / fr, 3), 0) END AS mrr,
  gr::BIGINT AS chunk_id_hit_rank, CASE WHEN gold_id IS NOT NULL THEN coalesce(round_even(1 / gr, 3), 0) END AS chunk_id_mrr, coalesce(n, 0) = 0 AND gold_id IS NULL AS skipped
  FROM benchmark LEFT JOIN nk USING (item_id) LEFT JOIN per USING (item_id) LEFT JOIN gold USING (item_id) LEFT JOIN gh USING (item_id))"""
EVAL_SQL = f"{BM25_SQL}, {QUESTIONS_SQL}"
SUMMARY_SQL = """count(*) AS n, count(*) FILTER (skipped) AS n_skipped, count(chunk_id_mrr) AS n_scorable, coalesce(round(count(chunk_id_hit_rank) / nullif(count(chunk_id_mrr), 0), 6), 0) AS cid_recall,
coalesce(round(avg(chunk_id_mrr), 6), 0) AS cid_mrr, coalesce(round(avg(recall_at_k), 6), 0) AS kw_recall, coalesce(round(avg(mrr) FILTER (recall_at_k IS NOT NULL), 6), 0) AS kw_mrr,
count(*) FILTER (all_keywords_found) AS n_all_found, count(*) FILTER (hits > 0) AS n_any_hit FROM ev"""


def scores_of_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the benchmark's questions for BM25; the gold is the first document that holds an item's text."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    gold = containment.holders(items.select(F.col("item_id").alias("query_id"), "text"), docs).groupBy("query_id").agg(F.min("doc_id").cast("string").alias("gold_id"))
    hits = search.sparse_top(items, views.index(spark, sf_dir), scorer="bm25")
    hits = search.with_payload(hits, docs.select("doc_id", "text"), "doc_id").select(F.col("item_id").alias("query_id"), "rank", F.col("doc_id").cast("string").alias("id"), "text")
    return evaluate.question_scores(views.questions(spark, sf_dir).join(gold, "query_id", "left"), hits)


@query(f"WITH {EVAL_SQL} SELECT * FROM ev")
def eval_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores_of_questions(spark, sf_dir)


@query(f"WITH {EVAL_SQL} SELECT {SUMMARY_SQL}")
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.summary(scores_of_questions(spark, sf_dir))


@query(f"WITH {EVAL_SQL} SELECT matiere, {SUMMARY_SQL} GROUP BY ALL")
def eval_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.summary(scores_of_questions(spark, sf_dir), "matiere")


# --- test sets ---


@query(f"""WITH {CHUNKS_SQL}, big AS (SELECT *, md5('42|' || doc_id) AS k, md5('42-cut|' || doc_id) AS c FROM chunks WHERE length(text) >= 200),
per AS (SELECT greatest(1, 200 // count(*)) + 2 AS p FROM (SELECT DISTINCT matiere, niveau FROM big)),
num AS (SELECT *, row_number() OVER (PARTITION BY matiere, niveau ORDER BY k, doc_id) AS n FROM big), taken AS (SELECT * FROM num, per WHERE n <= p),
cut AS (SELECT doc_id, matiere, niveau FROM taken ORDER BY c, doc_id LIMIT 200),
more AS (SELECT doc_id, matiere, niveau FROM num, per WHERE n > p ORDER BY k, doc_id LIMIT (SELECT greatest(0, 200 - count(*)) FROM taken))
SELECT * FROM cut UNION ALL SELECT * FROM more""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = golden.candidates(views.chunks(spark, sf_dir)).select("doc_id", "matiere", "niveau")
    return golden.stratified_sample(rows, 200, ["matiere", "niveau"], "doc_id")


@query(f"""WITH {CHUNKS_SQL}, cand AS (SELECT doc_id, p, k FROM (SELECT doc_id, lower(text) AS t, unnest(list_concat(list_slice(string_split(text, ' '), 1, 7), ['no such word'])) AS k, generate_subscripts(list_concat(list_slice(string_split(text, ' '), 1, 7), ['no such word']), 1) AS p FROM chunks) WHERE contains(t, lower(k))),
kept AS (SELECT doc_id, string_agg(k, '|' ORDER BY p) FILTER (r <= 5) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS r FROM cand) GROUP BY ALL HAVING count(*) >= 2),
ids AS (SELECT doc_id, {UUID_SQL} AS gold_chunk_id FROM (SELECT *, sha1(unhex('{ids.URL_NAMESPACE}') || encode(sha256(matiere || ':' || niveau || ':' || text))) AS g FROM chunks))
SELECT doc_id, gold_chunk_id, keywords FROM kept JOIN ids USING (doc_id)""")
def keyword_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.chunks(spark, sf_dir).withColumn("expected_keywords", F.concat(F.slice(F.split("text", " "), 1, 7), F.array(F.lit("no such word"))))
    return golden.grounded(rows).select("doc_id", "gold_chunk_id", F.array_join("expected_keywords", "|").alias("keywords"))


@query("SELECT conv_id, turn, text AS query FROM conversations WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g') ORDER BY conv_id, turn) = 1")
def query_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", F.col("text").alias("query"))
    return golden.distinct_questions(rows, ["conv_id", "turn"])


@query("""SELECT CASE WHEN NOT length(text) BETWEEN 10 AND 300 THEN 'query' WHEN conv_id % 5 = 0 THEN 'matiere' WHEN conv_id % 7 = 0 THEN 'niveau' WHEN NOT (turn + 1) % 10 BETWEEN 2 AND 8 THEN 'expected_keywords' ELSE 'ok' END AS reason, count(*) AS n
FROM conversations WHERE role = 'user' GROUP BY ALL""")
def question_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").where("role = 'user'").select(
        F.col("text").alias("query"), F.when(F.col("conv_id") % 5 == 0, "musique").otherwise("svt").alias("matiere"), F.when(F.col("conv_id") % 7 == 0, F.lit(None)).otherwise("seconde").alias("niveau"),
        F.array_repeat(F.lit("mot"), ((F.col("turn") + 1) % 10).cast("int")).alias("expected_keywords"))
    return rows.groupBy(F.coalesce(golden.question_fault(), F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


# --- audit ---

TITLES_SQL = r"""lines AS (SELECT doc_id, source AS grp, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
nb AS (SELECT *, coalesce(lag(trim(raw) = '') OVER w, true) AND coalesce(lead(trim(raw) = '') OVER w, true) AS alone, regexp_replace(raw, '\s+$', '') AS line FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
ok AS (SELECT *, regexp_matches(line, '^#{2,4}\s+(.+?)\s*$') AS heading, trim(line) AS s FROM nb),
t0 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(translate(regexp_replace(line, '^#{2,4}\s+(.+?)\s*$', '\1'), chr(61623) || '•▪●', ''), 'EMPHASIS', '\1\2\3\4', 'g'), 'EMPHASIS', '\1\2\3\4', 'g'), 'EMPHASIS', '\1\2\3\4', 'g') AS u FROM ok
  WHERE s <> '' AND substr(s, 1, 2) NOT IN ('- ', '* ', '• ', '→ ') AND s[1] <> '|' AND length(s) - length(replace(s, '|', '')) < 3 AND NOT (regexp_matches(s, '[.:;,]$') AND s[1] <> '#')),
t1 AS (SELECT *, trim(regexp_replace(u, 'EMPHASIS', '\1\2\3\4', 'g')) AS title, length(regexp_replace(line, '[^\p{L}]', '', 'g')) AS nl, length(regexp_replace(line, '[^\p{Lu}]', '', 'g')) AS nu FROM t0),
titles AS (SELECT doc_id, grp, (pos - 1)::BIGINT AS pos, title, CASE WHEN heading THEN 'markdown' ELSE 'heuristic' END AS source FROM t1
  WHERE (heading AND length(title) BETWEEN 3 AND 100) OR (NOT heading AND length(line) BETWEEN 5 AND 80 AND ((nl > 0 AND nu / nl >= 0.6) OR alone) AND length(title) >= 3)
  QUALIFY row_number() OVER (PARTITION BY doc_id, lower(title) ORDER BY pos) = 1)""".replace("EMPHASIS", text.EMPHASIS)


@query(f"WITH {TITLES_SQL} SELECT doc_id, pos, title, source FROM titles")
def title_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.titles(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]).withColumn("pos", F.col("pos").cast("long"))


KEY_SQL = r"trim(regexp_replace(regexp_replace(translate(lower({0}), 'àâäéèêëïîôùûüç', 'aaaeeeeiioouuc'), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))"
COVERED_SQL = f"""{TITLES_SQL}, want AS (SELECT DISTINCT grp, title, source, {KEY_SQL.format('title')} AS k FROM titles), keyed AS (SELECT source AS grp, {KEY_SQL.format('text')} AS t, list_distinct(string_split({KEY_SQL.format('text')}, ' ')) AS w FROM documents),
cov AS (SELECT grp, title, source, CASE WHEN k <> '' AND len(list_distinct(string_split(k, ' '))) = 1 THEN sum(CASE WHEN k = '' THEN 0 ELSE (length(t) - length(replace(t, k, ''))) // length(k) END) >= CASE WHEN source = 'markdown' THEN 1 ELSE 3 END
  ELSE bool_or(contains(t, k) OR (k <> '' AND len(list_distinct(string_split(k, ' '))) >= 3 AND len(list_intersect(w, list_distinct(string_split(k, ' ')))) >= 0.7 * len(list_distinct(string_split(k, ' '))))) END AS covered
  FROM want JOIN keyed USING (grp) GROUP BY grp, title, source, k)"""


def own_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("grp"), "text")
    return audit.covered_titles(audit.titles(docs, ["doc_id", "grp"]), docs, "grp")


@query(f"WITH {COVERED_SQL} SELECT * FROM cov")
def title_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return own_titles(spark, sf_dir)


@query(f"""WITH {COVERED_SQL}, s AS (SELECT source AS grp, sum(length(text))::BIGINT AS source_chars FROM documents GROUP BY ALL),
c AS (SELECT source AS grp, count(*) AS n_chunks, sum(length(text))::BIGINT AS index_chars FROM documents WHERE length(text) >= 200 GROUP BY ALL),
d AS (SELECT grp, sum(length(text))::BIGINT AS distinct_chars FROM (SELECT DISTINCT source AS grp, text FROM documents WHERE length(text) >= 200) GROUP BY ALL),
t AS (SELECT grp, count(*) AS n_titles, count(*) FILTER (covered) AS n_covered FROM cov GROUP BY ALL)
SELECT grp, source_chars, coalesce(index_chars, 0) AS index_chars, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_titles, 0) AS n_titles, coalesce(n_covered, 0) AS n_covered,
round(least(100.0::DOUBLE, 100.0::DOUBLE * coalesce(index_chars, 0) / source_chars), 1) AS text_pct, round(least(100.0::DOUBLE, 100.0::DOUBLE * coalesce(distinct_chars, 0) / source_chars), 1) AS text_distinct_pct,
CASE WHEN n_titles > 0 THEN round(100.0::DOUBLE * n_covered / n_titles, 1) ELSE 0 END AS titles_pct FROM s LEFT JOIN c USING (grp) LEFT JOIN d USING (grp) LEFT JOIN t USING (grp)""")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("grp"), "text")
    return audit.coverage(docs, golden.candidates(docs), own_titles(spark, sf_dir), "grp")


@query(f"WITH w AS (SELECT DISTINCT source AS grp, {KEY_SQL.format('lang')} AS term FROM documents), keyed AS (SELECT source AS grp, {KEY_SQL.format('text')} AS t FROM documents) SELECT grp, term, sum((length(t) - length(replace(t, term, ''))) // length(term))::BIGINT AS n FROM w JOIN keyed USING (grp) GROUP BY ALL")
def occurrence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("grp"), F.col("lang").alias("term"), "text")
    return audit.occurrences(docs.select("grp", "term").distinct(), docs, "grp", "term")


# --- change detection ---

EVENTS_SQL = "e AS (SELECT event_id, ts, user_id::VARCHAR AS resource_id, substr(sha256(coalesce(props, '')), 1, 16) AS checksum FROM events), mid AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS m FROM events)"


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The newest resources of the earlier half of the time, as the state, and of the later half."""
    rows = watch.resources(views.events(spark, sf_dir))
    span = rows.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = span.a + (span.b - span.a) / 2 if span.a else None

    def newest(part: DataFrame) -> DataFrame:
        return part.groupBy("resource_id").agg(F.max_by("checksum", "event_id").alias("checksum"), F.max("event_id").alias("event_id"))

    return newest(rows.where(F.col("ts") <= F.lit(middle))), newest(rows.where(F.col("ts") > F.lit(middle)))


@query(f"""WITH {EVENTS_SQL}, old AS (SELECT resource_id, arg_max(checksum, event_id) AS checksum FROM e, mid WHERE ts <= m GROUP BY ALL), new AS (SELECT resource_id, arg_max(checksum, event_id) AS checksum, max(event_id) AS event_id FROM e, mid WHERE ts > m GROUP BY ALL)
SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.resource_id = new.resource_id AND old.checksum = new.checksum)""")
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    return watch.changed(new, old)


@query(f"""WITH {EVENTS_SQL}, old AS (SELECT resource_id, arg_max(checksum, event_id) AS checksum FROM e, mid WHERE ts <= m GROUP BY ALL), new AS (SELECT resource_id, arg_max(checksum, event_id) AS checksum FROM e, mid WHERE ts > m GROUP BY ALL)
SELECT resource_id, coalesce(new.checksum, old.checksum) AS checksum FROM old FULL JOIN new USING (resource_id)""")
def watch_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    return watch.next_state(old, new, "event_id")


@query("""WITH mid AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS m FROM events), k AS (SELECT event_id, ts, user_id || '|' || event_type || '|' || floor(value)::BIGINT AS sighting FROM events)
SELECT sighting, event_id FROM k, mid WHERE ts > m AND sighting NOT IN (SELECT sighting FROM k, mid WHERE ts <= m) QUALIFY row_number() OVER (PARTITION BY sighting ORDER BY event_id) = 1""")
def seen_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.events(spark, sf_dir).select("event_id", "ts", F.concat_ws("|", "resource_id", "event_type", F.floor("value").cast("string")).alias("sighting"))
    span = rows.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = F.lit(span.a + (span.b - span.a) / 2 if span.a else None)
    return watch.unseen(rows.where(F.col("ts") > middle), rows.where(F.col("ts") <= middle), "sighting", ["event_id"]).select("sighting", "event_id")


TREE_SQL = "(contains(source, 'src1') OR contains(lower(lang), 'fr')) AND contains(lower(substr(text, 1, 80)), 'the')"


@query(f"SELECT doc_id::VARCHAR AS jorftext_id, substr(text, 1, 80) AS titre, source || '/' || (doc_id // 100)::BIGINT AS jo_titre FROM documents WHERE {TREE_SQL}")
def nested_programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of nested feeds: an issue for each source and hundred of ids, with the source's part, the languages' parts below, and links."""
    docs = table(spark, sf_dir, "documents").select("source", "lang", F.concat_ws("/", "source", F.floor(F.col("doc_id") / 100).cast("string")).alias("jo_titre"), F.struct(F.col("doc_id").cast("string").alias("id"), F.substring("text", 1, 80).alias("titre")).alias("link"))
    parts = docs.groupBy("jo_titre", "source", "lang").agg(F.collect_list("link").alias("liensTxt"))
    trees = parts.groupBy("jo_titre", "source").agg(F.collect_list(F.struct(F.col("lang").alias("titre"), "liensTxt")).alias("tms"))
    whole = F.array(F.struct(F.struct(F.struct(F.array(F.struct(F.col("source").alias("titre"), "tms")).alias("tms")).alias("structure")).alias("joCont")))
    return watch.nested_texts(trees.select("jo_titre", F.to_json(F.struct(whole.alias("items"))).alias("content")), ("src1", "fr"), "the")


# --- vectors and files ---


@query("WITH q AS (SELECT quantile_cont(abs(x), 0.99) AS b FROM (SELECT unnest(embedding::DOUBLE[]) AS x FROM embeddings)) SELECT vec_id, i::BIGINT AS pos, round(greatest(-b, least(b, embedding[i]::DOUBLE)) / b * 127)::TINYINT AS code FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings), q")
def int8_quantize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    bound = stats.percentile(rows.select(F.explode("embedding").alias("x")), F.abs(F.col("x").cast("double")), 0.99) or 1.0
    out = rows.select("vec_id", F.posexplode(vectors.quantized(F.col("embedding"), F.lit(bound))).alias("pos", "code"))
    return out.select("vec_id", (F.col("pos") + 1).cast("long").alias("pos"), "code")


@query("SELECT page_id, url FROM pages WHERE url LIKE '%/' AND contains(url, 'example.com')")
def eligible_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages")
    return rows.where(readers.is_download(F.col("url"), "example.com", "/")).select("page_id", "url")
