"""Retrieval evaluation: scores of questions and their roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def question_scores(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """A row of metrics for each question.

    ``questions``: query_id, matiere, expected_keywords (array, may be null), gold_id (string, may be null). ``hits``: query_id,
    rank, id, text. A keyword (duplicates count) is a hit where a result holds it in lower case. Without keywords and gold id
    a question is skipped. mrr is 0 without a hit, also where there are no keywords; chunk_id_mrr is null without a
    gold id. Metrics are rounded half to even to three decimals, before any averaging.
    """
    words = questions.select("query_id", F.posexplode("expected_keywords").alias("k", "keyword"))
    found = words.join(hits, "query_id").where(F.contains(F.lower("text"), F.lower("keyword")))
    per_word = found.groupBy("query_id", "k").agg(F.min("rank").alias("rank")).groupBy("query_id").agg(F.count("*").alias("hits"), F.min("rank").alias("first_hit_rank"))
    gold = questions.where(F.coalesce("gold_id", F.lit("")) != "").select("query_id", "gold_id").join(hits, "query_id").where("id = gold_id").groupBy("query_id").agg(F.min("rank").alias("chunk_id_hit_rank"))
    rows = questions.join(per_word, "query_id", "left").join(gold, "query_id", "left")
    n = F.coalesce(F.size("expected_keywords"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    has_gold = F.coalesce("gold_id", F.lit("")) != ""
    skipped = (n == 0) & ~has_gold
    n_hits = F.coalesce("hits", F.lit(0))
    return rows.select(
        "query_id", "matiere", n.cast("long").alias("n_keywords"), n_hits.cast("long").alias("hits"),
        F.when(n > 0, F.bround(n_hits / n, 3)).alias("recall_at_k"),
        F.when(n > 0, n_hits == n).alias("all_keywords_found"),
        F.col("first_hit_rank").cast("long").alias("first_hit_rank"),
        F.when(~skipped, F.coalesce(F.bround(1 / F.col("first_hit_rank"), 3), F.lit(0.0))).alias("mrr"),
        F.col("chunk_id_hit_rank").cast("long").alias("chunk_id_hit_rank"),
        F.when(has_gold, F.coalesce(F.bround(1 / F.col("chunk_id_hit_rank"), 3), F.lit(0.0))).alias("chunk_id_mrr"),
        skipped.alias("skipped"))


def verdict(scores: DataFrame) -> DataFrame:
    """``scores`` with a word for each question: skipped, all, some or none of its keywords found."""
    word = F.when(F.col("skipped"), "skipped").when(F.col("all_keywords_found"), "all").when(F.col("hits") > 0, "some").otherwise("none")
    return scores.withColumn("verdict", word)


def summary(scores: DataFrame, by: str | None = None) -> DataFrame:
    """Roll-up of question scores, of all or by a column.

    Chunk-id metrics average the questions with a gold id, keyword metrics those with a recall; 0 where there are none.
    """
    kw = F.col("recall_at_k").isNotNull()
    zero = F.lit(0.0)
    aggs = [
        F.count("*").alias("n"), F.count_if("skipped").alias("n_skipped"),
        F.count("chunk_id_mrr").alias("n_scorable"),
        F.coalesce(F.round(F.count("chunk_id_hit_rank") / F.nullif(F.count("chunk_id_mrr"), F.lit(0)), 6), zero).alias("cid_recall"),
        F.coalesce(F.round(F.avg("chunk_id_mrr"), 6), zero).alias("cid_mrr"),
        F.coalesce(F.round(F.avg("recall_at_k"), 6), zero).alias("kw_recall"),
        F.coalesce(F.round(F.avg(F.when(kw, F.col("mrr"))), 6), zero).alias("kw_mrr"),
        F.count_if("all_keywords_found").alias("n_all_found"), F.count_if(F.col("hits") > 0).alias("n_any_hit"),
    ]
    return scores.groupBy(*([by] if by else [])).agg(*aggs)


def ndcg(hits: DataFrame, grades: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, ndcg): graded relevance (query_id, id, grade) of the best ``k`` hits, against the best order of the grades."""
    gain = F.sum((F.pow(F.lit(2.0), "grade") - 1) / F.log2(F.col("rank") + 1.0))
    got = hits.where(F.col("rank") <= k).join(grades, ["query_id", "id"]).groupBy("query_id").agg(gain.alias("dcg"))
    best = grades.withColumn("rank", F.expr("row_number() over (partition by query_id order by grade desc, id)")).where(F.col("rank") <= k).groupBy("query_id").agg(gain.alias("ideal"))
    return best.join(got, "query_id", "left").select("query_id", F.when(F.col("ideal") > 0, F.coalesce("dcg", F.lit(0.0)) / F.col("ideal")).otherwise(0.0).alias("ndcg"))


def precision(hits: DataFrame, grades: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, precision): the share of the best ``k`` places that hold a relevant id (grade above 0)."""
    good = hits.where(F.col("rank") <= k).join(grades.where("grade > 0").select("query_id", "id").distinct(), ["query_id", "id"])
    n = good.groupBy("query_id").agg((F.count("*") / k).alias("precision"))
    return grades.select("query_id").distinct().join(n, "query_id", "left").select("query_id", F.coalesce("precision", F.lit(0.0)).alias("precision"))


def recall(hits: DataFrame, grades: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, recall): the share of the relevant ids that stand among the best ``k``; 0 where none is relevant."""
    relevant = grades.where("grade > 0").select("query_id", "id").distinct()
    n = relevant.groupBy("query_id").agg(F.count("*").alias("n"))
    found = hits.where(F.col("rank") <= k).join(relevant, ["query_id", "id"]).groupBy("query_id").agg(F.count_distinct("id").alias("found"))
    rows = grades.select("query_id").distinct().join(n, "query_id", "left").join(found, "query_id", "left")
    return rows.select("query_id", F.coalesce(F.coalesce("found", F.lit(0)) / F.col("n"), F.lit(0.0)).alias("recall"))
