"""Grounded test questions: sampling chunks, checking keywords, removing repeated questions."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import point_id
from ..functions.text import match_key, stripped, tokens
from ..functions.vocab import LEVELS, SUBJECTS
from ..session import settled

MIN_TEXT = 200


def candidates(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.length("text") >= MIN_TEXT)


def stratified_sample(rows: DataFrame, target: int, strata: list[str], row_id: str, seed: int = 42) -> DataFrame:
    """``target`` rows (or all, if fewer; ``row_id`` is unique) spread over the strata.

    Each stratum gives max(1, target / strata) + 2 rows, by the order of a hash of seed and id; leftovers fill up in
    that order; the rows are then ordered by another hash and cut. A stratum can vanish in the cut. Tasks keep the
    first rows of each stratum and the first leftovers, so what is shuffled grows with tasks, strata and target, and a
    stratum of many rows is no large group.
    """
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(row_id).cast("string")))
    n_strata = rows.select(*strata).distinct().count()
    if not n_strata:
        return rows
    per = max(1, target // n_strata) + 2
    hashed = rows.withColumn("_key", key)
    named = hashed.select(F.xxhash64(*strata).alias("stratum"), F.col("_key").alias("key"), F.col(row_id).cast("string").alias("id"))
    first = settled(named.mapInArrow(bottom_keys(per, target), "stratum long, key string, id string"))
    # those of all tasks hold the first of each stratum, and after them the first leftovers
    numbered = first.withColumn("n", F.row_number().over(Window.partitionBy("stratum").orderBy("key", "id")))
    chosen = settled(numbered.withColumn("more", F.col("n") > per).orderBy("more", "key", "id").limit(n_strata * per + target).select("id", "more", "key"))
    taken = chosen.where(~F.col("more"))
    short = target - taken.count()
    cut = F.md5(F.concat_ws("|", F.lit(f"{seed}-cut"), F.col("id")))
    ids = taken.unionByName(chosen.where("more").orderBy("key", "id").limit(short)) if short > 0 else taken.orderBy(cut, "id").limit(target)
    return rows.join(ids.select(F.col("id").alias("_id")), F.col(row_id).cast("string") == F.col("_id"), "left_semi")


def bottom_keys(per: int, more: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's first ``per`` rows (stratum, key, id) by key of each stratum, and its first ``more`` of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pd.DataFrame | None = None
        for b in batches:
            every = b.to_pandas() if held is None else pd.concat([held, b.to_pandas()])
            every = every.sort_values(["key", "id"], kind="stable")
            own = every.groupby("stratum", sort=False).cumcount() < per
            held = pd.concat([every[own], every[~own].head(more)])
        if held is not None:
            yield pa.RecordBatch.from_pandas(held, preserve_index=False)

    return run


def question_fault() -> Column:
    """What is wrong with a question first, or null."""
    n = F.size("expected_keywords")
    return (F.when(F.col("query").isNull() | ~F.length("query").between(10, 300), "query")
            .when(F.col("matiere").isNull() | ~F.col("matiere").isin(*SUBJECTS), "matiere")
            .when(F.col("niveau").isNull() | ~F.col("niveau").isin(*LEVELS), "niveau")
            .when(F.col("expected_keywords").isNull() | ~n.between(2, 8), "expected_keywords"))


def grounded(questions: DataFrame, normalize=match_key) -> DataFrame:  # noqa: ANN001
    """``questions`` (text, query, expected_keywords, matiere, niveau, ...) with the keywords that stand in the text.

    Both are compared after ``normalize``. At most five keywords stay; a question with fewer than two goes. The
    chunk's point id comes along as gold_chunk_id.
    """
    words = questions.withColumn("_id", F.monotonically_increasing_id())
    one = words.select("_id", "text", F.posexplode("expected_keywords").alias("p", "k")).where("k IS NOT NULL")
    kept = one.where(F.contains(normalize("text"), normalize("k"))).groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("p", "k"))).alias("ks")).where(F.size("ks") >= 2)
    out = words.drop("expected_keywords").join(kept, "_id").withColumn("expected_keywords", F.slice(F.transform("ks", lambda s: s["k"]), 1, 5))
    return out.withColumn("gold_chunk_id", point_id(F.col("matiere"), F.col("niveau"), F.col("text"))).drop("_id", "ks")


def distinct_questions(questions: DataFrame, order: list[str]) -> DataFrame:
    """The first by ``order`` of the questions that are equal in lower case without white space at the ends."""
    key = stripped(F.lower(F.col("query")))
    first = Window.partitionBy("_key").orderBy(*order)
    return questions.withColumn("_key", key).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_key", "_n")


def keyword_guesses(chunks: DataFrame, doc: str, n: int = 4) -> DataFrame:
    """(doc, expected_keywords): the ``n`` tokens of a chunk that fewest chunks hold, as keywords without a language model."""
    own = chunks.select(doc, F.explode(F.array_distinct(tokens(F.col("text")))).alias("token"))
    df = own.groupBy("token").agg(F.count("*").alias("df"))
    rare = Window.partitionBy(doc).orderBy("df", "token")
    best = own.join(df, "token").withColumn("n", F.row_number().over(rare)).where(F.col("n") <= n)
    return best.groupBy(doc).agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "token"))), lambda s: s["token"]).alias("expected_keywords"))


def model_answers(chunks: DataFrame, ask: Callable[[str], str], request: Column, attempts: int = 3) -> DataFrame:
    """``chunks`` with what a language model answers to ``request``: query, expected_keywords and fault (null where it is fine).

    ``ask`` is the provider's hook, called in the tasks; a call that raises is repeated, ``attempts`` times in all. The answer has to be
    JSON with a string query and a list of strings expected_keywords, and nothing else; whatever is not is a fault.
    """

    @F.pandas_udf("query string, expected_keywords array<string>, fault string")
    def answered(requests: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one_answer(ask, r, attempts) for r in requests], columns=["query", "expected_keywords", "fault"])

    return chunks.withColumn("_answer", answered(request)).select(*chunks.columns, "_answer.*")


def one_answer(ask: Callable[[str], str], request: str, attempts: int) -> tuple[str | None, list[str] | None, str | None]:
    fault = "no request"
    for _ in range(attempts if request else 0):
        try:
            answer = ask(request)
        except Exception as e:  # noqa: BLE001 - whatever a provider raises is recorded
            fault = f"provider: {e}"
            continue
        return parsed_answer(answer)
    return None, None, fault


def parsed_answer(answer: str) -> tuple[str | None, list[str] | None, str | None]:
    """(query, keywords, fault) of an answer that must be exactly as asked for."""
    try:
        data = json.loads(answer)
    except (TypeError, ValueError):
        return None, None, "no JSON"
    if not isinstance(data, dict) or set(data) != {"query", "expected_keywords"}:
        return None, None, "fields"
    query, words = data["query"], data["expected_keywords"]
    if not isinstance(query, str) or not isinstance(words, list) or not all(isinstance(w, str) for w in words):
        return None, None, "types"
    return query, words, None
