"""Which texts hold which terms: joins on words, parts of words and windows around spaces, verified on the text.

Terms are never held against all texts. A term of one word is looked for in the words of a group, by a piece of a few bytes; one
of several words by its rarest window around a space. Texts come to the terms they may hold, once. What no term asks for is
left out in the task that reads it, before anything is shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import SLOT_BITS, table_of, term_windows, text_windows, window_counts, word_windows
from ..session import dropped, settled, stored

#: Values of the hashes that ``likely`` goes by: a broadcast has so many rows at most. Terms that are broadcast, at most.
SLOTS, FEW = 1 << SLOT_BITS, 50_000


def occurrences_of(text: Column, term: Column) -> Column:
    """How often a term stands in a text; occurrences don't overlap."""
    return ((F.length(text) - F.length(F.replace(text, term, F.lit("")))) / F.length(term)).cast("long")


def rarest(rows: DataFrame, keys: list[str], piece: str, counts: DataFrame, group: list[str], most: Column | int = 1) -> DataFrame:
    """The ``most`` rarest pieces of each key by ``counts`` (group, piece, df); pieces that are nowhere come first."""
    by = Window.partitionBy(*keys).orderBy(F.coalesce("df", F.lit(0)), piece)
    ranked = rows.join(counts, [*group, piece], "left").withColumn("_n", F.row_number().over(by))
    return ranked.where(F.col("_n") <= most).drop("_n", "df")


def likely(rows: DataFrame, asked: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``by`` is not among the ``asked``: only hashes are compared, in the tasks, and nothing is shuffled."""
    slot = F.pmod(F.xxhash64(*by), F.lit(SLOTS)).alias("_slot")
    return rows.select("*", slot).join(F.broadcast(asked.select(slot).distinct()), "_slot", "left_semi").drop("_slot")


def windows_of(terms: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """(g, k, h), the windows of terms (g, k), and which kinds (before, length) there are."""
    kind = terms.schema["g"].dataType.simpleString()
    own = settled(terms.where("g IS NOT NULL").select("g", "k").mapInArrow(term_windows, f"g {kind}, k string, before int, length int, h long"))
    return own.select("g", "k", "h"), sorted(map(tuple, own.select("before", "length").distinct().collect()))


def asked_bits(own: DataFrame) -> np.ndarray:
    """The table of the slots of the windows ``h``: 128 KB, however many they are."""
    return table_of(own.select(F.shiftrightunsigned("h", 64 - SLOT_BITS).alias("slot")).distinct().toArrow().column(0).to_numpy())


def few(rows: DataFrame) -> DataFrame:
    """Settled ``rows``, to be broadcast where they are few: Spark doesn't know their size."""
    return F.broadcast(rows) if rows.count() <= FEW else rows


def in_words(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """(g, k, n): how often terms of one word (g, k) stand in the texts (g, t) of their group, parts of words included.

    Words come to a term by the piece of it that the fewest terms of the group have.
    """
    own, kinds = windows_of(terms)
    if not kinds:
        return terms.select("g", "k", F.lit(0).cast("long").alias("n"))
    anchors = settled(rarest(own, ["g", "k"], "h", own.groupBy("g", "h").agg(F.count("*").alias("df")), ["g"]))
    kind = texts.schema["g"].dataType.simpleString()
    held = texts.where("g IS NOT NULL").select("g", "t").mapInArrow(word_windows([length for _, length in kinds], asked_bits(anchors)), f"g {kind}, w string, n long, h long")
    met = few(anchors).join(held, ["g", "h"]).select("g", "k", (F.col("n") * occurrences_of(F.col("w"), F.col("k"))).alias("n")).where("n > 0")
    return settled(met.groupBy("g", "k").agg(F.sum("n").alias("n")))


def candidates(anchors: DataFrame, held: DataFrame, by: str, texts: DataFrame) -> DataFrame:
    """(g, id, t, ks): the texts (g, id, t) that hold, by ``held`` (g, id, by), anchors (g, k, by) of terms, each once with the list of these terms."""
    listed = settled(few(anchors).join(held, ["g", by]).groupBy("g", "id").agg(F.collect_set("k").alias("ks")))
    return likely(texts, listed, ["id"]).join(listed, ["g", "id"]).select("g", "id", "t", "ks")


def in_windows(terms: DataFrame, texts: DataFrame, count: Column) -> DataFrame:
    """(g, k, n) of the terms of several words (g, k) that stand in texts (g, id, t) of their group: ``n`` occurrences where ``count`` says so, else 0."""
    own, kinds = windows_of(terms)
    if not kinds:
        return terms.select("g", "k", F.lit(0).cast("long").alias("n"))
    kind = texts.schema["g"].dataType.simpleString()
    rows = texts.where("g IS NOT NULL").select("g", "id", "t")
    df = rows.mapInArrow(window_counts(kinds, asked_bits(own)), f"g {kind}, h long, df long").groupBy("g", "h").agg(F.sum("df").alias("df"))
    anchors = settled(rarest(own, ["g", "k"], "h", df, ["g"]))
    held = rows.mapInArrow(text_windows(kinds, asked_bits(anchors)), f"g {kind}, id long, h long")
    each = candidates(anchors, held, "h", texts).select("g", "t", F.explode("ks").alias("k"))
    found = each.where(F.contains("t", "k")).select("g", "k", F.when(count, occurrences_of(F.col("t"), F.col("k"))).otherwise(0).alias("n"))
    return settled(found.groupBy("g", "k").agg(F.sum("n").alias("n")))


def sharing(terms: DataFrame, texts: DataFrame, share: float) -> DataFrame:
    """(g, k) of the terms (g, k) of whose distinct words a text (g, id, t) of their group has that share."""
    own = F.array_distinct(F.split("k", " "))
    most = F.size(own) - F.ceil(F.size(own) * share - 1e-9) + 1
    prefix = settled(terms.select("g", "k", F.explode(own).alias("w"), most.alias("most")))
    held = stored(likely(texts.select("g", "id", F.explode(F.array_distinct(F.split("t", " "))).alias("w")), prefix, ["g", "w"]), "held")
    anchors = settled(rarest(prefix, ["g", "k"], "w", held.groupBy("g", "w").agg(F.count("*").alias("df")), ["g"], F.col("most")))
    each = candidates(anchors, held, "w", texts).select("g", F.array_distinct(F.split("t", " ")).alias("ws"), "ks").select("g", "ws", F.explode("ks").alias("k"))
    out = settled(each.where(F.size(F.array_intersect("ws", own)) >= share * F.size(own)).select("g", "k").distinct())
    dropped(held)
    return out


def held_terms(terms: DataFrame, texts: DataFrame, share: float | None = None, least_words: int = 3, count_all: bool = True) -> DataFrame:
    """(g, k, n, inside) of the terms (g, k) that texts (g, text) of their group hold; both are normalised words with single spaces.

    ``n`` sums occurrences over the texts (without ``count_all``, of terms of one distinct word only). ``inside`` tells whether a text
    holds the term as it stands or, with ``share``, that part of its distinct words, if it has ``least_words`` or more: such a
    text has one of the rarest words of a prefix of the term's, by frequency; only terms that stand in no text are looked for by
    this. Terms that no text holds have no row; an empty term is held by no text.
    """
    keys = settled(terms.where("k <> ''").select("g", "k").distinct())
    rows = texts.where("text <> ''").select("g", F.col("text").alias("t"))
    n_words, distinct = F.size(F.split("k", " ")), F.size(F.array_distinct(F.split("k", " ")))
    inside = F.lit(True).alias("inside")
    several = keys.where(n_words > 1)
    if several.isEmpty():
        return in_words(keys, rows).select("g", "k", "n", inside)
    keyed = stored(rows.withColumn("id", F.monotonically_increasing_id()), "texts")
    out = in_words(keys.where(n_words == 1), keyed).select("g", "k", "n", inside)
    whole = in_windows(several, keyed, F.lit(True) if count_all else distinct == 1)
    out = out.unionByName(whole.select("g", "k", "n", inside))
    rest = settled(several.where(distinct >= least_words).join(whole, ["g", "k"], "left_anti")) if share else None
    if rest is not None and not rest.isEmpty():
        out = out.unionByName(sharing(rest, keyed, share).select("g", "k", F.lit(0).cast("long").alias("n"), inside))
    dropped(keyed)
    return out


def holders(passages: DataFrame, docs: DataFrame) -> DataFrame:
    """(query_id, doc_id) for every text of ``docs`` (doc_id, text) that holds a passage (query_id, text) as it is.

    Of a passage of three words or more (between single spaces) the rarest word between its ends says which texts to look at; of a
    shorter one its rarest piece of up to eight characters. Null and empty passages and null texts match nothing.
    """
    own = settled(passages.where("text <> ''").select("query_id", F.col("text").alias("p")))
    long = F.size(F.split("p", " ")) > 2
    texts = docs.where("text <> ''").select("doc_id", "text")
    inner = own.where(long).select("query_id", F.explode(F.array_distinct(F.slice(F.split("p", " "), F.lit(2), F.size(F.split("p", " ")) - 2))).alias("w"))
    parts = [(inner, F.split("text", " "))]
    short = own.where(~long).withColumn("q", F.least(F.length("p"), F.lit(8)))
    for q in sorted(r.q for r in short.select("q").distinct().collect()):
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length("text") - q + 1, F.lit(1))), lambda i, q=q: F.substr(F.col("text"), i, F.lit(q)))
        pieces_of = F.transform(F.sequence(F.lit(1), F.length("p") - q + 1), lambda i, q=q: F.substr(F.col("p"), i, F.lit(q)))
        parts.append((short.where(F.col("q") == q).select("query_id", F.explode(F.array_distinct(pieces_of)).alias("w")), grams))
    out = None
    for wanted, cut in parts:
        asked = wanted.select("w").distinct()
        held = settled(texts.select("doc_id", F.explode(F.array_distinct(cut)).alias("w")).join(asked, "w", "left_semi"))
        anchors = rarest(wanted, ["query_id"], "w", held.groupBy("w").agg(F.count("*").alias("df")), [])
        pairs = anchors.join(held, "w").select("query_id", "doc_id").distinct()
        out = pairs if out is None else out.unionByName(pairs)
    listed = out.join(own, "query_id").groupBy("doc_id").agg(F.collect_set(F.struct("query_id", "p")).alias("ps"))
    met = texts.join(listed, "doc_id").select("doc_id", F.explode(F.filter("ps", lambda x: F.contains(F.col("text"), x["p"]))).alias("hit"))
    return met.select(F.col("hit.query_id").alias("query_id"), "doc_id").distinct()
