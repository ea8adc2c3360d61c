"""Quality classifier by hierarchical empirical Bayes.

Two models of labelled documents, one of junk (quality 0) and one of toxic text, weigh what differs between
the classes: marks of form for junk, words and their beginnings for toxic text. A document's evidence is combined with posteriors of its host (source) and of its path
in it (language): shares of all documents, from grouped sums, shrunk towards the level above by a strength that
the spread between hosts gives.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, words_of

LINE = re.compile(r"[^\n]+")
UPPER, SIGNS, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"*$%&#!|<>{}[]=~^@\\", b"0123456789"
#: Lengths of beginnings of words, longest first.
BEGINNINGS = (6, 5, 4)
#: Features that count documents, those without near copies, and distinct words of the latter.
ALL, ONE, ALL_WORDS = " all", " one", " words"


def style_marks(text: str, words: list[str]) -> list[str]:
    """Categorical marks of a text's form; they hold a character that no word holds."""
    n, raw = max(1, len(text)), text.encode()
    letters = sum(map(len, words)) or 1
    upper, signs, digits = (len(raw) - len(raw.translate(None, kind)) for kind in (UPPER, SIGNS, DIGITS))
    lines = LINE.findall(text)
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    variety = len(set(words)) / len(words) if words else 0.0
    return [f"upper {min(9, int(10 * upper / letters))}", f"signs {min(9, int(40 * signs / n))}", f"digits {min(9, int(20 * digits / n))}", f"lines {int(5 * repeated)}", f"variety {int(8 * variety)}", f"length {len(words).bit_length()}", f"mean {min(15, letters // max(1, len(words)))}"]


def word_features(text: str | None) -> dict[str, int]:
    """Distinct words (1 each), beginnings of words (ending in a hyphen) with how many distinct words share them, the number
    of distinct words, and 1 for the document."""
    own = set(words_of(text))
    out = dict.fromkeys(own, 1)
    for size in BEGINNINGS:
        out.update(Counter([f"{w[:size]}-" for w in own if len(w) > size]))
    return out | {ALL_WORDS: len(own), ONE: 1}


def mark_features(text: str | None) -> dict[str, int]:
    return dict.fromkeys([*style_marks(text or "", words_of(text)), ALL], 1)


@dataclass
class Marks:
    """Naive Bayes over marks of form."""

    ratios: dict[str, float]
    odds: float

    def score(self, text: str, words: list[str]) -> float:
        return self.odds + sum(self.ratios.get(x, 0.0) for x in style_marks(text, words))


@dataclass
class Lexicon:
    """Multinomial naive Bayes over distinct words: those of a lexicon (whole, or by their longest beginning in it) and all others."""

    ratios: dict[str, float]
    other: float
    odds: float

    def score(self, text: str, words: list[str]) -> float:
        get, own = self.ratios.get, set(words)
        out, rest = self.odds, len(own)
        for w in own:
            r = get(w)
            if r is None:
                for size in BEGINNINGS:
                    if len(w) > size and (r := get(f"{w[:size]}-")) is not None:
                        break
            if r is not None:
                out += r
                rest -= 1
        return out + rest * self.other


def logit(p: float) -> float:
    p = min(1 - 1e-6, max(1e-6, p))
    return math.log(p / (1 - p))


def summed_features(held: DataFrame, least: int) -> DataFrame:
    """(x, n, j, t, w, wt) of features of labelled texts (doc_id, text, j, t): documents that hold it, all, junk and toxic;
    distinct words with it, of all and of toxic documents.

    Marks of form count in all texts. Near copies share their two least hashes of words as a rule; of those one counts for
    words. Tasks sum up before the shuffle.
    """
    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = [hash_of(sorted({xxhash.xxh3_64_intdigest(w) for w in words_of(t)})[:2]) for t in b.column("text").to_pylist()]
            yield b.append_column("g", pa.array(g, pa.int64()))

    def sums(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
        by: dict[str, list[int]] = {}
        for b in batches:
            for text, j, t in zip(*(b.column(c).to_pylist() for c in ("text", "j", "t")), strict=True):
                for x, c in of(text).items():
                    own = by.setdefault(x, [0, 0, 0, 0, 0])
                    for i, v in enumerate((1, j, t, c, c * t)):
                        own[i] += v
        keys = list(by)
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([by[x][k] for x in part], pa.int64()) for k in range(5))], ["x", "n", "j", "t", "w", "wt"])

    marked = held.mapInArrow(copies, "doc_id long, text string, j long, t long, g long")
    one = marked.groupBy("g", "j", "t").agg(F.min_by("text", "doc_id").alias("text")).select("text", "j", "t")
    schema = "x string, n long, j long, t long, w long, wt long"
    parts = one.mapInArrow(partial(sums, of=word_features), schema).unionByName(held.select("text", "j", "t").mapInArrow(partial(sums, of=mark_features), schema))
    return parts.groupBy("x").agg(*(F.sum(c).alias(c) for c in ("n", "j", "t", "w", "wt"))).where(F.col("n") >= least)


def hash_of(values: list[int]) -> int:
    return xxhash.xxh3_64_intdigest(repr(values)) - (1 << 63)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 6_000, vocabulary: int = 20_000, least: int = 5, least_share: float = 0.002, chi2: float = 16.0) -> tuple[Marks, Lexicon] | None:
    """Models of junk and of toxic text, from at most ``max_labelled`` labelled documents, chosen by a hash of the id.

    A feature counts where at least ``least`` documents and the share ``least_share`` of all hold it and the numbers of
    documents that do in the two classes differ with the statistic ``chi2``, near copies counted once; the
    ``vocabulary`` largest statistics stay. None without labels.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    marks = stored(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "marks")
    held = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(marks), "doc_id").select("doc_id", "text", (F.coalesce("quality", F.lit(1)) == 0).cast("long").alias("j"), (F.coalesce("toxic", F.lit(0)) == 1).cast("long").alias("t"))
    sums = stored(summed_features(held, least), "features")
    totals = {r.x: r for r in sums.where(F.col("x").isin(ALL, ONE, ALL_WORDS)).collect()}
    if ALL not in totals:
        return None
    total = totals[ALL]
    own = sums.where(~F.col("x").isin(ALL, ONE, ALL_WORDS)).where(F.col("n") >= least_share * total.n)

    def told_by(col: str, rows: DataFrame, ratio, of) -> list:  # noqa: ANN001
        a, n, bad, all_ = F.col(col), F.col("n"), float(of[col]), float(of.n)
        if not 0 < bad < all_:
            return []
        expected = n * bad / all_
        stat = (a - expected) ** 2 / F.greatest(expected, F.lit(1e-9)) + (a - expected) ** 2 / F.greatest(n - expected, F.lit(1e-9))
        return rows.withColumn("stat", stat).where(F.col("stat") >= chi2).withColumn("r", ratio).orderBy(F.desc("stat"), "x").limit(vocabulary).collect()

    j, n = F.col("j"), F.col("n")
    junk = told_by("j", own.where("instr(x, ' ') > 0"), F.log((j + 0.1) / (total.j + 0.2)) - F.log((n - j + 0.1) / (total.n - total.j + 0.2)), total)
    words = totals.get(ALL_WORDS)
    bad, good = (words.wt + 1, words.w - words.wt + 1) if words else (1, 1)
    w, wt = F.col("w"), F.col("wt")
    told = told_by("t", own.where("instr(x, ' ') = 0"), F.log((wt + 0.1) / bad) - F.log((w - wt + 0.1) / good), totals.get(ONE, total))
    told = {r.x: r for r in told if r.r > 0}
    # a word of the lexicon whose beginning stands there too is counted with it
    roots = [r for x, r in told.items() if not any(f"{x[:size]}-" in told and f"{x[:size]}-" != x for size in BEGINNINGS)]
    other = math.log(max(1.0, bad - sum(r.wt for r in roots)) / bad) - math.log(max(1.0, good - sum(r.w - r.wt for r in roots)) / good)
    return Marks({r.x: r.r for r in junk}, logit(total.j / total.n)), Lexicon({x: r.r for x, r in told.items()}, other if told else 0.0, logit(total.t / total.n))


def strength(within: float, spread: float, groups: int, n: float) -> float:
    """How many documents the level above counts for: the variance within groups over that between them.

    ``spread`` is the sum of squares between ``groups`` groups beyond those above (their number taken off) over ``n`` documents.
    """
    between = max(0.0, (spread - groups * within) / n) if n else 0.0
    return min(1e4, max(1.0, within / between)) if between > 0 else 1e4


def shrunk(scored: DataFrame, col: str) -> DataFrame:
    """host, path and ``col``: what a path's posterior adds to the log-odds of its documents.

    ``scored`` has host, path and n, s_<col>: the number of documents of a path and the sum of their probabilities. Hosts are
    shrunk towards the mean of all, paths towards their host, each level by a strength of its own.
    """
    s = f"s_{col}"
    hosts = scored.groupBy("host").agg(F.sum("n").alias("hn"), F.sum(s).alias("hs"), F.count("*").alias("paths"), F.sum(F.col(s) * F.col(s) / F.col("n")).alias("pq"))
    t = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s"), F.count("*").alias("k"), F.sum("paths").alias("p"), F.sum(F.col("hs") * F.col("hs") / F.col("hn")).alias("q"), F.sum("pq").alias("pq")).first()
    mean = (t.s or 0.0) / max(1, t.n or 0)
    within = mean * (1 - mean)
    of_host = strength(within, (t.q or 0.0) - (t.n or 0) * mean * mean, t.k - 1, t.n)
    of_path = strength(within, (t.pq or 0.0) - (t.q or 0.0), (t.p or 0) - t.k, t.n)
    host = hosts.select("host", ((F.col("hs") + of_host * mean) / (F.col("hn") + of_host)).alias("hm"))
    low = F.lit(1e-6)
    post = F.greatest(low, F.least(1 - low, (F.col(s) + of_path * F.col("hm")) / (F.col("n") + of_path)))
    return scored.join(host, "host").select("host", "path", (F.log(post / (1 - post)) - logit(mean)).alias(col))


#: Documents whose probability of being junk or toxic is this or more go: a wrong rejection costs more than a miss.
REJECT = 0.85


def judged(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", **options) -> DataFrame:
    """``docs`` with a struct column ``judged`` added: junk and toxic (probabilities) and bad (that of either).

    A null host or path is one of its own. Texts are scored whole (null: empty); repeated rows are judged alike.
    Without labels every probability is 0. Extra columns stay whatever their names; one named judged is replaced. Texts are
    scored once for the sums of their paths and once for themselves, which costs less than to shuffle or store them.
    """
    models = train(docs, labels, **options)
    docs = docs.drop("judged")
    if models is None:
        zero = F.lit(0.0)
        return docs.withColumn("judged", F.struct(zero.alias("junk"), zero.alias("toxic"), zero.alias("bad")))
    junk, toxic = models

    @F.pandas_udf("junk double, toxic double")
    def evidence(texts: pd.Series) -> pd.DataFrame:
        rows = [(junk.score(t or "", w), toxic.score(t or "", w)) for t in texts for w in (words_of(t),)]  # one text's words at a time
        return pd.DataFrame(rows, columns=["junk", "toxic"], dtype="float64")

    def chance(x):  # noqa: ANN001, ANN202
        return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), x))))

    key = [F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("") for c in (host, path)]
    scored = docs.select(key[0].alias("host"), key[1].alias("path"), evidence("text").alias("e"))
    sums = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(chance(F.col("e.junk"))).alias("s_junk"), F.sum(chance(F.col("e.toxic"))).alias("s_toxic")), "paths")
    names = {c.lower() for c in docs.columns}
    at, shift = (next(x for i in range(len(names) + 1) if (x := f"{name}{i or ''}") not in names) for name in ("at", "shift"))  # no column of docs
    posts = stored(shrunk(sums, "junk").join(shrunk(sums, "toxic"), ["host", "path"]).select(F.struct("host", "path").alias(at), F.struct("junk", "toxic").alias(shift)), "posteriors")
    with_e = docs.withColumn("judged", F.struct(F.struct(key[0].alias("host"), key[1].alias("path")).alias("at"), evidence("text").alias("e")))
    out = with_e.join(posts, F.col("judged.at") == F.col(at), "left")
    j, t = (chance(F.col(f"judged.e.{c}") + F.coalesce(F.col(f"{shift}.{c}"), F.lit(0.0))) for c in ("junk", "toxic"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(j.alias("junk"), t.alias("toxic"), (1 - (1 - j) * (1 - t)).alias("bad")).alias("judged"))


def accepted(docs: DataFrame, labels: DataFrame, most: float = REJECT, **options) -> DataFrame:
    """The rows of ``docs`` whose probability of being junk or toxic is below ``most``, with the columns of ``docs``."""
    out = judged(docs, labels, **options)
    return out.where(F.col("judged.bad") < most).select(*[F.col(f"`{c}`") for c in docs.columns if c != "judged"])
