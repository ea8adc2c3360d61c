"""The classifier's evidence against a plain reading of all labelled texts."""

import math
from collections import defaultdict

import pytest
import xxhash

from tessera.llm.common import words_of
from tessera.llm.op03_quality import ALL, ALL_WORDS, BEGINNINGS, ONE, mark_features, train, word_features

from ..conftest import SF


def plain(rows, least=5, least_share=0.002, chi2=16.0):
    """Ratios of marks, and of words with their other words' and odds, from (doc_id, text, junk, toxic)."""
    first = {}
    for doc, text, j, t in sorted(rows):
        key = (tuple(sorted({xxhash.xxh3_64_intdigest(w) for w in words_of(text)})[:2]), j, t)
        first.setdefault(key, (text, j, t))
    marks, words = defaultdict(lambda: [0] * 5), defaultdict(lambda: [0] * 5)
    for out, texts, of in ((marks, [r[1:] for r in rows], mark_features), (words, first.values(), word_features)):
        for text, j, t in texts:
            for x, c in of(text).items():
                out[x] = [a + b for a, b in zip(out[x], (1, j, t, c, c * t), strict=True)]
    total, one, every = marks.pop(ALL), words.pop(ONE), words.pop(ALL_WORDS)

    def told(rows, col, of):
        for x, r in rows.items():
            n, a, share = r[0], r[col], of[col] / of[0]
            e = n * share
            if n >= max(least, least_share * total[0]) and 0 < share < 1 and (a - e) ** 2 / e + (a - e) ** 2 / (n - e) >= chi2:
                yield x, r

    junk = {x: math.log((r[1] + 0.1) / (total[1] + 0.2)) - math.log((r[0] - r[1] + 0.1) / (total[0] - total[1] + 0.2)) for x, r in told(marks, 1, total)}
    bad, good = every[4] + 1, every[3] - every[4] + 1
    toxic = {x: (math.log((r[4] + 0.1) / bad) - math.log((r[3] - r[4] + 0.1) / good), r) for x, r in told(words, 2, one)}
    toxic = {x: v for x, v in toxic.items() if v[0] > 0}
    roots = [r for x, (_, r) in toxic.items() if not any(f"{x[:k]}-" in toxic and f"{x[:k]}-" != x for k in BEGINNINGS)]
    other = math.log(max(1.0, bad - sum(r[4] for r in roots)) / bad) - math.log(max(1.0, good - sum(r[3] - r[4] for r in roots)) / good) if toxic else 0.0
    return junk, {x: v for x, (v, _) in toxic.items()}, other, (math.log(total[1] / (total[0] - total[1])), math.log(total[2] / (total[0] - total[2])))


def test_evidence_equals_a_plain_reading(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    marks, lexicon = train(docs, labels)
    known = {r.doc_id: (int(r.quality == 0), int(r.toxic == 1)) for r in labels.collect()}
    rows = [(r.doc_id, r.text, *known[r.doc_id]) for r in docs.collect() if r.doc_id in known]
    junk, toxic, other, odds = plain(rows)
    assert marks.ratios == pytest.approx(junk) and lexicon.ratios == pytest.approx(toxic) and len(junk) > 3 and len(toxic) > 3
    assert (lexicon.other, marks.odds, lexicon.odds) == pytest.approx((other, *odds))


def test_a_score_adds_each_distinct_word_once():
    from tessera.llm.op03_quality import Lexicon

    model = Lexicon({"bad": 2.0, "nast-": 9.0, "nastily": 0.5}, -0.1, -3.0)
    words = words_of("Bad bad nastier nastily fine words nasty")
    assert model.score("", words) == pytest.approx(-3.0 + 2.0 + 9.0 + 0.5 + 9.0 - 0.1 * 2)  # nastier and nasty by their beginning
