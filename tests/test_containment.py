"""Terms in texts against a plain look at all pairs."""

import random
import time

import pytest

from tessera.operators.containment import held_terms, holders

RNG = random.Random(3)
WORDS = ["a", "ha", "art", "arts", "partie", "de", "la", "des", "nombre", "nombres", "x1", "haha"]


def words(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def plain(terms, texts, share, least=3):
    out = {}
    for g, k in terms:
        n = inside = 0
        own = set(k.split(" "))
        for h, t in texts:
            if h == g and t and k:
                n += t.count(k)
                inside |= k in t or bool(share) and len(own) >= least and len(own & set(t.split(" "))) >= share * len(own)
        if inside:
            out[g, k] = (n, True)
    return out


@pytest.mark.parametrize("share", [None, 0.7, 0.5])
def test_held_terms_equal_all_pairs(spark, share):
    texts = [(RNG.choice("gh"), words(RNG.choice([0, 1, 2, 5, 12]))) for _ in range(60)] + [("g", "art arts"), ("g", "ha ha ha ha"), ("h", None)]
    terms = {(RNG.choice("ghi"), words(RNG.choice([1, 1, 2, 2, 3, 4, 6]))) for _ in range(150)} | {("g", "ha ha"), ("g", "rt ar"), ("g", "t"), ("g", "artie"), ("g", ""), ("g", "ha ha ha"), ("h", "absent"), ("g", "a b absent")}
    rows = held_terms(spark.createDataFrame(list(terms), "g string, k string"), spark.createDataFrame(texts, "g string, text string"), share).collect()
    assert {(r.g, r.k): (r.n, r.inside) for r in rows} == plain(terms, texts, share)
    some = held_terms(spark.createDataFrame(list(terms), "g string, k string"), spark.createDataFrame(texts, "g string, text string"), share, count_all=False).collect()
    assert {(r.g, r.k) for r in some} == set(plain(terms, texts, share))
    assert all((r.n, True) == plain([(r.g, r.k)], texts, share)[r.g, r.k] for r in some if len(set(r.k.split(" "))) == 1)


def test_no_term_or_text(spark):
    terms, texts = spark.createDataFrame([("g", "a b c")], "g string, k string"), spark.createDataFrame([("g", "a b c")], "g string, text string")
    assert held_terms(terms.limit(0), texts, 0.7).count() == 0 == held_terms(terms, texts.limit(0), 0.7).count()


def test_holders_equal_all_pairs(spark):
    docs = {i: "".join(RNG.choice(["é b ", "Cd", "cd ", "\n", "x  y "]) for _ in range(RNG.randrange(40))) for i in range(80)} | {90: None, 91: ""}
    parts = []
    for _ in range(60):
        t = RNG.choice([t for t in docs.values() if t])
        i = RNG.randrange(len(t))
        parts.append(t[i : i + RNG.choice([1, 2, 5, 9, 30])])
    asked = dict(enumerate([*parts, None, "", "absent", "absent word here", "Cd absent cd"]))
    got = {tuple(r) for r in holders(spark.createDataFrame(list(asked.items()), "query_id long, text string"), spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got == {(q, d) for q, p in asked.items() for d, t in docs.items() if p and t and p in t}


def test_words_of_any_length(spark):
    """Pieces of a word are cut in time that grows with the word: this took minutes."""
    long = "ab" * 100_000 + "xyzzy"
    terms = [("g", "xyzzy"), ("g", "bab"), ("g", "ba xyzz"), ("g", "zyzz")]
    texts = [("g", f"begin {long}"), ("g", f"{long[:-5]} xyzzy end")]
    began = time.time()
    rows = held_terms(spark.createDataFrame(terms, "g string, k string"), spark.createDataFrame(texts, "g string, text string")).collect()
    assert {(r.g, r.k): (r.n, r.inside) for r in rows} == plain(terms, texts, None)
    assert time.time() - began < 60


@pytest.mark.parametrize("term", ["a b", "ab cdef", "a bcde", "abcde f", "abcdef ghijkl", "zab cde fghijk", "abcdef ghijk lm", "é b", "été été à"])
def test_windows_of_all_shapes(spark, term):
    texts = [("g", t) for t in (term, f"x{term}y", f"x {term} y {term}", term[1:], term[:-1], term.replace(" ", "  "), "b a")] + [("h", term)]
    rows = held_terms(spark.createDataFrame([("g", term)], "g string, k string"), spark.createDataFrame(texts, "g string, text string")).collect()
    assert {(r.g, r.k): (r.n, r.inside) for r in rows} == plain([("g", term)], texts, None)
