"""The bound that decides which candidates are verified, and large buckets."""

import random

import numpy as np

from tessera.llm import op05_minhash
from tessera.llm.op05_minhash import most_similar, near_duplicates, opened, summed
from tessera.llm.shingles import shingles, weighted, weighted_jaccard, word_hashes

from .test_ops import docs_of, prose


def test_the_bound_is_never_below_the_similarity_and_far_below_one_for_others():
    rng, levels = random.Random(1), np.random.default_rng(1).integers(0, 64, 1 << 12).astype(np.int16)
    texts = []
    for n in (1, 3, 8, 40, 300, 3000):
        t = prose(rng, n).split()
        for share in (0.0, 0.02, 0.1, 0.5, 1.0):
            texts.append(" ".join(w if rng.random() >= share else rng.choice("xyz") + w for w in t))
    sets = [weighted(shingles(word_hashes(t), 5), levels) for t in texts]
    totals, cells = opened([summed(s) for s in sets])
    for i in range(len(sets)):
        bound = most_similar(totals, cells, totals[i], cells[i])
        own = np.array([weighted_jaccard(sets[i], s) for s in sets])
        assert (bound >= own - 1e-12).all() and bound[i] >= 1 - 1e-12
    a, b = (weighted(shingles(word_hashes(prose(rng, 250)), 5), levels) for _ in range(2))
    assert most_similar(*(x[0] for x in opened([summed(a)])), *(x[0] for x in opened([summed(b)]))) < 0.5


def test_rows_of_large_buckets_are_dealt_and_lose_nothing(spark, monkeypatch):
    rng = random.Random(5)
    shared = prose(rng, 80)
    texts = [f"{shared} {prose(rng, rng.choice([2, 3, 30]))}" for _ in range(160)]
    want = {r.doc_id: r.class_id for r in near_duplicates(docs_of(spark, texts)).collect()}
    monkeypatch.setattr(op05_minhash, "PER_SALT", 7)
    assert want == {r.doc_id: r.class_id for r in near_duplicates(docs_of(spark, texts)).collect()}
    assert 2 < len(set(want.values())) < 160
