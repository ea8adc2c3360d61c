"""Mixing against plain readings of sizes and targets, and the properties of the split tree."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.op12_mixing import halves, mixed, shard_texts, taken

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_targets(sizes):
    """Shares by weight in rounds: what is over a cap goes to the others."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = budget - sum(2 * sizes[s] for s in full)
        unit = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * unit > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else weight[s] * unit for s in order}
        full |= over


def checked(docs, **options):
    mix = mixed(docs, **options)
    got, rows = taken(mix).collect(), docs.collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words(r.text)
    targets = plain_targets(sizes)
    want = Counter((r.doc_id, words(r.text), sizes[r.source], round(targets[r.source], 6)) for r in rows)
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got) == want
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert sum(r.taken for r in got) == sum(round(t) for t in targets.values())
    by_place = {r.place: r.words for r in mix.spans.groupBy("place").agg(F.sum("words").alias("words")).collect()}
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    assert by_place == {i: round(targets[s]) for i, s in enumerate(order) if round(targets[s])}
    return mix, got


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    sizes = {"a": 900, "b": 60, "É": 200, "": 40, None: 120, "zz": 3, "none": 20}
    rows = [(i, " ".join(["w x"] * (0 if s == "none" else rng.choice([0, 1, 7, 30, 150]))), "en", s, 1) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rows += [(7, "copy of one", "en", "a", 1)] * 300 + [(None, None, None, None, None)] * 3 + [(9001, "long " * 60_000, "en", "b", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(5).withColumn("size", F.lit("clash")).withColumn("place", F.lit(1))


def test_mix_meets_targets_to_the_word(docs):
    checked(docs)


def test_mix_in_a_deep_tree_deals_equal_shards_and_disjoint_blocks(docs):
    mix, _ = checked(docs, block=64, per_shard=16, fan_out=2, bits=1)
    slots = mix.spans.select("shard", "slot").distinct().groupBy("shard").count().collect()
    assert len(slots) > 30 and max(r["count"] for r in slots) <= 16
    assert min(r["count"] for r in slots) >= 10  # a block of no more words than were asked may leave a slot empty
    spans = mix.spans.collect()
    seen = Counter()
    for s in spans:
        for w in range(s.first, s.first + s.words):
            seen[s["pass"], s.place, s.doc_start + w] += 1
    assert max(seen.values()) == 1  # a pass takes no word twice
    first = {(p, w) for e, p, w in seen if e == 0}
    assert {(p, w) for e, p, w in seen if e == 1} <= first


def test_mix_agrees_in_reruns_and_other_partitions(docs):
    one = sorted(map(repr, taken(mixed(docs, block=128, per_shard=32)).collect()))
    assert one == sorted(map(repr, taken(mixed(docs.repartition(3, "text"), block=128, per_shard=32)).collect()))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "", "e", "s", 0), (2, " \t", "e", "t", 0)], [(1, "one", "e", "s", 0)]])
def test_mix_of_few_rows(spark, rows):
    checked(spark.createDataFrame(rows, DOCS))


def test_shards_hold_the_words_of_their_spans(docs):
    mix = mixed(docs, block=256, per_shard=32)
    texts = shard_texts(docs, mix)
    assert texts.agg(F.sum(F.size(F.split("text", " ")))).first()[0] == mix.spans.agg(F.sum("words")).first()[0]


def test_splits_keep_both_margins_and_are_fair():
    counts, caps = np.array([50, 0, 200, 7]), np.array([100, 57, 0, 100])
    tables = np.array([halves(np.random.default_rng(i), counts, caps) for i in range(300)])
    assert (tables.sum(axis=2) == counts).all() and (tables.sum(axis=1) == caps).all() and (tables >= 0).all()
    assert np.abs(tables.mean(axis=0) - np.outer(counts, caps) / 257).max() < 1.0
