"""Item-sized windows: the filters lose nothing, walks reach their target, and items that share much cost little."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import op04_decontaminate
from tessera.llm.common import GROUP_BYTES, text_groups, word_bytes, words_of
from tessera.llm.op04_decontaminate import TARGET, Block, classes_of, contaminated, edits_within, enough_walks, sure_pairs

from .test_ops import docs_of, prose


def block_of(items, max_edits=0.2):
    sizes = classes_of(n for n in (len(words_of(t)) for _, t in items) if n)
    return Block(items, max_edits, {s: enough_walks(*b, max_edits, 1, 4, 4, s) for s, b in sizes.items()})


def walked(block, texts, monkeypatch):
    """How many window starts walk when ``block`` looks through ``texts``, and what it finds."""
    counts, keys = [], op04_decontaminate.Walks.keys

    def counted(self, numbers, starts, random):
        counts.append(len(starts))
        return keys(self, numbers, starts, random)

    monkeypatch.setattr(op04_decontaminate.Walks, "keys", counted)
    hits = block.find(texts)
    return counts, hits


def test_windows_with_pairs_of_other_classes_do_not_walk(monkeypatch):
    rng = random.Random(11)
    short, long = prose(rng, 12).lower(), prose(rng, 40).lower()
    block = block_of([(1, short), (2, long)])
    counts, hits = walked(block, [f"{prose(rng, 200)} {long} {prose(rng, 200)}"], monkeypatch)
    assert {i for _, i, *_ in hits} == {2} and len(counts) == 1  # the long class alone


def test_reached_places_equal_a_plain_reading():
    rng = random.Random(4)
    for _ in range(300):
        end, sure, reach = rng.randint(0, 80), rng.randint(1, 6), rng.randint(1, 20)
        at = np.array(sorted(rng.sample(range(80), rng.randint(0, 30))), np.int64)
        runs = [(at[i], at[i + sure - 1]) for i in range(len(at) - sure + 1) if at[i + sure - 1] - at[i] < reach]
        want = [n for n in range(end) if any(b - reach < n < a + reach for a, b in runs)]
        assert Block.reached(at, sure, reach, end).tolist() == want


def test_words_as_bytes_equal_words():
    texts = [None, "", "A b", "ÀÉ x9\u00a0y\u2028z\x1fq_Z\x85w", "".join(map(chr, range(0x250))), "a\n\tb\0C"]
    assert [[w.decode() for w in word_bytes(t)] for t in texts] == [words_of(t) for t in texts]


def test_short_texts_walk_together_and_long_ones_alone():
    gap, texts = op04_decontaminate.GAP, ["a b", None, "", "é" * GROUP_BYTES, "c"] + ["d"] * 50_000
    groups = list(text_groups(pa.array(texts), gap))
    assert [t for _, g in groups for t in g] == texts and [i for i, _ in groups][:3] == [0, 3, 4]
    assert all(len(g) * (1 + gap) <= GROUP_BYTES for _, g in groups[2:]) and len(groups) < 7
    assert list(text_groups(pa.array([], pa.string()))) == []


def edited(rng, words, n):
    w = [[x] for x in words]
    for p in rng.sample(range(len(w)), n):
        w[p] = rng.choice(([], ["zz"], [*w[p], "qq"]))
    return [x for own in w for x in own]


def test_edits_leave_the_pairs_that_filters_ask_for():
    rng = random.Random(1)
    for n in range(1, 60):
        for _ in range(30):
            item = list(range(n))
            text = edited(rng, item, int(0.2 * n))
            pairs = {p for p in zip(text, text[1:], strict=False)}
            assert sum(p in pairs for p in zip(item, item[1:], strict=False)) >= sure_pairs(n, 0.2)


@pytest.mark.parametrize("n", [1, 2, 4, 7, 12, 25, 50, 90])
def test_walks_are_as_long_as_items_and_reach_their_target(n):
    rng = random.Random(n)
    items = [(i, prose(rng, n)) for i in range(60)]
    block = block_of(items)
    assert all(w.size == min(n, op04_decontaminate.PIECE) and w.steps == 2 * w.size for _, _, w, _ in block.classes)
    texts = [f"{prose(rng, 30)} {' '.join(edited(rng, words_of(t), int(0.2 * n)))} {prose(rng, 20)}" for _, t in items]
    want = {(d, i) for d, t in enumerate(texts) for i, (_, item) in enumerate(items) if near(item, t)}
    got = {(d, i) for d, i, *_ in block.find(texts)}
    assert got <= want and len(got & {(i, i) for i in range(60)}) >= (TARGET - 0.02) * 60


def near(item, text):
    ids = {}
    a, b = (np.array([ids.setdefault(w, len(ids)) for w in words_of(t)], np.int64) for t in (item, text))
    most = int(0.2 * len(a))
    return edits_within(a, b, most)[0] <= most


def test_items_that_share_a_prefix_are_counted_at_once():
    rng = random.Random(7)
    prefix = prose(rng, 30)
    block = block_of([(i, f"{prefix} {prose(rng, 14)} {i}") for i in range(10_000)])
    began = time.process_time()
    assert block.find([f"{prose(rng, 50)} {prefix} {prose(rng, 50)}" for _ in range(10)]) == []
    assert time.process_time() - began < 20
    hit = block.find([f"{prose(rng, 50)} {prefix} {block_text(block, 77)}"])
    assert [i for _, i, *_ in hit] == [77] or 77 in {i for _, i, *_ in hit}


def block_text(block, x):
    names = {n: w for w, n in block.ids.items()}
    return " ".join(names[n] for n in block.items[x][1][30:].tolist())


def test_a_target_out_of_reach_is_an_error(monkeypatch):
    monkeypatch.setattr(op04_decontaminate, "MOST_WALKS", 2)
    with pytest.raises(ValueError, match="walks find less than"):
        enough_walks(40, 44, 0.2, 1, 1, 8, 99)


def test_odd_items_and_rows(spark):
    rng = random.Random(3)
    item = prose(rng, 20)
    texts = [None, "", item, f"x {item}", "long " * 100_000 + item, item, "one"]
    bench = spark.createDataFrame([(1, item), (1, item), (None, item), (2, "one"), (3, None), (4, "")], "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    docs = docs_of(spark, texts, extra=True)
    got = sorted(((r.doc_id, r.item_id or 0) for r in contaminated(docs.unionByName(docs.limit(3)), bench).collect()))
    assert got == sorted([(d, i) for d in (2, 2, 3, 4, 5) for i in (0, 1, 1)] + [(6, 2)])
    assert contaminated(docs.limit(0), bench).count() == 0
