"""The Merkle manifest against a plain one that sorts each source's rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm.op11_manifest import audited, manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, k):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + k]) for i in range(0, len(levels[-1]), k)])
    return levels


def siblings(levels, i, k):
    for level in levels[:-1]:
        run, at = level[i // k * k : i // k * k + k], i % k
        yield "".join(run[:at]), "".join(run[at + 1 :])
        i //= k


def plain(rows, k=16):
    sources = defaultdict(list)
    for r in rows:
        sources[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted(sources[s], key=lambda x: x[:3]) for s in order}
    trees = {s: tree([x[2] for x in held[s]], k) for s in order}
    top = tree([trees[s][-1][0] for s in order], k)
    for j, s in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(held[s]):
            steps = [*siblings(trees[s], i, k), *siblings(top, j, k)]
            folded = leaf
            if r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                folded = leaf_of(r, r.text.encode().lower().decode())
            for before, after in steps:
                folded = digest(before, folded, after)
            yield r.doc_id, leaf, trees[s][-1][0], top[-1][0], digest(*(b + a for b, a in steps)), folded, folded == top[-1][0]


def key(row):
    return tuple((v is not None, v) for v in row)


def same(docs, k=16):
    got = sorted((tuple(r) for r in audited(docs).select(*COLUMNS).collect()), key=key)
    assert got == sorted(plain(docs.collect(), k), key=key)
    return got


def test_manifest_equals_a_plain_tree_with_ties_and_nulls(spark):
    rng = random.Random(1)
    ids = lambda: rng.choice([None, rng.randrange(-300_000, 300_000), rng.randrange(30), 2**62, -(2**63), 2**63 - 1])
    rows = [(ids(), rng.choice([None, "", "A b"]), None, rng.choice([None, "", "a", "É", "src", "-", "=", "zz"]), 1) for _ in range(1200)]
    rows += [(5, "X", "l", "hot", 1)] * 300 + [(None, str(i), "l", "hot", 1) for i in range(300)]
    got = same(spark.createDataFrame(rows, DOCS).withColumn("tree", F.lit(1)).withColumn("leaf", F.lit("clash")).withColumn("low", F.lit(2)))
    assert 0 < sum(not r[-1] for r in got) < 600


def test_manifest_of_dense_and_sparse_ids_and_many_sources(spark):
    dense = [(i, f"Text {i}", "en", "one", i) for i in range(4600)]
    sparse = [(i * 7_919_333_111, "a", "en", "two", i) for i in range(-150, 150)]
    same(spark.createDataFrame(dense + sparse + [(i, "x " * 50_000 if i == 7 else "y", "en", f"s{i}", 1) for i in range(300)], DOCS))


@pytest.mark.parametrize("rows", [[], [(3, "Q", None, "s", 1)], [(None, None, None, None, None)] * 2])
def test_manifest_of_few_rows(spark, rows):
    same(spark.createDataFrame(rows, DOCS))


def test_hot_copies_are_made_in_steps(spark, monkeypatch):
    from tessera.llm import op11_manifest

    monkeypatch.setattr(op11_manifest, "COPIES", 7)
    same(spark.createDataFrame([(5, "X", "l", "hot", 1)] * 40 + [(6, "y", "l", "hot", 1)], DOCS))


def test_manifest_has_one_root_and_changes_with_any_field(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(60)]
    one = manifest(spark.createDataFrame(rows, DOCS)).root()
    rows[31] = (31, "t31", "fr", "s1", 31)
    assert one != manifest(spark.createDataFrame(rows, DOCS)).root()
