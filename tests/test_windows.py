"""Windows and words that leave a task: all that terms ask for, and little else."""

import random

import numpy as np
import pyarrow as pa

from tessera.functions import windows
from tessera.functions.windows import table_of, term_windows, text_windows, word_windows

RNG = random.Random(5)


def asked(terms):
    rows = pa.Table.from_batches(term_windows([pa.RecordBatch.from_pydict({"g": [g for g, _ in terms], "k": [k for _, k in terms]})])).to_pylist()
    return rows, table_of(np.array([r["h"] for r in rows], np.int64).view(np.uint64) >> np.uint64(64 - windows.SLOT_BITS))


def batches(rows, **names):
    for i in range(0, len(rows), 7):
        part = rows[i : i + 7]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], kind) for j, kind in enumerate(names.values())], list(names))


def word():
    return "".join(RNG.choice("abcdeé1") for _ in range(RNG.choice([1, 2, 3, 6, 12])))


def test_texts_pass_on_asked_windows_only():
    texts = [("g", i, " ".join(word() for _ in range(300))) for i in range(40)]
    terms = [("g", t[2][j : j + n].strip()) for t in texts[:8] for j, n in ((0, 30), (50, 12), (100, 5)) if " " in t[2][j : j + n].strip()]
    rows, bits = asked(terms)
    got = pa.Table.from_batches(text_windows(sorted({(r["before"], r["length"]) for r in rows}), bits)(batches(texts, g=pa.string(), id=pa.int64(), t=pa.string()))).to_pylist()
    held = {(r["id"], r["h"]) for r in got}
    assert len(held) == len(got) and all((i, r["h"]) in held for r in rows for _, i, t in texts if r["k"] in t)
    assert len(got) < 0.1 * sum(len(t.split(" ")) for _, _, t in texts)  # all pairs of neighbours were shuffled
    other, none = [("h", i, t) for _, i, t in texts], text_windows(sorted({(r["before"], r["length"]) for r in rows}), bits)
    assert sum(len(b) for b in none(batches(other, g=pa.string(), id=pa.int64(), t=pa.string()))) <= 0.1 * len(got)  # equal hashes by chance


def test_texts_pass_on_asked_words_only(monkeypatch):
    monkeypatch.setattr(windows, "MOST_WORDS", 500)
    texts = [(g, " ".join(word() for _ in range(200))) for g in "gh" for _ in range(30)] + [("g", "x" * 100_000 + "cab" + "x" * 9)]
    terms = [("g", k) for k in ("cab", "é1", "b", "abcdabcd", "xxcab", "nowhere")]
    rows, bits = asked(terms)
    got = pa.Table.from_batches(word_windows(sorted({r["length"] for r in rows}), bits)(batches(texts, g=pa.string(), t=pa.string()))).to_pylist()
    for g, k in terms:
        h = min(r["h"] for r in rows if (r["g"], r["k"]) == (g, k))
        assert sum(r["n"] * r["w"].count(k) for r in got if r["g"] == g and r["h"] == h) == sum(t.count(k) for at, t in texts if at == g)
    assert sum(r["g"] != "g" for r in got) <= 0.01 * len(got)  # the words of all groups, with all their pieces, were shuffled
