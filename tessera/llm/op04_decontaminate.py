"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

A window of words walks through its CGK embedding: at step j it puts out the word it stands at and moves on
where a random bit of that word for step j says so. A small edit distance becomes a small Hamming distance of
the outputs. Each table hashes a few sampled outputs; a window of a document whose hash equals an item's is a
candidate, and the edit distance of item and text (in words, free ends in the text) decides. Walks are as long as the
items of their class; an item of over PIECE words is several windows of that size, one of which has no more than its
share of the edits. There are as many walks as find the share TARGET of simulated items that have all the edits allowed.

An edit breaks two pairs of neighbouring words at most. So windows with fewer pairs of a class's items than are left after
all edits allowed are passed over, and so are candidates whose own pairs the text lacks; neither loses anything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_groups, word_bytes, words_of
from .shingles import mixed

#: Words of a window at most, and empty words after a text, which no walk goes beyond.
PIECE = 48
GAP = 2 * PIECE + 1
#: The share of items with all the edits allowed that the walks of a class find in a simulation of TRIALS items, and walks at most.
TARGET, TRIALS, MOST_WALKS = 0.99, 300, 256
SCHEMA = "doc_id long, item_id long, start_word long, n_words long, edits long"


def edits_within(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int]:
    """(edits, start, end) of the part of ``text`` nearest to ``item``; edits is ``most`` + 1 where none is near.

    The Sellers recurrence by rows over numpy columns; the running minimum along a row comes from a prefix
    minimum of values less their column.
    """
    n = len(text)
    col = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for i, w in enumerate(item, 1):
        new = np.empty(n + 1, np.int64)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        row = np.minimum.accumulate(new - col) + col
        if row.min() > most:
            return most + 1, 0, 0
    end = int(row.argmin())
    # the start: the same walk backwards from the end, anchored there
    back, best = np.arange(end + 1, dtype=np.int64), None
    rev, ritem = text[:end][::-1], item[::-1]
    for i, w in enumerate(ritem, 1):
        new = np.empty(end + 1, np.int64)
        new[0] = i
        new[1:] = np.minimum(back[:-1] + (rev != w), back[1:] + 1)
        back = np.minimum.accumulate(new - col[: end + 1]) + col[: end + 1]
    best = int(back.argmin())
    return int(row[end]), end - best, end


class Walks:
    """The LSH tables of a class of items with ``low`` words or more."""

    def __init__(self, low: int, walks: int, tables: int, samples: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.size = min(PIECE, low)
        self.steps = 2 * self.size  # a step moves on by half a word on average
        self.tables, self.seeds = tables, rng.integers(0, 1 << 63, (walks, 2), dtype=np.uint64)
        #: For each walk and step, the tables that sample the output of the step.
        self.picked = [[[] for _ in range(self.steps)] for _ in range(walks)]
        for by_step in self.picked:
            for t in range(tables):
                for j in rng.choice(self.steps, min(samples, self.steps), replace=False):
                    by_step[j].append(t)

    def offsets(self, n: int) -> np.ndarray:
        """Where the windows of an item of ``n`` words start: end to end, the last one at its end."""
        return np.append(np.arange(0, n - self.size, self.size), n - self.size)

    def keys(self, numbers: np.ndarray, starts: np.ndarray, random: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(table, 64-bit keys) of the windows at ``starts`` of word ``numbers``, whose words are ``random``; bits 64 steps on come from another word."""
        table = 0
        for seeds, by_step in zip(self.seeds, self.picked, strict=True):
            moves = [mixed(random ^ seed) for seed in seeds]
            at, keys = starts.copy(), [np.full(len(starts), t + 1, np.uint64) for t in range(self.tables)]
            last = max(j for j in range(self.steps) if by_step[j])
            for j in range(last + 1):
                here = numbers.take(at)
                if by_step[j]:
                    out = random.take(here)
                    for t in by_step[j]:
                        keys[t] *= np.uint64(0x9E3779B97F4A7C15)
                        keys[t] ^= keys[t] >> np.uint64(29)
                        keys[t] += out
                at += ((moves[j // 64].take(here) >> np.uint64(j % 64)) & np.uint64(1)).view(np.int64)
            for k in keys:
                yield table, k
                table += 1


def sure_pairs(n: int, max_edits: float) -> int:
    """How many pairs of neighbouring words of an item of ``n`` words are left after all edits allowed."""
    return max(0, n - 1 - 2 * int(max_edits * n))


@lru_cache(maxsize=256)
def enough_walks(low: int, high: int, max_edits: float, walks: int, tables: int, samples: int, seed: int) -> Walks:
    """``walks`` walks or more for items of ``low`` to ``high`` words: as many as find TARGET of simulated items.

    Simulated items are of distinct words and have as many edits as allowed, at random places or at equal distances. An
    error where MOST_WALKS do not reach the target.
    """
    rng = np.random.default_rng(seed)
    items, texts, span = [], [], 2 * high + 2
    for trial in range(TRIALS):
        n, of = (low, high)[trial % 2], 2 + trial * span
        edits = int(max_edits * n)
        at = rng.choice(n, edits, replace=False) if trial % 4 < 2 else np.arange(1, edits + 1) * n // (edits + 1)
        text = [[of + x] for x in range(n)]
        for i, kind, new in zip(at.tolist(), rng.integers(0, 3, edits), range(of + n, of + n + edits), strict=True):
            text[i] = ([], [new], [of + i, new])[kind]
        items.append(np.arange(of, of + n))
        texts.append(np.array([x for own in text for x in own], np.int64))
    random = rng.integers(2, 1 << 63, 2 + TRIALS * span, dtype=np.uint64)

    def laid_out(rows: list[np.ndarray], starts_of: Callable[[int], np.ndarray], after: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begins = np.cumsum([0] + [len(r) + GAP for r in rows])
        starts = [b + starts_of(len(r)) for b, r in zip(begins, rows, strict=False)]
        return np.concatenate([np.append(r, np.full(GAP, after)) for r in rows]), np.concatenate(starts), np.repeat(np.arange(len(rows)), [len(x) for x in starts])

    while True:
        walk = Walks(low, walks, tables, samples, seed)
        (a, a_starts, a_of), (b, b_starts, b_of) = laid_out(items, walk.offsets, 0), laid_out(texts, np.arange, 1)  # a text goes on after an item
        hit = np.zeros(TRIALS, bool)
        for (_, x), (_, y) in zip(walk.keys(a, a_starts, random), walk.keys(b, b_starts, random), strict=True):
            hit[a_of[np.isin(mixed(x ^ a_of.astype(np.uint64)), mixed(y ^ b_of.astype(np.uint64)))]] = True
        if hit.sum() >= TARGET * TRIALS:
            return walk
        if walks >= MOST_WALKS:
            raise ValueError(f"{MOST_WALKS} walks find less than {TARGET:.0%} of items of {low} to {high} words with {max_edits:.0%} edits")
        walks = min(MOST_WALKS, 2 * walks)


def classes_of(lengths: Iterable[int]) -> dict[int, tuple[int, int]]:
    """The classes of items by length: the least and the greatest number of words in each."""
    out: dict[int, tuple[int, int]] = {}
    for n in lengths:
        size = int(2 * np.log2(n))
        low, high = out.get(size, (n, n))
        out[size] = (min(low, n), max(high, n))
    return out


class Block:
    """A block of items, ready to find in texts."""

    def __init__(self, items: list[tuple[int, str]], max_edits: float, walks: dict[int, Walks]) -> None:
        self.max_edits = max_edits
        self.ids: dict[str, int] = {}
        rng = np.random.default_rng(5)
        texts = [(i, words_of(t)) for i, t in items]
        for _, ws in texts:
            for w in ws:
                self.ids.setdefault(w, len(self.ids) + 2)
        #: Random 64-bit words for word numbers; number 0 stands after a text's end, number 1 for any word of no item.
        self.random = np.concatenate([np.arange(2, dtype=np.uint64), rng.integers(2, 1 << 63, len(self.ids), dtype=np.uint64)])
        self.items = [(i, np.array([self.ids[w] for w in ws])) for i, ws in texts if ws]
        own_pairs = [self.pair_keys(ws[:-1], ws[1:]) for _, ws in self.items]
        #: The items' pairs of neighbouring words, and for all items one after the other the numbers of their pairs and words.
        self.pairs = np.unique(np.concatenate([np.empty(0, np.int64), *own_pairs]))
        self.all_pairs = np.searchsorted(self.pairs, np.concatenate([np.empty(0, np.int64), *own_pairs]))
        self.all_words = np.concatenate([np.empty(0, np.int64), *(ws for _, ws in self.items)])
        self.pair_cuts, self.word_cuts = (np.cumsum([0, *map(len, own)]) for own in (own_pairs, [ws for _, ws in self.items]))
        self.numbers = {w.encode(): n for w, n in self.ids.items()}
        self.classes, self.class_pairs = [], []
        for size, (low, high) in sorted(classes_of(len(ws) for _, ws in self.items).items()):
            own = [x for x, (_, ws) in enumerate(self.items) if low <= len(ws) <= high]
            sizes, walk = [len(self.items[x][1]) for x in own], walks[size]
            ends = np.cumsum([0] + [n + GAP for n in sizes])
            numbers = np.concatenate([np.append(self.items[x][1], np.zeros(GAP, np.int64)) for x in own])
            offsets = [walk.offsets(n) for n in sizes]
            starts, of_item, offset = np.concatenate([e + o for e, o in zip(ends, offsets, strict=False)]), np.repeat(own, [len(o) for o in offsets]), np.concatenate(offsets)
            index = []
            for _, k in walk.keys(numbers, starts, self.random):
                o = np.argsort(k, kind="stable")
                index.append((k[o], of_item[o], offset[o]))
            self.classes.append((high, min(sure_pairs(n, max_edits) for n in range(low, high + 1)), walk, index))
            #: Whether a pair is of an item of the class; the last entry is for -1, a pair of no item.
            of_class = np.zeros(len(self.pairs) + 1, bool)
            of_class[np.concatenate([self.all_pairs[self.pair_cuts[x] : self.pair_cuts[x + 1]] for x in own])] = True
            self.class_pairs.append(of_class)

    def pair_keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.random) + b

    def known_pairs(self, w: np.ndarray) -> np.ndarray:
        """For each word of a text the number of the pair that begins there, or -1 where it is no item's."""
        out = np.full(len(w), -1, np.int64)
        at = np.flatnonzero((w[:-1] > 1) & (w[1:] > 1))
        if len(at) and len(self.pairs):
            key = self.pair_keys(w[at], w[at + 1])
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = self.pairs[place] == key
            out[at[hit]] = place[hit]
        return out

    @staticmethod
    def reached(at: np.ndarray, sure: int, reach: int, end: int) -> np.ndarray:
        """The places before ``end`` less than ``reach`` words from all of ``sure`` pairs in a row that lie that near each other; ``at``: where pairs begin."""
        first, last = at[: max(0, len(at) - sure + 1)], at[sure - 1 :]
        near = last - first < reach
        a, b = np.maximum(last[near] - reach + 1, 0), np.minimum(first[near] + reach, end)
        a[1:] = np.maximum(a[1:], b[:-1])  # both ascend, so a place counts once
        n = np.maximum(b - a, 0)
        return np.arange(n.sum()) + np.repeat(a - (np.cumsum(n) - n), n)

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item_id, start, words, edits) of the items near a part of a text; the best place of each pair."""
        get, gap = self.numbers.get, np.zeros(GAP, np.int64)
        laid, begins = [gap[:0]], [0]
        for text in texts:
            own = word_bytes(text)
            laid += np.fromiter(map(get, own, repeat(1)), np.int64, len(own)), gap
            begins.append(begins[-1] + len(own) + GAP)
        w, begin = np.concatenate(laid), np.array(begins)
        pair = self.known_pairs(w)
        paired = np.flatnonzero(pair >= 0)
        end = max(0, len(w) - GAP)
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for (high, sure, walk, index), of_class in zip(self.classes, self.class_pairs, strict=True):
            most = int(self.max_edits * high)
            if sure:  # a window of an item may start anywhere in it
                starts = self.reached(paired[of_class[pair[paired]]], sure, high + most, end)
                starts = starts[w[starts] != 0]
            else:
                starts = np.flatnonzero(w[:end] > 1)
            if not len(starts):
                continue
            # a hit is one number: text, start (one before the text begins at most) and item
            width, n_items = len(w) + GAP + high, len(self.items)
            hits, seen = [np.empty(0, np.int64)], 0
            for t, keys in walk.keys(w, starts, self.random):
                k, x, offset = index[t]
                left = np.searchsorted(k, keys)
                i = np.flatnonzero(k[np.minimum(left, len(k) - 1)] == keys)
                if len(i):
                    left = left[i]
                    count = np.searchsorted(k, keys[i], "right") - left
                    j = np.repeat(left - np.cumsum(count) + count, count) + np.arange(count.sum())
                    doc = np.searchsorted(begin, starts[i], "right") - 1
                    hits.append((np.repeat(doc * width + starts[i] + high, count) - offset[j]) * n_items + x[j])
                    seen += len(j)
                    if seen > 1_000_000:
                        hits = [np.unique(np.concatenate(hits))]
                        seen = 0
            every = np.unique(np.concatenate(hits))
            if len(every):
                place, item = np.divmod(every, n_items)
                doc, at = np.divmod(place, width)
                self.verify(np.stack([doc, at - high, item], axis=1), w, pair, begin, high, most, found)
        return [(doc, self.items[x][0], *hit) for (doc, x), hit in sorted(found.items())]

    @staticmethod
    def counted(every: np.ndarray, cuts: np.ndarray, own: np.ndarray, there: np.ndarray, size: int) -> np.ndarray:
        """How many of the numbers of each item (``own`` from cut to cut) are in a stretch of text."""
        flags = np.zeros(size, np.int64)
        flags[there] = 1
        if there.min(initial=0) < 0:
            flags[-1] = 0  # words that begin no pair of an item
        n = np.diff(cuts)[every]
        ends = np.cumsum(n)
        at = np.arange(n.sum()) + np.repeat(cuts[every] - (ends - n), n)
        sums = np.append(0, np.cumsum(flags[own[at]]))
        return sums[ends] - sums[ends - n]

    def verify(self, hits: np.ndarray, w: np.ndarray, pair: np.ndarray, begin: np.ndarray, high: int, most: int, found: dict[tuple[int, int], tuple[int, int, int]]) -> None:
        """Adds to ``found`` the best place of each text and item of ``hits`` (text, start, item), in order of text and start.

        Starts near each other are one stretch of text; the items held against it are those of which it has enough words and pairs
        (a word that it lacks is an edit), counted for all of them at once, so what many items share costs little.
        """
        cut = np.flatnonzero((np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) > most + 1)) + 1
        for group in np.split(hits, cut):
            doc, a, b = int(group[0, 0]), int(group[0, 1]), int(group[-1, 1])
            a, b = max(int(begin[doc]), a - most), min(int(begin[doc + 1]) - GAP, b + high + 2 * most + 1)
            every = np.unique(group[:, 2])
            words, pairs = self.counted(every, self.word_cuts, self.all_words, w[a:b], len(self.random)), self.counted(every, self.pair_cuts, self.all_pairs, pair[a:b], len(self.pairs) + 1)
            sizes = np.diff(self.word_cuts)[every]
            edits = (self.max_edits * sizes).astype(np.int64)
            for x in every[(words >= sizes - edits) & (pairs >= sizes - 1 - 2 * edits)].tolist():
                allowed = int(self.max_edits * len(self.items[x][1]))
                e, p, q = edits_within(self.items[x][1], w[a:b], allowed)
                if e <= allowed and e < found.get((doc, x), (0, 0, allowed + 1))[2]:
                    found[doc, x] = (a - int(begin[doc]) + p, q - p, e)


def contaminated(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, walks: int = 1, tables: int = 4, samples: int = 4, block_chars: int = 4 << 20) -> DataFrame:
    """The items found in each document: doc_id, item_id, start_word, n_words, edits (one row per pair, its best place).

    An item is found where a part of the text is within ``max_edits`` of its number of words (rounded down), in words of
    lower case without punctuation. Items go to the tasks in blocks of at most ``block_chars`` characters; each
    block meets every whole text. ``walks`` is the least number of walks; a class of items gets as many as find TARGET of
    items at ``max_edits``; an error where that takes over MOST_WALKS. Items and texts without words match nothing (nor do null
    and empty ones); texts and items of any length count whole; repeated items and rows give repeated results; ids may
    be null. Other columns are not read. An empty table gives no rows.
    """
    spark, out = docs.sparkSession, None
    size = F.length(F.coalesce("text", F.lit("")))
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    n_blocks = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // block_chars))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    for k in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k) if n_blocks > 1 else items
        rows = [(r.item_id, r.text or "") for r in own.collect()]
        sizes = classes_of(filter(None, (len(words_of(t)) for _, t in rows)))
        enough = {size: enough_walks(*bounds, max_edits, walks, tables, samples, size) for size, bounds in sizes.items()}
        shared = spark.sparkContext.broadcast((rows, enough))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value[0], max_edits, shared.value[1])
            for b in batches:
                ids, rows = b.column("doc_id").to_pylist(), []
                for i, texts in text_groups(b.column("text"), GAP):
                    rows += [(ids[i + d], *hit) for d, *hit in block.find(texts)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names)

        hits = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
        if n_blocks > 1:  # one block at a time in the driver and in the tasks
            hits = stored(hits, "block")
            shared.destroy()
        out = hits if out is None else out.unionByName(hits)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows with a null doc_id stay."""
    bad = stored(contaminated(docs, benchmark, **options).select("doc_id").distinct(), "contaminated")  # a small table joins without a shuffle of texts
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)
