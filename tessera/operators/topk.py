"""The best documents of a shard for each query, from blocks of postings with bounds (MaxScore with block maxima)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Postings of a block, and by how much a bound must be below the k-th score to cut: scores are rounded to six decimals.
BLOCK, MARGIN = 128, 2e-6


def block_bounds(tfs: np.ndarray, lengths: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The greatest weight and the least length of a document in each block of postings, and where the blocks of each term begin.

    ``terms`` says where a term's postings begin; a block never holds two terms.
    """
    if not len(tfs):
        return np.empty(0), np.empty(0), np.zeros(1, np.int64)
    sizes = np.diff(np.append(terms, len(tfs)))
    blocks = -(-sizes // BLOCK)
    cuts = np.append(0, np.cumsum(blocks))
    starts = np.repeat(terms, blocks) + (np.arange(cuts[-1]) - np.repeat(cuts[:-1], blocks)) * BLOCK
    return np.maximum.reduceat(tfs, starts), np.minimum.reduceat(lengths, starts), cuts


@dataclass
class Scorer:
    """What a posting adds to a score, before the query's weight: its weight, or with ``mean`` (of lengths) BM25's saturated one."""

    mean: float | None = None
    k1: float = 1.2
    b: float = 0.75

    def __call__(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return tf
        return tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length / self.mean))


@dataclass
class Postings:
    """A term's postings in a shard: places of documents (ascending), weights, and the bounds of each block."""

    docs: np.ndarray
    tfs: np.ndarray
    top_tf: np.ndarray
    low_length: np.ndarray
    bounds: np.ndarray = field(default=None)
    impacts: np.ndarray = field(default=None)


@dataclass
class Work:
    """How many postings there were for the queries, and how many were scored."""

    postings: int = 0
    scored: int = 0


class Shard:
    """The documents of a shard and the postings of the terms that queries ask for."""

    def __init__(self, docs: np.ndarray, lengths: np.ndarray, allowed: np.ndarray | None, facets: np.ndarray | None, scorer: Scorer) -> None:
        self.docs, self.lengths, self.allowed, self.facets, self.scorer = docs, lengths, allowed, facets, scorer
        self.terms: dict[int, Postings] = {}
        self.work = Work()

    def add(self, term: int, docs: np.ndarray, tfs: np.ndarray, top_tf: np.ndarray, low_length: np.ndarray) -> None:
        # the score rises with the weight and falls with the length, so a block's extremes bound all of its postings
        self.terms[term] = Postings(docs, tfs, top_tf, low_length, self.scorer(top_tf, low_length.astype(np.float64)))

    def impacts(self, p: Postings) -> np.ndarray:
        if p.impacts is None:
            p.impacts = self.scorer(p.tfs, self.lengths[p.docs])
        return p.impacts

    def open_to(self, wanted: np.ndarray | None) -> np.ndarray | None:
        """Which documents a query may get: those that all queries may, with the facets that it names (0: any)."""
        mask = self.allowed
        if wanted is not None:
            for j, w in enumerate(wanted):
                if w:
                    own = self.facets[:, j] == w
                    mask = own if mask is None else mask & own
        return mask

    def top(self, weights: dict[int, float], k: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and rounded scores of the ``k`` best documents that share a term, by score, then id.

        Terms go by what they can add at most. While unseen documents may still reach the k-th score so far, all
        postings of a term are added; then only the documents that may reach it are looked up in the blocks that can lift them there.
        """
        own = sorted(((w * float(self.terms[t].bounds.max()), w, self.terms[t]) for t, w in weights.items() if t in self.terms), key=lambda x: -x[0])
        if not own:
            return np.empty(0, np.int64), np.empty(0)
        mask = self.open_to(wanted)
        rest = np.append(np.cumsum([x[0] for x in own][::-1])[::-1], 0.0)  # what terms from i on can add
        self.work.postings += sum(len(p.docs) for _, _, p in own)
        scores, floor, at = np.zeros(len(self.docs)), -1.0, 0
        for at, (_, w, p) in enumerate(own):  # noqa: B007 - where the loop ended
            if rest[at] < floor - MARGIN:
                break
            scores[p.docs] += w * self.impacts(p)
            self.work.scored += len(p.docs)
            if rest[at + 1] < scores.max():
                held = scores if mask is None else np.where(mask, scores, 0.0)
                floor = float(np.partition(held, -k)[-k]) if len(held) >= k else -1.0
        else:
            at += 1
        open_ = scores > 0 if mask is None else (scores > 0) & mask
        found = np.flatnonzero(open_ & (scores + rest[at] >= floor - MARGIN))
        for i in range(at, len(own)):
            _, w, p = own[i]
            place = np.searchsorted(p.docs, found)
            block = np.minimum(place, len(p.docs) - 1) // BLOCK
            found_rest = scores[found] + w * p.bounds[block] + rest[i + 1]
            live = found_rest >= floor - MARGIN
            found, place = found[live], np.minimum(place[live], len(p.docs) - 1)
            hit = p.docs[place] == found
            at_doc = found[hit]
            scores[at_doc] += w * (self.scorer(p.tfs[place[hit]], self.lengths[at_doc]) if p.impacts is None else p.impacts[place[hit]])
            self.work.scored += int(hit.sum())
            found = found[scores[found] + rest[i + 1] >= floor - MARGIN]
        rounded = np.round(scores[found], 6)
        best = np.lexsort((self.docs[found], -rounded))[:k]
        return self.docs[found[best]], rounded[best]
