"""Terms of whole texts within a task: the tokens and hashes of ``text.tokens`` and ``text.fnv1a``, a text at a time."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

from .text import FNV_BASIS, FNV_PRIME, TOKEN

PATTERN = re.compile(TOKEN)


class Terms:
    """Counts the terms of texts; the hashes of tokens are kept, and begun anew where there are too many."""

    def __init__(self, most: int = 300_000) -> None:
        self.most, self.known = most, {}

    def term(self, token: str) -> int:
        h = self.known.get(token)
        if h is None:
            h = FNV_BASIS
            for c in token:
                h = (h ^ ord(c)) * FNV_PRIME & 0xFFFFFFFF
            h &= 0x7FFFFFFF
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[token] = h
        return h

    def counts(self, text: str | None) -> tuple[int, dict[int, int]]:
        """The number of tokens of a text, and how often it has each term; tokens of equal hash are one term."""
        tokens = PATTERN.findall(text.lower()) if text else []
        out: dict[int, int] = {}
        for token, n in Counter(tokens).items():
            h = self.term(token)
            out[h] = out.get(h, 0) + n
        return len(tokens), out


    def in_context(self, context: str, text: str | None, counts: dict[int, int] | None) -> dict[int, int]:
        """The counts of a context; where it is something and then, on a line of its own, the text with these ``counts``, that is read only."""
        if not text or counts is None or not context.endswith(text) or context[: -len(text)][-1:] not in ("", "\n"):
            return self.counts(context)[1]
        out = self.counts(context[: -len(text)])[1]
        for term, n in counts.items():
            out[term] = out.get(term, 0) + n
        return out


def hashed_vector(counts: dict[int, int], dims: int = 64) -> list[float] | None:
    """Signed feature hashing of term counts, as ``vectors.hashed_vectors`` has it; None where nothing is left."""
    terms, n = np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), np.float64, len(counts))
    out = np.bincount(terms % dims, np.where(terms // dims % 2 == 0, n, -n), dims)
    return out.tolist() if out.any() else None
