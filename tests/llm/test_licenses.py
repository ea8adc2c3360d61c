"""Names and versions of licences, and chains against all ways to chain."""

import random

import pytest

from tessera.llm import op01_licenses
from tessera.llm.common import words_of
from tessera.llm.op01_licenses import automaton, chains


def labels_of(text):
    return automaton().scan(words_of(text), 4, 8, 0.6)[2]


@pytest.mark.parametrize(("text", "label"), [
    ("released under GNU GPL v2 or so", "gpl-2.0"), ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("SPDX-License-Identifier: GPL-3.0-only", "gpl-3.0"),
    ("under Creative Commons Attribution-NonCommercial 4.0", "cc-by-nc"), ("Creative Commons Attribution 3.0", "cc-by"), ("the LGPLv3", "lgpl-3.0"), ("GNU Lesser General Public License version 2.1", "lgpl-2.1"),
    ("Licensed under the BSD 2-Clause License", "bsd-2-clause"), ("Licensed under the BSD 3-Clause License", "bsd-3-clause"), ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("GNU General Public License, version 2", "gpl-2.0"), ("Licensed under the GNU General Public License, version 3.", "gpl-3.0"), ("CC BY-NC-SA 4.0", "cc-by-nc-sa"),
])
def test_names_and_versions_are_told_apart(text, label):
    base = {v for p, v in op01_licenses.PHRASES.items() if " ".join(words_of(p)) in " ".join(words_of(text))}
    assert labels_of(text) == {label} | base


def test_words_of_names_alone_say_nothing():
    for text in ("spdx license identifier unknown", "gnu and gpl", "creative commons attribution", "version 2 of the apache", "bsd clause", "gpl v 2 of the"):
        assert labels_of(text) == set(), text


def best_chain(matches, max_gap):
    """The most template words that a chain of matches covers, over all chains."""
    order, best = sorted(matches), 0
    covered = [0] * len(order)
    for i, (at, place, size) in enumerate(order):
        covered[i] = size
        for j, (a, p, n) in enumerate(order[:i]):
            if a + n <= at <= a + n + max_gap and p + n <= place <= p + n + max_gap:
                covered[i] = max(covered[i], covered[j] + size)
        best = max(best, covered[i])
    return best


def test_chains_equal_all_ways_where_matches_do_not_overlap():
    """One template's text with words changed: what is chained covers as much as the best of all chains."""
    rng = random.Random(2)
    for _ in range(200):
        n, at, place, matches = rng.randint(1, 8), 0, 0, []
        for _ in range(n):
            gap, lost = rng.randint(0, 5), rng.randint(0, 5)
            at, place = at + gap, place + lost
            size = rng.randint(4, 12)
            matches.append((at, place, size))
            at, place = at + size, place + size
            if rng.random() < 0.2:
                at += 20  # a new start
        got = chains(matches, 8)
        assert max(c for _, _, c in got) == best_chain(matches, 8)
        assert sum(c for _, _, c in got) == sum(m[2] for m in matches)
