"""Licence scans with a generalised suffix automaton over the words of licence texts.

The automaton is built once over all templates and phrases. Each text is streamed through it word by word,
which gives the matching statistics: the longest match that ends at each word. Long matches are chained
into spans per template; a phrase is found where its words stand consecutively.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import words_of

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licence statements and excerpts of public licence texts, by label.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "mit": [
        "released under the MIT License",
        "This project is released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
        "Licensed under the BSD License",
    ],
    "bsd-2-clause": ["Licensed under the BSD 2-Clause License"],
    "bsd-3-clause": ["Licensed under the BSD 3-Clause License"],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "Licensed under the ISC License",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    ],
    "bsl-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
        "Distributed under the Boost Software License, Version 1.0.",
    ],
    "gpl": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "gpl-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "gpl-3.0": [
        "Licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "lgpl-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "lgpl-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "agpl-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nd": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-nc-sa": ["Licensed under CC BY-NC-SA 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "cc-by-nc-nd": ["Licensed under CC BY-NC-ND 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "CC0 1.0 Universal Public Domain Dedication"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"],
}

#: Public identifiers of licences, and the names that versions of a family go by.
IDENTIFIERS = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib")
GNU = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}
COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def names() -> dict[str, str]:
    """Names of licences, which count where all of their words stand consecutively, and their labels."""
    unversioned = {i: i.lower().removesuffix("-4.0") if i.startswith("CC-") else "cc0" if i == "CC0-1.0" else i.lower() for i in IDENTIFIERS}
    out = {f"SPDX-License-Identifier: {i}": label for i, label in unversioned.items()}
    for short, long in GNU.items():
        for v in ("2", "3") if short == "GPL" else ("2.1", "3") if short == "LGPL" else ("3",):
            label = f"{short.lower()}-{v if '.' in v else v + '.0'}"
            for form in (f"GNU {short} v{v}", f"GNU {short} version {v}", f"{short} version {v}", f"{short}v{v}", f"GNU {short}v{v}", f"GNU {long} v{v}", f"GNU {long} version {v}", f"GNU {long} {v}"):
                out[form] = label
    for short, long in COMMONS.items():
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            out |= {f"Creative Commons {long} {v}": f"cc-{short.lower()}", f"CC {short} {v}": f"cc-{short.lower()}"}
    return out


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"


class Automaton:
    """A generalised suffix automaton of word sequences, with the phrases and templates marked."""

    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str], named: dict[str, str] | None = None) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.texts = [(label, words_of(t)) for label, ts in templates.items() for t in ts]
        self.first: list[int] = [-1]
        for _, ws in self.texts:
            self._add(ws)
        # names come after the base phrases
        self.base, self.phrases = len(phrases), [(label, words_of(p)) for p, label in (phrases | (named or {})).items()]
        for _, ws in self.phrases:
            self._add(ws)
        # where the words of a state occur: (text, end) pairs, passed up the suffix links
        self.ends: list[set[tuple[int, int]]] = [set() for _ in self.len]
        for t, (_, ws) in enumerate(self.texts):
            s = 0
            for i, w in enumerate(ws):
                s = self.next[s][w]
                self.ends[s].add((t, i + 1))
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]
        # phrases that are suffixes of a state's words: (phrase, its length), passed down the suffix links
        own: dict[int, list[tuple[int, int]]] = {}
        for p, (_, ws) in enumerate(self.phrases):
            s = 0
            for w in ws:
                s = self.next[s][w]
            own.setdefault(s, []).append((p, len(ws)))
        self.ending: list[list[tuple[int, int]]] = [[] for _ in self.len]
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.ending[s] = self.ending[self.link[s]] + own.get(s, [])

    def _add(self, words: list[str]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _state(self, length: int, link: int, edges: dict[str, int]) -> int:
        self.len.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.len) - 1

    def _split(self, p: int, q: int, w: str) -> int:
        """A state for the words of ``q`` that follow ``p``, as its own class of end positions."""
        clone = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: str) -> int:
        q = self.next[last].get(w)
        if q is not None:  # another text has led here before
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, w)
        cur, p = self._state(self.len[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, w)
        return cur

    def scan(self, words: list[str], min_match: int, max_gap: int, min_cover: float) -> tuple:
        """Places of phrases, labels of templates, score and spans of one text."""
        nxt, link, length, ending = self.next, self.link, self.len, self.ending
        known, state, n = nxt[0], 0, 0
        places: list[int] = []
        base: set[str] = set()
        spans: list[tuple[int, int, str, int, float]] = []
        matches: list[tuple[int, int, int]] = []  # maximal matches: end, length, state
        for i, w in enumerate(words):
            if w not in known:  # in no template: the match ends
                if n >= min_match:
                    matches.append((i, n, state))
                state = n = 0
                continue
            to = nxt[state].get(w)
            if to is None:
                if n >= min_match:
                    matches.append((i, n, state))
                while to is None:
                    state = link[state]
                    to = nxt[state].get(w)
                n = length[state]
            state, n = to, n + 1
            for p, size in ending[state]:
                if n >= size and p < self.base:
                    places.append(i + 1 - size)
                    base.add(self.phrases[p][0])
                elif n >= size:
                    spans.append((i + 1 - size, i + 1, self.phrases[p][0], size, 1.0))
        if n >= min_match:
            matches.append((len(words), n, state))
        labels, score = set(base), 0.0
        if base:
            score = 1.0
        if matches:
            by: dict[int, list[tuple[int, int, int]]] = {}
            for end, size, s in matches:
                for t, te in self.ends[s]:
                    by.setdefault(t, []).append((end - size, te - size, size))
            for t, own in by.items():
                label, ws = self.texts[t]
                for start, end, covered in chains(own, max_gap):
                    share = min(1.0, covered / len(ws))
                    if share >= min_cover or covered >= 3 * min_match:
                        spans.append((start, end, label, covered, share))
        spans = told_apart(spans)
        labels.update(x[2] for x in spans)
        return places, base, labels, max([score, *(x[4] for x in spans)]), sorted({x[:3] for x in spans})


def told_apart(spans: list[tuple[int, int, str, int, float]]) -> list[tuple[int, int, str, int, float]]:
    """The spans (start, end, label, covered, share) that no other licence covers with more words at the same place."""
    spans = sorted(spans)
    starts, widest = [x[0] for x in spans], max((x[1] - x[0] for x in spans), default=0)

    def around(x: tuple[int, int, str, int, float]) -> list[tuple[int, int, str, int, float]]:
        return spans[bisect_left(starts, x[0] - widest) : bisect_right(starts, x[0])]

    return [x for x in spans if not any(y[2] != x[2] and y[3] > x[3] and x[1] <= y[1] for y in around(x))]


def chains(matches: list[tuple[int, int, int]], max_gap: int) -> list[tuple[int, int, int]]:
    """Chains matches (text place, template place, words) that ascend in both with gaps of at most ``max_gap``.

    A match goes to the chain that ends last before it. Returns start, end and covered template words.
    """
    out: list[list[int]] = []  # start, end, template end, covered
    open_: list[list[int]] = []
    for at, place, size in sorted(matches):
        open_ = [c for c in open_ if at - c[1] <= max_gap]
        for c in reversed(open_):
            skip = max(0, c[1] - at, c[2] - place)
            if skip < size and 0 <= place + skip - c[2] <= max_gap:
                c[1], c[2], c[3] = at + size, place + size, c[3] + size - skip
                break
        else:
            out.append(c := [at, at + size, place + size, size])
            open_.append(c)
    return [(c[0], c[1], c[3]) for c in out]


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton(TEMPLATES, PHRASES, names())


def scan_licenses(docs: DataFrame, min_match: int = 4, max_gap: int = 8, min_cover: float = 0.6) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the licence statements of its whole text.

    n_base counts every place of a base phrase, first_word and last_word are the smallest and largest start
    (null without any). labels adds the templates of which a chain of matches of ``min_match`` or more words,
    with gaps up to ``max_gap``, covers the share ``min_cover`` or 3 * min_match words, and no template of another licence
    more words at the place, and the ``names`` of licences in them. score is the largest
    share covered, 1 where a base phrase or a name stands. A null text counts as empty, texts of any length are read whole, a null
    doc_id stays null, repeated rows give repeated results, other columns are not read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        for b in batches:
            rows: list[tuple] = []
            for text in b.column("text").to_pylist():
                words = words_of(text)
                places, base, labels, score, spans = auto.scan(words, min_match, max_gap, min_cover)
                rows.append((len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, ",".join(f"{x}:{s}:{e}" for s, e, x in spans)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
