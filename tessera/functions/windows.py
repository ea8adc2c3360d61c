"""Windows of terms and texts within a task: pieces of words, or so many bytes before and after a space, as hashes.

A text that holds a term has all windows of the term. Which hashes terms ask for is a table of fixed size, so what no term asks
for never leaves its task; equal hashes of different windows only mean a look at the text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa

#: Bytes before and after a space, and of pieces of words; a term has windows of the first kind that it has room for.
SHAPES, SIZES = ((6, 6), (3, 6), (6, 3), (4, 4), (2, 5), (5, 2), (1, 6), (6, 1), (2, 2), (1, 1)), (8, 4, 2, 1)
BEFORE, AFTER = (max(shape[i] for shape in SHAPES) for i in (0, 1))
#: Bits of a hash that the table of asked windows goes by. Words that a task counts before it passes them on.
SLOT_BITS, MOST_WORDS = 20, 100_000
BASE, MIX = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD

Batches = Iterator[pa.RecordBatch]


class Hashes:
    """Hashes of any windows of some bytes, by sums of powers."""

    up = down = np.ones(1, np.uint64)

    def __init__(self, data: bytes, group: object) -> None:
        n = len(data)
        if n >= len(Hashes.up):
            Hashes.up, Hashes.down = (np.multiply.accumulate(np.array([1] + [x] * 2 * n, np.uint64)) for x in (BASE, pow(BASE, -1, 1 << 64)))
        self.seed = np.uint64(crc32(str(group).encode()) * MIX % (1 << 64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * self.up[:n], out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        h = (self.sums[starts + length] - self.sums[starts]) * self.down[starts] + self.seed
        h ^= h >> np.uint64(33)
        h *= np.uint64(MIX)
        return h ^ (h >> np.uint64(33))


def spaces(data: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(data, np.uint8) == 32)


def term_windows(batches: Batches) -> Batches:
    """(g, k, before, length, h) of batches (g, k): the windows of terms; ``before`` is -1 for pieces of terms of one word."""
    for batch in batches:
        rows = []
        for g, k in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
            data = k.encode()
            at, n = spaces(data), len(data)
            if len(at):
                before, after, starts = next((a, b, s - a) for a, b in SHAPES if len(s := at[(at >= a) & (at < n - b)]))
                length = before + 1 + after
            else:
                before, length = -1, next(q for q in SIZES if q <= n)
                starts = np.arange(n - length + 1)
            rows += [(g, k, before, length, h) for h in np.unique(Hashes(data, g).at(starts, length)).view(np.int64).tolist()]
        g, k, before, length, h = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(g, batch.column(0).type), pa.array(k, pa.string()), pa.array(before, pa.int32()), pa.array(length, pa.int32()), pa.array(h, pa.int64())], ["g", "k", "before", "length", "h"])


def table_of(slots: np.ndarray) -> np.ndarray:
    """The bits of the slots that are asked for."""
    table = np.zeros(1 << SLOT_BITS, bool)
    table[slots] = True
    return np.packbits(table)


def asked_in(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    return table[(h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]


def asked_windows(batch: pa.RecordBatch, kinds: list[tuple[int, int]], table: np.ndarray) -> Iterator[tuple[object, np.ndarray]]:
    """Group and asked windows around spaces, each once, of every text of a batch (g, id, t)."""
    for g, t in zip(batch.column(0).to_pylist(), batch.column(2).cast(pa.binary())):
        data = b"".join((b" " * BEFORE, t.as_py(), b" " * AFTER))
        hashes, at = Hashes(data, g), spaces(data)[BEFORE : -AFTER or None]
        h = np.concatenate([hashes.at(at - before, length) for before, length in kinds])
        yield g, np.unique(h[asked_in(table, h)]).view(np.int64)


def text_windows(kinds: list[tuple[int, int]], bits: np.ndarray) -> Callable[[Batches], Batches]:
    """(g, id, h) of batches (g, id, t): the windows of these kinds (before, length) that are asked for, each once for a text."""

    def out(batches: Batches) -> Batches:
        table = np.unpackbits(bits).astype(bool)
        for batch in batches:
            found = [h for _, h in asked_windows(batch, kinds, table)]
            if found:
                place = pa.array(np.repeat(np.arange(len(found)), [len(h) for h in found]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(place), batch.column(1).take(place), pa.array(np.concatenate(found))], ["g", "id", "h"])

    return out


def window_counts(kinds: list[tuple[int, int]], bits: np.ndarray) -> Callable[[Batches], Batches]:
    """(g, h, df) of batches (g, id, t): in how many texts of the batch the windows stand."""

    def out(batches: Batches) -> Batches:
        table = np.unpackbits(bits).astype(bool)
        for batch in batches:
            found = defaultdict(list)
            for g, h in asked_windows(batch, kinds, table):
                found[g].append(h)
            for g, hs in found.items():
                h, n = np.unique(np.concatenate(hs), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([g], batch.column(0).type).take(pa.array(np.zeros(len(h), np.int64))), pa.array(h), pa.array(n)], ["g", "h", "df"])

    return out


def word_windows(sizes: list[int], bits: np.ndarray) -> Callable[[Batches], Batches]:
    """(g, w, n, h) of batches (g, t): the words of the texts that have a piece of these sizes that is asked for, summed up within the task.

    A task that sees very many words passes them on in parts.
    """

    def out(batches: Batches) -> Batches:
        table, counts, kind = np.unpackbits(bits).astype(bool), defaultdict(Counter), None

        def summed() -> Batches:
            for g, own in counts.items():
                data = b" ".join(own)
                begins, hashes = np.append(0, spaces(data) + 1), Hashes(data, g)
                places, found = [], []
                for size in sizes:
                    h = hashes.at(np.arange(max(len(data) - size + 1, 0)), size)
                    at = np.flatnonzero(asked_in(table, h))
                    places.append(np.searchsorted(begins, at, "right") - 1)
                    found.append(h[at].view(np.int64))
                # a piece counts once for a word; one that goes over its end is nowhere in it
                place, h = np.unique(np.stack([np.concatenate(places), np.concatenate(found)]), axis=1)
                n = np.fromiter(own.values(), np.int64, len(own))[place]
                w = pa.array(list(own), pa.binary()).cast(pa.string()).take(pa.array(place))
                yield pa.RecordBatch.from_arrays([pa.array([g], kind).take(pa.array(np.zeros(len(h), np.int64))), w, pa.array(n), pa.array(h)], ["g", "w", "n", "h"])
            counts.clear()

        for batch in batches:
            kind = batch.column(0).type
            for g, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                counts[g].update(t.as_py().split(b" "))
                if sum(map(len, counts.values())) > MOST_WORDS:
                    yield from summed()
        if counts:
            yield from summed()

    return out
