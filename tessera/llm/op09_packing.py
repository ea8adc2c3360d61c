"""Best-fit packing of token pieces into sequences, in rounds.

Partitions pack their pieces by best fit and emit the nearly full bins. Underfull bins go on as items of the
next round, where fewer partitions pack them, until they fit one partition or no longer merge; then all bins stay. Bins keep their
content in place, so a piece's final offset is the sum of the offsets on its way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import crc32_of, encoder, tokenizer_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, item long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: full pieces, the first one holds what is over."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, capacity: int, tokenizer: str | None, end_id: int) -> DataFrame:
    """One row per piece of every whole text (null: empty), with ``end_id`` after the text; item is unique."""
    at = tokenizer or tokenizer_path()
    names = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, number = encoder(at), TaskContext.get().partitionId() << 36
        for b in (whole.slice(i, 250) for whole in batches for i in range(0, whole.num_rows, 250)):
            ids, sizes = enc.batch(b.column("text").to_pylist(), end_id)
            rows, begin = [], 0
            for doc, size in zip(b.column("doc_id").to_pylist(), sizes.tolist(), strict=True):
                for k, (s, n) in enumerate(cut(size, capacity)):
                    rows.append((doc, k, s, n, crc32_of(ids[begin + s : begin + s + n]), number))
                    number += 1
                begin += size
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


class BestFit:
    """Bins by free room; a bit set of the rooms in use finds the tightest bin at once."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.rooms, self.by_room = capacity, 0, [[] for _ in range(capacity + 1)]
        self.used: list[int] = []

    def put(self, size: int) -> tuple[int, int]:
        """The bin and the offset of an item of this size."""
        fits = self.rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            k = self.by_room[room].pop()
            if not self.by_room[room]:
                self.rooms &= ~(1 << room)
        else:
            k, room = len(self.used), self.capacity
            self.used.append(0)
        at = self.used[k]
        self.used[k] += size
        left = room - size
        if left:
            self.by_room[left].append(k)
            self.rooms |= 1 << left
        return k, at


def packer(capacity: int, round_: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs a partition's items (item, size), largest first, and gives item, bin, offset and the bin's fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [(b.column("item").to_numpy(), b.column("size").to_numpy()) for b in batches]
        if not items:
            return
        item, size = (np.concatenate(x) for x in zip(*items, strict=True))
        order = np.lexsort((item, -size))
        fit, bins, offsets = BestFit(capacity), np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        for i, s in zip(order.tolist(), size[order].tolist(), strict=True):
            bins[i], offsets[i] = fit.put(s)
        fill = np.array(fit.used, dtype=np.int64)
        base = (round_ << 56) + (TaskContext.get().partitionId() << 36)
        for i in range(0, len(item), 50_000):
            j = slice(i, i + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (item[j], base + bins[j], offsets[j], fill[bins[j]])], ["item", "bin", "at", "fill"])

    return run


def pack(items: DataFrame, capacity: int = 2048, nearly_full: float = 0.995, per_partition: int = 200_000, fan_in: int = 8) -> DataFrame:
    """(item, sequence_id, offset) for ``items`` (item long unique, size long from 1 to ``capacity``).

    A partition packs about ``per_partition`` items in every round. A round's underfull bins are dealt anew to as few
    partitions as that allows (the next round has a ``fan_in``-th of them at least), until they fit one partition or
    a round lowers the number of bins by less than 2 %; that last round keeps all of its bins.
    """
    todo = items.select("item", "size")
    n = todo.count()
    parts, round_, made = max(1, -(-n // per_partition)), 1, []
    while True:
        spread = todo.repartition(parts, "item") if parts > 1 else todo.coalesce(1)
        done = stored(spread.mapInArrow(packer(capacity, round_), "item long, bin long, at long, fill long"), f"round{round_}")
        made.append(done)
        if parts == 1:
            break
        bins = done.groupBy("bin").agg(F.max("fill").alias("size")).withColumnRenamed("bin", "item")
        under = F.col("size") < int(capacity * nearly_full)
        todo = bins.where(under)
        now, left = bins.agg(F.count("*"), F.count_if(under)).first()
        fewest = max(1, -(-left // per_partition))
        if not left or round_ > 1 and parts == fewest and now > 0.98 * n:
            break
        parts, n = max(fewest, -(-parts // fan_in)), left
        round_ += 1
    placed = None
    for done in reversed(made):  # from the last round down to the pieces
        step = done.select("item", F.col("bin").alias("b"), F.col("at").alias("a"))
        if placed is None:
            placed = step.select("item", F.col("b").alias("sequence_id"), F.col("a").alias("offset"))
        else:
            up = placed.select(F.col("item").alias("b"), "sequence_id", "offset")
            placed = step.join(up, "b", "left").select("item", F.coalesce("sequence_id", "b").alias("sequence_id"), (F.coalesce("offset", F.lit(0)) + F.col("a")).alias("offset"))
    return placed


def pack_documents(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """The pieces of all rows of ``docs`` (doc_id, text) with their sequence and place in it.

    A null text is empty and gives the piece of its end id alone. Null doc_ids and repeated rows are packed as
    rows of their own; other columns are not read. An empty table gives no rows.
    """
    pieces = stored(token_pieces(docs, capacity, tokenizer, end_id), "pieces")
    placed = pack(pieces.select("item", F.col("length").alias("size")), capacity)
    return pieces.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
