"""Token ids of documents in ORC files, in ascending doc_id order, and reading them back.

The files hold doc_id, the file part, the place of a document's first id within the part, n_tokens and ids
(run-length encoded integers). Stripes carry row indexes and a Bloom filter on doc_id, so readers can take
stripes in parallel and skip those without a wanted document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, text_groups
from .tokens import crc32_of, encoder, tokenizer_path

FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, stripe_bytes: int = 16 << 20, file_bytes: int = 64 << 20) -> None:
    """Encodes every whole text (null: empty), appends ``end_id`` and writes the ORC files.

    Rows go to files by ranges of doc_id and stand in ascending order (null first, equal ids by text);
    repeated rows are kept. A file takes about ``file_bytes`` of text, less where the session's shuffle has more partitions
    than that gives files. Only the ids of a part of a batch are in memory at once.
    """
    spark, at = docs.sparkSession, tokenizer or tokenizer_path()
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // file_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, start = encoder(at), TaskContext.get().partitionId(), 0
        for whole in batches:
            for i, texts in text_groups(whole.column("text"), 1):
                b = whole.slice(i, len(texts))
                ids, n = enc.batch(texts, end_id)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(start + ends - n), pa.array(n), lists], ["doc_id", "part", "part_start", "n_tokens", "ids"])
                start += int(ends[-1])

    ordered = docs.select("doc_id", "text").repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    (ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "lz4").option("orc.stripe.size", str(stripe_bytes)).option("orc.create.index", "true")
     .option("orc.row.index.stride", "1000").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids, from the files alone."""
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))  # a row for each file
    before = parts.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return files.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``tokens`` with the unsigned CRC-32 of each row's ids in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            values, off = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array([crc32_of(values[s:e]) for s, e in zip(off[:-1], off[1:], strict=True)], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes the files to the shared folder, reads them back and digests them. An empty table gives no rows."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return with_crc32(read_tokens(docs.sparkSession, path))
