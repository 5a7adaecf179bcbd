"""Token ids in ORC files: integer run-length encoding, row indexes, Bloom filters on ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldmark.llm.tokenizing import crc32, encoder
from fieldmark.session import measured

ORC = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode whole texts and write (doc_id, n_tokens, part, part_start, ids) in ascending id order.

    Texts move once, to range partitions of their ids, and are encoded there, so that
    each file holds a range of ids: stripe and row-index statistics prune a range, and
    the Bloom filters a single id.  `part_start` counts the ids before a document in its
    file.  Only one row per file has to be summed to know where each file starts.

    A NULL text is empty and has the end id alone.  NULL ids come first; rows of one id
    follow each other by the hash of their text, so that one id, or no id, is not one task.
    Further columns of `docs` are not written.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    place = ["doc_id", F.xxhash64(F.coalesce("text", F.lit("")))]
    ordered = chosen.repartitionByRange(*place).sortWithinPartitions(*place, "text").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids_of = batch.column("doc_id")
            for first, ids, counts in encoder(tokenizer).encode(batch.column("text"), end_id):
                ends = np.cumsum(counts)
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_of.slice(first, len(counts)),
                        pa.array(counts),
                        pa.array(np.full(len(counts), part, np.int32)),
                        pa.array(at + ends - counts),
                        pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32))),
                    ],
                    names=["doc_id", "n_tokens", "part", "part_start", "ids"],
                )
                at += int(ends[-1])

    schema = "doc_id long, n_tokens long, part int, part_start long, ids array<int>"
    ordered.mapInArrow(encode, schema).write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of `write_tokens`, with `start`: the ids of all documents before."""
    rows = spark.read.orc(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, stored: with its size known it is sent to the ids, which stay where they are.
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("__n"))
    files = files.select("part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return rows.join(measured(files), "part").select(
        "doc_id", (F.col("__before") + F.col("part_start")).alias("start"), "n_tokens", "ids"
    )


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the stored ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            sums = [crc32(values[a:b].view(np.uint32)) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return tokens.mapInArrow(digest, schema)
