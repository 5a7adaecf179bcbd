"""Best-fit packing of documents into sequences, under several capacities at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.tokenizing import crc32, encoder
from fieldmark.session import stored

# Pieces packed together.  More pieces leave fewer gaps and take longer.
BLOCK_PIECES = 32_768


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, max_tokens: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: documents as ids, cut only where longer than a sequence.

    No text moves: pieces are made where the texts are read.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_of = batch.column("doc_id")
            for first, ids, counts in encoder(tokenizer).encode(batch.column("text"), end_id):
                ends = np.cumsum(counts)
                n = -(-counts // max_tokens)
                row = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * max_tokens
                length = np.minimum(max_tokens, counts[row] - start)
                begin = (ends - counts)[row] + start
                sums = [crc32(ids[a : a + k]) for a, k in zip(begin, length)]
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(first + row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, max_tokens: int, max_docs: int, max_cost: float, weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, longest first.

    A piece needs its tokens, one document, and its attention cost (length squared).
    Of the open sequences with room for all three, `norm` takes the one whose weighted
    residual vector is shortest afterwards, `dot` the one whose residual vector has the
    largest weighted product with the need.  A new sequence is opened if none has room.
    """
    need_all = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], axis=1) / np.array(
        [max_tokens, max_docs, max_cost], float
    )
    weight = np.asarray(weights, float)
    order = np.argsort(-lengths, kind="stable")
    least = lengths.min() / max_tokens if len(lengths) else 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room, number, used = np.ones((16, 3)), np.zeros(16, np.int64), np.zeros(16, np.int64)
    count, opened = 0, 0
    slack = 1e-12
    for i in order:
        need = need_all[i]
        left = room[:count] - need
        fits = np.flatnonzero((left >= -slack).all(axis=1)) if count else np.zeros(0, np.int64)
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin((weight * left[fits] ** 2).sum(axis=1))]
            else:
                at = fits[np.argmax((weight * need * room[fits]).sum(axis=1))]
        else:
            if count == len(room):
                room, number, used = np.concatenate([room, np.ones_like(room)]), np.concatenate([number, number]), np.concatenate([used, used])
            at, count = count, count + 1
            room[at], number[at], used[at] = 1.0, opened, 0
            opened += 1
        sequence[i], offset[i] = number[at], used[at]
        room[at] -= need
        used[at] += lengths[i]
        if room[at, 0] < least - slack or (room[at] <= slack).any():  # nothing fits any more: the last one takes its place
            count -= 1
            room[at], number[at], used[at] = room[count], number[count], used[count]
    return sequence, offset


def pack(
    pieces: DataFrame,
    max_tokens: int = 4096,
    max_docs: int | None = None,
    max_cost: float | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
    rule: str = "norm",
    block: int = BLOCK_PIECES,
) -> DataFrame:
    """Add sequence_id and offset to rows with (doc_id, piece, length); a NULL length is 0.

    Pieces are spread over blocks of about `block` rows, each packed by
    `best_fit` in a task of its own; a block leaves one open sequence or so.
    `max_docs` and `max_cost` (sum of squared lengths) bind only where given: their
    defaults are what `max_tokens` implies.  `pieces` is read for its count and its
    rows, so store it first if it is costly.

    A piece longer than a sequence, or dearer than `max_cost`, is an error.
    """
    max_docs = max_docs or max_tokens
    max_cost = max_cost or float(max_tokens) ** 2
    if rule not in ("norm", "dot"):
        raise ValueError("rule is 'norm' or 'dot'")
    blocks = max(1, -(-pieces.count() // block))

    def packed(rows: pa.Table) -> pa.Table:
        number = lambda c: pc.fill_null(rows.column(c), 0).to_numpy().astype(np.int64)
        lengths = number("length")
        if len(lengths) and (lengths.max() > max_tokens or float(lengths.max()) ** 2 > max_cost):
            raise ValueError("a piece does not fit into an empty sequence")
        # Only an order is made of the columns; they themselves, NULL ids too, stay as they are.
        keys = [number(c) for c in ("ids_crc32", "piece", "doc_id") if c in rows.column_names]
        order = np.lexsort(keys)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        sequence[order], offset[order] = best_fit(lengths[order], max_tokens, max_docs, max_cost, weights, rule)
        sequence = number("__block") + sequence * blocks
        return rows.drop_columns(["__block"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    rest = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.select(*rest).dtypes) + ", sequence_id long, offset long"
    # By the place of a row, so that many rows of one id, without an id, or equal in all are spread as well.
    spread = pieces.select(*rest).withColumn("__block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    return stored(spread, "blocks").groupBy("__block").applyInArrow(packed, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, max_tokens: int = 4096, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """Pieces of all documents with their place.

    A NULL or empty text is its end id alone.  A row without an id, and each of several
    rows of one id, is a document like any other.
    """
    return pack(stored(token_pieces(docs, tokenizer, end_id, max_tokens, text, doc_id), "pieces"), max_tokens, **limits)
