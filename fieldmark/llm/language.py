"""Language of a text by prediction by partial matching over its bytes.

Per language a tree of byte contexts up to `ORDER` bytes is counted.  The code length
of a byte after a context follows escape method C: a context seen n times with t
different next bytes gives a seen byte c/(n+t) and escapes with t/(n+t) to the context
one byte shorter, down to the uniform code over 256 bytes.  The statistics are frozen
after training, so the code length of every (context, byte) that training met is a
number, and a text costs a few array look-ups per byte for all languages at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmark.llm.tokenizing import release
from fieldmark.session import stored

ORDER = 3
UNKNOWN = "und"
SLICE_BYTES = 500_000


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents set aside from every training: crc32 of the id as text mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, label: str, per_label: int, doc_id: str = "doc_id") -> DataFrame:
    """Ids of at most `per_label` labelled documents of each label, by smallest hash of the id.

    Held-out documents are left out.  Only (id, label) pairs are ranked, and the
    ranking is cut to `per_label` rows in each task before anything moves.
    """
    order = Window.partitionBy(label).orderBy(F.xxhash64(doc_id), doc_id)
    known = docs.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(doc_id, label)
    return known.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= per_label).drop("__rank")


def gram_counts(docs: DataFrame, label: str, text: str = "text") -> DataFrame:
    """(label, order, gram, n): counts of all byte strings of 1 to ORDER + 1 bytes, as integers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in pc.unique(batch.column("label")).to_pylist():
                texts = batch.column("text").filter(pc.equal(batch.column("label"), name)).to_pylist()
                found: dict[int, list[np.ndarray]] = {k: [] for k in range(1, ORDER + 2)}
                for one in texts:
                    code = np.frombuffer((one or "").encode(), np.uint8).astype(np.int64)
                    for k, parts in found.items():
                        gram = np.zeros(max(0, len(code) - k + 1), np.int64)
                        for j in range(k):
                            gram = gram * 256 + code[j : len(code) - k + 1 + j]
                        parts.append(gram)
                for k, parts in found.items():
                    grams, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(grams), pa.string()), pa.array(np.full(len(grams), k, np.int32)), pa.array(grams), pa.array(n.astype(np.int64))],
                        names=["label", "order", "gram", "n"],
                    )

    chosen = docs.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"))
    counted = chosen.mapInArrow(count, "label string, order int, gram long, n long")
    return counted.groupBy("label", "order", "gram").agg(F.sum("n").alias("n"))


@dataclass
class ContextTrees:
    """Frozen code lengths in bits.

    A byte string of ORDER + 1 bytes is found by two direct look-ups: its first ORDER
    bytes (in a reduced alphabet) give a context number, and that with the last byte a
    row of `bits`, one column per language.
    """

    languages: list[str]
    symbol: np.ndarray  # byte -> symbol, 0 for bytes never seen
    context: np.ndarray  # ORDER symbols -> context number, 0 where not seen
    row: np.ndarray  # context number x symbols -> row of bits, 0 where not seen
    bits: np.ndarray  # rows x languages
    escape: np.ndarray  # context number x languages: bits to leave the context
    lower: np.ndarray  # symbols of ORDER bytes -> bits without the longest context

    @classmethod
    def fit(cls, counts: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> ContextTrees:
        """`counts` holds (grams, n) per language for lengths 1 to ORDER + 1."""
        languages = sorted(counts)
        seen = sorted({int(g) for name in languages for g in counts[name][0][0]})
        symbol = np.zeros(256, np.int64)
        symbol[seen] = np.arange(1, len(seen) + 1)
        size = len(seen) + 1
        spread = 256 ** np.arange(ORDER + 1)

        def reduced(grams: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros(len(grams), np.int64)
            for j in range(k - 1, -1, -1):
                out = out * size + symbol[grams // spread[j] % 256]
            return out

        tables: list[np.ndarray] = []
        longest: list[tuple[np.ndarray, np.ndarray]] = []
        escapes: list[np.ndarray] = []
        all_contexts = np.unique(np.concatenate([reduced(counts[n][ORDER][0], ORDER + 1) // size for n in languages] or [np.zeros(0, np.int64)]))
        all_grams = np.unique(np.concatenate([reduced(counts[n][ORDER][0], ORDER + 1) for n in languages] or [np.zeros(0, np.int64)]))
        context = np.zeros(size**ORDER, np.int32)
        context[all_contexts] = np.arange(1, len(all_contexts) + 1)
        for name in languages:
            # Bits of every string of 1, 2, .. ORDER symbols: shorter contexts first.
            bits = np.full(1, 8.0)  # the empty context of no statistics: one of 256 bytes
            for k in range(1, ORDER + 1):
                grams, n = counts[name][k - 1]
                code = reduced(grams, k)
                total, kinds = np.zeros(size ** (k - 1)), np.zeros(size ** (k - 1))
                np.add.at(total, code // size, n)
                np.add.at(kinds, code // size, 1)
                leave = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)
                # The string without its first symbol is the shorter context with the same byte.
                shorter = np.full(size, 8.0) if k == 1 else bits
                tail = np.arange(size**k) % size ** (k - 1) if k > 1 else np.arange(size)
                bits = (leave[np.arange(size**k) // size] + shorter[tail]).astype(np.float32)
                bits[code] = -np.log2(n / (total + kinds)[code // size])
            tables.append(bits)
            grams, n = counts[name][ORDER]
            code = reduced(grams, ORDER + 1)
            number = context[code // size]
            total, kinds = np.zeros(len(all_contexts) + 1), np.zeros(len(all_contexts) + 1)
            np.add.at(total, number, n)
            np.add.at(kinds, number, 1)
            leave = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)
            escapes.append(leave)
            full = leave[context[all_grams // size]] + bits[all_grams % size**ORDER]
            full[np.searchsorted(all_grams, code)] = -np.log2(n / (total + kinds)[number])
            longest.append(full)
        row = np.zeros((len(all_contexts) + 1) * size, np.int32)
        row[context[all_grams // size].astype(np.int64) * size + all_grams % size] = np.arange(1, len(all_grams) + 1)
        width = len(languages)
        bits = np.zeros((len(all_grams) + 1, width), np.float32)
        if width:
            bits[1:] = np.stack(longest, axis=1)
        lower = np.stack(tables, axis=1).astype(np.float32) if width else np.zeros((size**ORDER, 0), np.float32)
        escape = np.stack(escapes, axis=1).astype(np.float32) if width else np.zeros((len(all_contexts) + 1, 0), np.float32)
        return cls(languages, symbol, context, row, bits, escape, lower)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language; `offsets` cut `data` (bytes) into texts.

        Every text is read as if newlines stood before it, so that its first bytes have a context.
        """
        n, size = len(offsets) - 1, int(self.symbol.max()) + 1
        lens = np.diff(offsets)
        new = int(self.symbol[10])
        padded = np.full(len(data) + ORDER * n, new, np.int64)
        place = np.arange(len(data)) + np.repeat(np.arange(1, n + 1) * ORDER, lens)
        padded[place] = self.symbol[data]
        code = np.zeros(len(padded) - ORDER if n else 0, np.int64)
        for j in range(ORDER):
            code = code * size + padded[j : len(padded) - ORDER + j]
        context = self.context[code][place - ORDER]
        last = padded[place]
        rows = self.row[context.astype(np.int64) * size + last]
        cost = self.bits[rows]
        missed = np.flatnonzero(rows == 0)
        if len(missed):
            short = code[place[missed] - ORDER] % size ** (ORDER - 1) * size + last[missed]
            cost[missed] = self.escape[context[missed]] + self.lower[short]
        sums = np.zeros((len(data) + 1, cost.shape[1]))
        np.cumsum(cost, axis=0, dtype=np.float64, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]


def train_language(docs: DataFrame, label: str = "lang", text: str = "text", doc_id: str = "doc_id", per_label: int = 1000) -> ContextTrees:
    """Context trees from at most `per_label` documents of each language.

    The bound keeps the model, which every task holds, the same size for any corpus.
    What comes to the driver are the distinct byte strings of the sample with counts.
    """
    chosen = stored(training_rows(docs, label, per_label, doc_id), "sample")
    sample = docs.select(doc_id, label, text).join(F.broadcast(chosen), [doc_id, label], "left_semi")
    counts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    found = gram_counts(sample, label, text).toPandas()
    for name, rows in found.groupby("label"):
        by_order = {k: r.sort_values("gram") for k, r in rows.groupby("order")}
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        counts[name] = [
            (by_order[k]["gram"].to_numpy(np.int64), by_order[k]["n"].to_numpy(np.int64)) if k in by_order else empty
            for k in range(1, ORDER + 2)
        ]
    return ContextTrees.fit(counts)


def predict_language(docs: DataFrame, model: ContextTrees, text: str = "text") -> DataFrame:
    """Add lang_pred, score and bits_per_byte to the rows of `docs`.

    The language of the shortest code wins, ties by name.  `score` is its share when
    the languages are weighed by 2 to the minus bits, tempered to the root of the
    number of bytes, since neighbouring bytes are not independent.  A NULL text or one
    without a letter is `und` with score 0, as is every text if nothing was learned.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        names = np.array(trees.languages, object)
        for batch in batches:
            texts = pc.fill_null(batch.column(place).cast(pa.string()), "")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False).astype(bool)
            first = 0
            while first < len(texts):
                floor = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, floor + SLICE_BYTES, "right")))
                part = texts.slice(first, last - first)
                offsets = np.concatenate([[floor], sizes[first:last]]) - floor
                data = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), "")[0].as_buffer(), np.uint8)
                lang = np.full(len(part), UNKNOWN, object)
                score, per_byte = np.zeros(len(part)), np.zeros(len(part))
                if len(names):
                    bits = trees.code_lengths(data, offsets)
                    best = bits.argmin(axis=1)
                    least = bits[np.arange(len(part)), best]
                    lens = np.maximum(np.diff(offsets), 1)
                    share = np.exp2(-(bits - least[:, None]) / np.sqrt(lens)[:, None]).sum(axis=1)
                    known = letters[first:last]
                    lang[known] = names[best[known]]
                    score[known] = (1 / share)[known]
                    per_byte = least / lens
                rest = [column.slice(first, last - first) for column in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(lang, pa.string()), pa.array(score), pa.array(per_byte)],
                    names=[*batch.schema.names, "lang_pred", "score", "bits_per_byte"],
                )
                first = last
            release()

    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "bits_per_byte")]
    fields = docs.select(*kept).schema.fields
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["lang_pred string, score double, bits_per_byte double"])
    place = kept.index(text)
    return docs.select(*kept).mapInArrow(predict, schema)
