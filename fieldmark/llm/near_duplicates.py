"""Near-duplicate documents by Order MinHash, verified by banded alignment.

The k-mers of a document are its runs of five words, of fewer in short texts, where one
changed word would spoil too many; the second, third, .. occurrence of a k-mer is labelled as
such.  A sketch takes the two labelled k-mers with the smallest hashes and keeps their text
order, so that equal sketches speak for a small edit distance and not just for a common bag
of words.  Documents meet where two neighbouring sketches are equal.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmark.llm.common import text_key
from fieldmark.llm.tokenizing import release
from fieldmark.session import stored

WORDS = 5
SKETCHES = 24
# Words per k-mer, and the lengths of texts it is for.  Where a text is within 0.8 of the length of
# another, both are in one of the ranges; a text in two of them has sketches of both.
KMERS = ((1, 4, 25), (2, 20, 125), (WORDS, 100, 2**31))
SIMILARITY = 0.8
SLICE_BYTES = 1_000_000
PAIRS_AT_ONCE = 250
TEXTS_AT_ONCE = 1000
FEW_EDITS = 24
# So few rows are grouped where they are, without an exchange; every round over links would pay for its partitions.
FEW_LINKS = 100_000
TURN_BASE = 64
NEVER = 1_000_000
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-case words (letters, digits, marks) and the words per text."""
    import xxhash

    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL\pN\pM]+", " ")
    split = pc.split_pattern(pc.utf8_trim(plain, " "), " ")
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    empty = np.array([w == "" for w in words], bool)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = ~empty[code] if len(code) else np.zeros(0, bool)
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    return table[code[real]], np.bincount(text[real], minlength=len(texts))


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def labelled_kmers(words: np.ndarray, counts: np.ndarray, longest: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-labelled k-mers of `longest` words and their number per text.

    A text of fewer words has one k-mer, all its words; one without words has none.
    """
    ends = np.cumsum(counts)
    n = np.where(counts >= longest, counts - longest + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n)
    place = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends - counts, n)
    size = np.minimum(counts, longest)[text]
    kmer = np.zeros(len(text), np.uint64)
    padded = np.concatenate([words, np.zeros(longest, np.uint64)])
    for j in range(longest):
        step = mixed(kmer ^ padded[place + j], j + 1)
        kmer = np.where(j < size, step, kmer)
    order = np.lexsort((kmer, text))
    same = np.zeros(len(text), bool)
    if len(text) > 1:
        same[1:] = (kmer[order][1:] == kmer[order][:-1]) & (text[order][1:] == text[order][:-1])
    at = np.arange(len(text))
    first = np.maximum.accumulate(np.where(same, 0, at)) if len(text) else at
    label = np.zeros(len(text), np.uint64)
    label[order] = (at - first).astype(np.uint64)
    return mixed(kmer + label * np.uint64(0x632BE59BD9B4E019), 99), n


def order_sketches(kmers: np.ndarray, n: np.ndarray, sketches: int = SKETCHES) -> np.ndarray:
    """Sketches of texts (rows): hash of the two smallest k-mers in text order."""
    out = np.zeros((len(n), sketches), np.uint64)
    some = n > 0
    lens = n[some]
    if not len(lens):
        return out.view(np.int64)
    starts = np.cumsum(lens) - lens
    two = lens > 1
    for s in range(sketches):
        h = mixed(kmers, 1000 + s)
        least = np.minimum.reduceat(h, starts)
        at = np.flatnonzero(h == np.repeat(least, lens))
        where = at[np.searchsorted(at, starts)]  # the first, should hashes be equal
        h[where] = FULL
        second = np.minimum.reduceat(h, starts)
        at2 = np.flatnonzero(h == np.repeat(second, lens))
        where2 = at2[np.searchsorted(at2, starts)]
        early, late = np.minimum(where, where2), np.maximum(where, where2)
        pair = mixed(mixed(kmers[early], 1) + kmers[late], 2 + s)
        out[some, s] = np.where(two, pair, mixed(kmers[where], 2 + s))
    return out.view(np.int64)


def text_sketches(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sketches of texts one after another, SKETCHES for each range of KMERS a text is in, and their number per text."""
    numbers, rows = [], []
    for k, least, most in KMERS:
        chosen = np.flatnonzero((counts >= least) & (counts <= most))
        inside = np.zeros(len(counts), bool)
        inside[chosen] = True
        kmers, n = labelled_kmers(words[np.repeat(inside, counts)], counts[chosen], k)
        numbers.append(chosen)
        rows.append(mixed(order_sketches(kmers, n).view(np.uint64), 77 + k).view(np.int64))
    owner = np.concatenate(numbers)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(rows)[order].ravel(), np.bincount(owner, minlength=len(counts)) * SKETCHES


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    texts = pc.fill_null(texts, "")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        floor = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, floor + SLICE_BYTES, "right")))
        yield first, texts.slice(first, last - first)
        first = last
    release()


def sketched(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """__id, __key, node (digest of the words, or of the text if it has none), sketch, size (words)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("__text")):
                words, counts = word_hashes(texts)
                flat, many = text_sketches(words, counts)
                edges = np.concatenate([[0], np.cumsum(counts)])
                raw = words.tobytes()
                nodes = [
                    hashlib.md5(raw[8 * a : 8 * b] if b > a else b"text:" + t.as_py().encode(), usedforsecurity=False).digest()
                    for a, b, t in zip(edges[:-1], edges[1:], texts)
                ]
                # The shortest texts have no sketches: one edit makes them too different, so they are compared as wholes.
                offsets = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("__id").slice(first, len(texts)),
                        batch.column("__key").slice(first, len(texts)),
                        pa.array(nodes, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                        pa.array(counts.astype(np.int32)),
                    ],
                    names=["__id", "__key", "node", "sketch", "size"],
                )

    return keyed_texts(docs, text, doc_id).mapInArrow(sketch, "__id long, __key long, node binary, sketch array<long>, size int")


def keyed_texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """__id, __key (hash of the text, as several texts may stand under one id) and __text of the rows with an id."""
    return docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("__id"), text_key(text).alias("__key"), F.col(text).cast("string").alias("__text")
    )


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edits between two word sequences, or `most` + 1 if there are more.

    Only diagonals within `most` of the start are looked at.  For each number of edits
    the furthest place on each diagonal is kept, and runs of equal words are skipped at
    once, so near copies take little more than reading them.  Pairs of more than FEW_EDITS
    edits go on with `edits_by_column`.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    short = min(len(a), len(b))
    unequal = np.flatnonzero(a[:short] != b[:short])
    head = int(unequal[0]) if len(unequal) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    if short:
        unequal = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
        tail = int(unequal[0]) if len(unequal) else short
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if not n or not m:
        return min(n + m, most + 1)
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    if max(n, m) - int(np.minimum(ca[ia], cb[ib]).sum()) > most:
        return most + 1
    stops: dict[int, list[int]] = {}

    def slide(i: int, d: int) -> int:
        if d not in stops:
            low, high = max(0, -d), min(n, m - d)
            found = np.flatnonzero(a[low:high] != b[low + d : high + d]) + low
            stops[d] = [*found.tolist(), high]
        ends = stops[d]
        return ends[min(bisect_left(ends, i), len(ends) - 1)]

    goal = m - n
    few = min(most, FEW_EDITS)
    reach = {0: slide(0, 0)}
    if goal == 0 and reach[0] >= n:
        return 0
    for edits in range(1, few + 1):
        left = few - edits
        now: dict[int, int] = {}
        for d in range(max(-edits, goal - left, -n), min(edits, goal + left, m) + 1):
            i = max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -1))
            if i < 0 or i + d < 0:
                continue
            i = min(i, n, m - d)
            i = max(i, slide(i, d))
            now[d] = i
            if d == goal and i >= n:
                return edits
        reach = now
    return most + 1 if most == few else edits_by_column(a, b, most)


def edits_by_column(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """As `edit_distance`, by whole columns of the table: differences of neighbouring cells as bits of two numbers."""
    at: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        at[word] = at.get(word, 0) | 1 << i
    every, end = (1 << len(a)) - 1, len(a) - 1
    up, down, edits, left = every, 0, len(a), len(b)
    for word in b.tolist():
        equal = at.get(word, 0)
        level = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = down | (every & ~(across | up)), up & across
        edits += (more >> end & 1) - (less >> end & 1)
        left -= 1
        if edits - left > most:
            return most + 1
        more, less = more << 1 | 1, less << 1
        up, down = (less | ~(level | more)) & every, more & level & every
    return min(edits, most + 1)


def verified(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose words differ in a share of edits of 1 - similarity at most.

    Computed at once, in batches small enough for pairs of very long texts.
    """
    both = pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a").join(
        words.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b"
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wa, wb = batch.column("wa"), batch.column("wb")
            keep = []
            oa, ob = wa.offsets.to_numpy(), wb.offsets.to_numpy()
            va, vb = wa.values.to_numpy(), wb.values.to_numpy()
            for i in range(batch.num_rows):
                x, y = va[oa[i] : oa[i + 1]], vb[ob[i] : ob[i + 1]]
                most = int((1 - similarity) * max(len(x), len(y)) + 1e-9)
                keep.append(edit_distance(x, y, most) <= most)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    aligned = both.select("a", "b", "wa", "wb").mapInArrow(align, "a binary, b binary")
    with batches_of(pairs.sparkSession, PAIRS_AT_ONCE):
        return stored(aligned, "links")


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what is run inside; the setting is put back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """In one partition if they are few, otherwise as they are."""
    return df.coalesce(1) if rows <= FEW_LINKS else df


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node each node is linked to, over any number of links.

    In each round a node takes the smallest label among its neighbours, and then the
    label of its label.  Each round is written to the shared folder; the driver sees
    only whether a label has changed.
    """
    count = 2 * links.count()
    sides = gathered(stored(gathered(links.select("a", "b").union(links.select("b", "a")), count).distinct(), "links"), count)
    labels = stored(sides.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        labels = gathered(labels, count)
        around = sides.join(labels, sides["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(around, labels["node"] == around["a"], "left").select("node", "label", F.least("label", "m").alias("low"))
        jump = labels.select(F.col("node").alias("__n"), F.col("label").alias("__l"))
        new = lower.join(jump, lower["low"] == jump["__n"], "left").select("node", "label", F.least("low", "__l").alias("new"))
        new = stored(new, "labels")
        changed = not new.filter(F.col("new") != F.col("label")).isEmpty()
        labels = new.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def buckets_of(nodes: DataFrame) -> DataFrame:
    """A row for each bucket of a node, two neighbouring sketches at once; other columns stay."""
    after = lambda i: (i - i % SKETCHES) + (i + 1) % SKETCHES
    pairs = F.transform("sketch", lambda s, i: F.xxhash64(s, F.get("sketch", after(i)), i % SKETCHES))
    return nodes.withColumn("bucket", F.explode(pairs)).drop("sketch")


def with_label(df: DataFrame, labels: DataFrame) -> DataFrame:
    return df.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def bags(words: DataFrame) -> DataFrame:
    """node and bag: its words in no order, the second, third, .. occurrence of a word labelled as such, each element once."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            counts = np.diff(lists.offsets.to_numpy())
            text = np.repeat(np.arange(len(counts)), counts)
            word = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((word, text))
            text, word = text[order], word[order]
            new = np.ones(len(word), bool)
            new[1:] = (word[1:] != word[:-1]) | (text[1:] != text[:-1])
            at = np.arange(len(word))
            label = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64) if len(word) else at.astype(np.uint64)
            element = (mixed(word.astype(np.uint64) + label * np.uint64(0x632BE59BD9B4E019), 7) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            kept = np.unique(text << 32 | element.view(np.uint32).astype(np.int64))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(kept >> 32, minlength=len(counts)))]).astype(np.int32)
            values = (kept & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["node", "bag"])

    return words.select("node", "words").mapInArrow(bag, "node binary, bag array<int>")


def within_reach(a: str, b: str, similarity: float) -> Column:
    """False only where lengths or words in common alone take more edits than `similarity` allows."""
    longer = F.greatest(f"{a}.size", f"{b}.size")
    most = F.floor(F.lit(1 - similarity) * longer + 1e-9)
    # Elements that fell together are counted as found.
    common = F.size(F.array_intersect(f"{a}.bag", f"{b}.bag")) + F.col(f"{a}.size") - F.size(f"{a}.bag")
    return (longer - F.least(f"{a}.size", f"{b}.size") <= most) & (longer - common <= most)


def joined_classes(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after more links, which are taken as links between classes."""
    count = links.count()
    links, labels = gathered(links, 2 * count), gathered(labels, labels.count())
    ends = gathered(links.select(F.col("a").alias("node")).union(links.select("b")), 2 * count).distinct()
    every = stored(with_label(ends.join(labels, "node", "left_anti"), labels).unionByName(labels), "labels")
    of = lambda side: every.select(F.col("node").alias(side), F.col("label").alias(f"l{side}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    new = components(stored(gathered(between, count).distinct(), "links")).select(F.col("node").alias("label"), F.col("label").alias("new"))
    return stored(every.join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "labels")


def further_links(nodes: DataFrame, pairs: DataFrame, labels: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Labels, after all pairs of different classes in a bucket have been aligned.

    Each member of a bucket with several classes has a turn at which it meets all members
    of its own and later turns.  First comes the member that shares most buckets, such as
    the original of a family of copies; the others follow by hash, about TURN_BASE times
    as many each turn, so that a few members join what they can before many meet.  The
    members of a bucket's largest class only wait: they are met by all others, but have
    nothing to find among themselves.  Pairs meet only where their lengths, by cells, allow
    it and where they have words enough in common, whatever their order; pairs of one class are
    left out.
    """
    labelled = with_label(nodes, labels)
    each = buckets_of(labelled.select("label", "sketch")).groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed_ones = each.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("largest"), F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n"))
    mixed_ones = stored(mixed_ones.filter("classes > 1").select("bucket", "n", F.when(F.col("largest.n") > 1, F.col("largest.label")).alias("largest")), "mixed")
    if mixed_ones.isEmpty():
        return labels
    members = stored(buckets_of(labelled.select("node", "label", "sketch")).join(mixed_ones, "bucket"), "members")
    shared = stored(members.groupBy("node").agg(F.sum("n").alias("shared"), F.collect_set("bucket").alias("buckets")), "shared")
    first = members.join(shared.select("node", "shared"), "node").groupBy("bucket").agg(F.max(F.struct("shared", "node"))["node"].alias("first"))
    chance = F.shiftrightunsigned(F.xxhash64("node"), 11) / F.lit(float(2**53))
    drawn = F.greatest(F.floor(F.log(float(TURN_BASE), F.greatest(chance * F.col("n"), F.lit(1.0)))) + 1, F.lit(1))
    turn_of = F.when(F.col("node") == F.col("first"), 0).when(F.col("label") == F.col("largest"), NEVER).otherwise(drawn)
    turns = members.join(first, "bucket").select("node", "bucket", turn_of.cast("int").alias("turn"))
    turns = stored(turns.join(nodes.select("node", "size"), "node"), "turns")
    held = stored(bags(words.join(shared, "node", "left_semi")).join(shared.select("node", "buckets"), "node"), "bags")
    last = turns.filter(F.col("turn") < NEVER).agg(F.max("turn")).first()[0]
    for turn in range(last + 1):
        now = with_label(turns.filter(F.col("turn") >= turn), labels).join(held, "node")
        # Lengths within `similarity` of each other are in one cell or in neighbouring ones.
        cell = F.floor(F.log("size") / F.lit(max(-math.log(similarity), 1e-3)))
        hub = now.filter(F.col("turn") == turn).withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1))).alias("x")
        other = now.withColumn("cell", cell).alias("y")
        later = (F.col("y.turn") > turn) | (F.col("x.node") < F.col("y.node"))
        # A pair meets in one of its buckets only.
        once = F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("x.bucket")
        met = hub.join(other, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.cell") == F.col("y.cell")) & (F.col("x.label") != F.col("y.label")) & later & once & within_reach("x", "y", similarity))
        new = met.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
        new = stored(new.join(pairs, ["a", "b"], "left_anti"), "pairs")
        if new.isEmpty():
            continue
        more = verified(new, words, similarity)
        if not more.isEmpty():
            labels = joined_classes(labels, more)
    return labels


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id), one row per row with an id: the smallest id of its class.

    Documents with equal words are one node from the start.  Nodes that share two
    neighbouring sketches are candidates, which leaves out documents that have no more in
    common than a passage.  Each node is first compared with the smallest of the group with
    which it shares most of these.  Groups that still hold several classes go
    on in rounds, until no pair of different classes is left unaligned that lengths or
    the words in common do not rule out.  Classes are the connected components of the pairs whose
    edit similarity, 1 - edits / words of the longer, is `similarity` or more.  Nothing is
    capped.

    A NULL text is an empty one; texts without words are equal only as texts.  Of fewer
    than four words only equal ones are duplicates.  Rows without an id are left out; several
    texts of one id are a node each, and the id has a row, with a class, for each of them.
    """
    with batches_of(docs.sparkSession, TEXTS_AT_ONCE):
        rows = stored(sketched(docs, text, doc_id), "sketches")
    nodes = rows.filter(F.size("sketch") > 0).groupBy("node").agg(F.min("sketch").alias("sketch"), F.min("size").alias("size"))
    buckets = buckets_of(nodes.select("node", "sketch"))
    hubs = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top").drop("top")
    met = buckets.join(hubs, "bucket").filter("hub < node").groupBy(F.col("node").alias("a"), F.col("hub").alias("b"))
    pairs = stored(met.agg(F.count(F.lit(1)).alias("n")), "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    first = rows.groupBy("node").agg(F.min(F.struct("__id", "__key")).alias("f")).select("node", "f.*").join(wanted, "node", "left_semi")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in slices(batch.column("__text")):
                words, counts = word_hashes(texts)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                nodes_of = batch.column("node").slice(begin, len(texts))
                values = pa.array((words >> np.uint64(32)).astype(np.uint32).view(np.int32))
                yield pa.RecordBatch.from_arrays([nodes_of, pa.ListArray.from_arrays(pa.array(offsets), values)], names=["node", "words"])

    found = keyed_texts(docs, text, doc_id).join(first, ["__id", "__key"]).select("node", "__text").mapInArrow(hashes, "node binary, words array<int>")
    with batches_of(docs.sparkSession, TEXTS_AT_ONCE):
        words = stored(found.dropDuplicates(["node"]), "words")
    # Most classes are found with the pair of each node that shares most sketches.
    likely = stored(pairs.groupBy("a").agg(F.max(F.struct("n", "b")).alias("x")).select("a", "x.b"), "likely")
    links = verified(likely, words, similarity)
    # What is left are the pairs that would join two classes.
    labels = further_links(nodes, likely, components(links), words, similarity)
    labelled = with_label(rows.select("__id", "node"), labels)
    smallest = labelled.groupBy("label").agg(F.min("__id").alias("class_id"))
    return labelled.join(smallest, "label").select(F.col("__id").alias(doc_id), "class_id")
