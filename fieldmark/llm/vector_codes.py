"""Product codes of vectors: Lloyd's rounds on cover trees that are built once.

Vectors of whole numbers are cut into parts, and each part position has a codebook.  Every
block of rows holds a cover tree per part, with the count and the sum of what lies below
each node.  By the triangle inequality a subtree goes to an entry as a whole where no other
entry can be nearest to any of its points; only ambiguous nodes descend, and points of
ambiguous leaves are compared exactly.  All distances are integers, so results do not depend
on how rows lie in partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.tokenizing import release
from fieldmark.session import measured, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK_ROWS = 4096
LEAF_POINTS = 48
# Components are held within this, so that squared distances fit into 64 bits.
LARGEST = 2**27

TREE = "rows members points weights node_start child children first last radius2 count total".split()
TREE_SCHEMA = ", ".join(f"{n} array<{'long' if n in ('radius2', 'count', 'total') else 'int'}>" for n in TREE)


@dataclass
class Tree:
    """A cover tree; nodes are in breadth-first order, points in the order of the leaves."""

    points: np.ndarray
    weights: np.ndarray
    child: np.ndarray
    children: np.ndarray
    first: np.ndarray
    last: np.ndarray
    radius2: np.ndarray
    count: np.ndarray
    total: np.ndarray

    @property
    def centers(self) -> np.ndarray:
        """The first point of a node is its centre."""
        return self.points[self.first]


def cover_tree(points: np.ndarray, weights: np.ndarray, leaf: int = LEAF_POINTS) -> tuple[Tree, np.ndarray]:
    """The tree of distinct points, and the order in which it holds them.

    The children of a node are balls of at most half its radius around points further apart
    than that; the first keeps its parent's centre.  Nodes of up to `leaf` points are not cut.
    """
    order = np.arange(len(points))
    first, last, child, children, radius2 = [0], [len(points)], [], [], []
    at = 0
    while at < len(first):
        low, high = first[at], last[at]
        here = order[low:high]
        far = ((points[here] - points[here[0]]) ** 2).sum(axis=1)
        widest = int(far.max()) if len(far) else 0
        radius2.append(widest)
        child.append(len(first))
        if high - low > leaf and widest:
            begin, rest, balls = low, here, []
            while len(rest):
                near = far * 4 <= widest
                balls.append(rest[near])
                first.append(begin)
                begin += len(balls[-1])
                last.append(begin)
                rest = rest[~near]
                if len(rest):
                    far = ((points[rest] - points[rest[0]]) ** 2).sum(axis=1)
            order[low:high] = np.concatenate(balls)
        children.append(len(first) - child[-1])
        at += 1
    lows, highs = np.array(first), np.array(last)
    points, weights = points[order], weights[order]
    counts = np.concatenate([[0], np.cumsum(weights)])
    totals = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points * weights[:, None], axis=0)])
    tree = Tree(
        points, weights, np.array(child), np.array(children), lows, highs, np.array(radius2, np.int64),
        counts[highs] - counts[lows], totals[highs] - totals[lows],
    )
    return tree, order


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=1)


def nearest(tree: Tree, codebook: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(numbers, entries, whole): the entry of whole nodes, then of single points, level by level.

    Each point is in exactly one of them.  Ties go to the lower index: an entry is left out
    of a subtree only if another one is strictly nearer to all its points.
    """
    if not len(tree.points):
        return
    live, open_entries = np.zeros(1, np.int64), np.ones((1, len(codebook)), bool)
    while len(live):
        node, entry = np.nonzero(open_entries)
        distance = squared(tree.centers[live[node]], codebook[entry])
        starts = np.searchsorted(node, np.arange(len(live)))
        reach = np.sqrt(np.minimum.reduceat(distance, starts)) + 2 * np.sqrt(tree.radius2[live])
        # Rounding can only keep an entry too many.
        stays = np.sqrt(distance) <= reach[node] * (1 + 1e-9) + 1e-6
        left = np.add.reduceat(stays.astype(np.int64), starts)
        yield live[left == 1], entry[stays & (left == 1)[node]], True
        open_entries[node[~stays], entry[~stays]] = False
        inner = (left > 1) & (tree.children[live] > 0)
        leaves = (left > 1) & (tree.children[live] == 0)
        if leaves.any():
            ends = live[leaves]
            size = tree.last[ends] - tree.first[ends]
            owner = np.repeat(np.arange(len(ends)), size)
            point = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + tree.first[ends][owner]
            pair, entry = np.nonzero(open_entries[leaves][owner])
            distance = squared(tree.points[point[pair]], codebook[entry])
            best = np.minimum.reduceat(distance, np.searchsorted(pair, np.arange(len(point))))
            least = np.flatnonzero(distance == best[pair])
            yield point, entry[least[np.searchsorted(pair[least], np.arange(len(point)))]], False
        below = live[inner]
        size = tree.children[below]
        owner = np.repeat(np.arange(len(below)), size)
        live = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + tree.child[below][owner]
        open_entries = open_entries[inner][owner]


def entry_sums(tree: Tree, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points and their sum per entry; whole subtrees add what their node knows."""
    count, total = np.zeros(len(codebook), np.int64), np.zeros(codebook.shape, np.int64)
    for numbers, entries, whole in nearest(tree, codebook):
        n = tree.count[numbers] if whole else tree.weights[numbers]
        x = tree.total[numbers] if whole else tree.points[numbers] * n[:, None]
        np.add.at(count, entries, n)
        np.add.at(total, entries, x)
    return count, total


def entry_of_points(tree: Tree, codebook: np.ndarray) -> np.ndarray:
    out = np.zeros(len(tree.points), np.int64)
    for numbers, entries, whole in nearest(tree, codebook):
        if whole:
            for a, b, e in zip(tree.first[numbers], tree.last[numbers], entries):
                out[a:b] = e
        else:
            out[numbers] = entries
    return out


def whole_numbers(vector: str, scale: int = SCALE) -> Column:
    """The components as floor(scale * x); NULL if one is NULL or not finite."""
    number = F.transform(vector, lambda x: x.cast("double") * scale)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    held = F.transform(number, lambda x: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x))).cast("int"))
    return F.when(finite, held)


def tree_blocks(rows: DataFrame, parts: int, wide: int, block: int = BLOCK_ROWS) -> DataFrame:
    """A row per block of at most `block` rows: their ids, labels, and a tree per part.

    `rows` has __id, __label and __x; blocks are rows of one partition, so nothing moves.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, block):
                piece = batch.slice(begin, block)
                x = piece.column(2).flatten().to_numpy().astype(np.int64).reshape(-1, parts, wide)
                found: dict[str, list[np.ndarray]] = {n: [] for n in TREE}
                for p in range(parts):
                    points, member, weights = np.unique(x[:, p], axis=0, return_inverse=True, return_counts=True)
                    tree, order = cover_tree(points, weights)
                    place = np.empty(len(order), np.int64)
                    place[order] = np.arange(len(order))
                    found["rows"].append(np.array([len(points)]))
                    found["members"].append(place[member.ravel()])
                    found["node_start"].append(np.array([len(tree.first)]))
                    for n in ("points", "weights", "child", "children", "first", "last", "radius2", "count", "total"):
                        found[n].append(getattr(tree, n).ravel())
                columns = []
                for n in TREE:
                    flat = np.concatenate(found[n]).astype(np.int64 if n in ("radius2", "count", "total") else np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat)))
                ends = pa.array([0, piece.num_rows], pa.int32())
                listed = [pa.ListArray.from_arrays(ends, piece.column(i)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*listed, *columns], names=["ids", "labels", *TREE])
            release()

    kind = rows.schema["__label"].dataType.simpleString()
    return rows.select("__id", "__label", "__x").mapInArrow(build, f"ids array<long>, labels array<{kind}>, {TREE_SCHEMA}")


def trees_of(batch: pa.RecordBatch, row: int, parts: int, wide: int) -> Iterator[tuple[Tree, np.ndarray]]:
    """The trees of a block, each with the point of every row."""
    flat = {n: batch.column(n)[row].values.to_numpy().astype(np.int64) for n in TREE}
    n_rows = len(batch.column("ids")[row])
    point, node = 0, 0
    for p in range(parts):
        n, m = int(flat["rows"][p]), int(flat["node_start"][p])
        own = {k: flat[k][node : node + m] for k in ("child", "children", "first", "last", "radius2", "count")}
        points = flat["points"][point * wide : (point + n) * wide].reshape(n, wide)
        total = flat["total"][node * wide : (node + m) * wide].reshape(m, wide)
        yield Tree(points, flat["weights"][point : point + n], total=total, **own), flat["members"][p * n_rows : (p + 1) * n_rows]
        point, node = point + n, node + m


def lloyd_round(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floor of the mean of what is nearest; unused ones stay.

    A task sends one row per component of an entry, however many rows it has; these are
    summed before they come to the driver, which holds no more than the codebooks.
    """
    parts, entries, wide = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros(codebooks.shape, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, (tree, _) in enumerate(trees_of(batch, row, parts, wide)):
                    n, x = entry_sums(tree, codebooks[p])
                    count[p] += n
                    total[p] += x
            release()
        place = np.flatnonzero(np.repeat(count.ravel() > 0, wide))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.repeat(count.ravel(), wide)[place]), pa.array(total.ravel()[place])], names=["place", "n", "total"])

    found = blocks.mapInArrow(sums, "place long, n long, total long")
    # Sums over all rows may pass 64 bits.
    summed = found.groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    new = codebooks.copy().reshape(-1)
    for place, n, total in summed.collect():
        new[place] = int(total) // int(n)
    return new.reshape(codebooks.shape)


def coded(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(__id, __label, code, error) of every row."""
    parts, entries, wide = codebooks.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{i:02x}" for i in range(entries)], "U2")
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values
                chosen, error = np.zeros((len(ids), parts), np.int64), np.zeros(len(ids), np.int64)
                for p, (tree, member) in enumerate(trees_of(batch, row, parts, wide)):
                    entry = entry_of_points(tree, codebooks[p])
                    chosen[:, p] = entry[member]
                    error += squared(tree.points, codebooks[p][entry])[member]
                text = ["".join(d) for d in digits[chosen]]
                yield pa.RecordBatch.from_arrays([ids, batch.column("labels")[row].values, pa.array(text, pa.string()), pa.array(error)], names=["__id", "__label", "code", "error"])
            release()

    kind = blocks.schema["labels"].dataType.elementType.simpleString()
    return blocks.mapInArrow(code, f"__id long, __label {kind}, code string, error long")


def digest(codebooks: np.ndarray) -> str:
    """sha256 of all components by part, entry and position, as decimal numbers."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, label, code, error, label_error), and the codebooks they refer to.

    `code` has two hex digits per part; `error` is the sum of squared distances between a
    vector and its entries, `label_error` that sum over the rows of a label, NULL labels
    together.  The codebooks start from the `entries` smallest rows by id.

    Rows are left out whose vector is NULL, has a NULL or non-finite component, or has not
    the length of the first row by id whose length is a multiple of `parts` above 0.
    Scaled components beyond 2^27 count as 2^27.  A row without an id comes after all
    others, equal rows are coded alike, each by itself.  Without a row left the result is
    empty, as are the codebooks.  Other columns of `vectors` are not in the result.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry is two hex digits: 1 to 256 entries")
    rows = vectors.select(F.col(vec_id).cast("long").alias("__id"), F.col(label).alias("__label"), whole_numbers(vector, scale).alias("__x"))
    rows = rows.filter((F.size("__x") > 0) & (F.size("__x") % parts == 0))
    order = [F.col("__id").asc_nulls_last(), F.col("__x")]
    seeds = rows.orderBy(*order).select("__x").limit(entries).collect()
    size = len(seeds[0]["__x"]) if seeds else parts
    rows = rows.filter(F.size("__x") == size)
    if any(len(s["__x"]) != size for s in seeds):
        seeds = rows.orderBy(*order).select("__x").limit(entries).collect()
    wide = size // parts
    codebooks = np.array([s["__x"] for s in seeds], np.int64).reshape(-1, parts, wide).transpose(1, 0, 2).copy()
    blocks = stored(tree_blocks(rows, parts, wide), "trees")
    if seeds:
        for _ in range(rounds):
            codebooks = lloyd_round(blocks, codebooks)
    codes = stored(coded(blocks, codebooks), "codes")
    by_label = measured(codes.groupBy("__label").agg(F.sum("error").alias("label_error")))
    by_label = by_label.select(F.col("__label").alias("__of"), "label_error")
    joined = codes.join(by_label, codes["__label"].eqNullSafe(by_label["__of"]))
    out = joined.select(F.col("__id").alias(vec_id), F.col("__label").alias(label), "code", "error", "label_error")
    return out, codebooks
