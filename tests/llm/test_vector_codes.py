"""Vector codes by cover trees against comparing everything with everything."""

import hashlib
import math

import numpy as np
import pytest

from fieldmark.llm.common import ship_package
from fieldmark.llm.vector_codes import LARGEST, cover_tree, digest, entry_of_points, entry_sums, vector_codes


def plain(rows, parts=16, entries=64, rounds=2):
    """Rows (id, vector, label) to sorted (id, label, code, error, label_error) and the codebooks."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and len(v) and len(v) % parts == 0]
    whole = lambda x: min(max(math.floor(256 * x), -LARGEST), LARGEST)
    kept = [(i, [whole(float(np.float32(x))) for x in v], g) for i, v, g in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    wide = len(kept[0][1]) // parts
    cut = lambda v: [v[p * wide : (p + 1) * wide] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def best(p, v):
        return min(range(len(books[p])), key=lambda e: (far(v, books[p][e]), e))

    for _ in range(rounds):
        chosen = [[best(p, part) for p, part in enumerate(cut(v))] for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), c in zip(kept, chosen) if c[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    out = []
    for i, v, g in kept:
        code = [best(p, part) for p, part in enumerate(cut(v))]
        out.append([i, g, "".join(f"{c:02x}" for c in code), sum(far(part, books[p][code[p]]) for p, part in enumerate(cut(v)))])
    sums = {}
    for _, g, _, e in out:
        sums[g] = sums.get(g, 0) + e
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted([(*r, sums[r[1]]) for r in out], key=str), hashlib.sha256(flat.encode()).hexdigest()


def found(df, **options):
    codes, books = vector_codes(df, **options)
    assert codes.columns == ["vec_id", "label", "code", "error", "label_error"]
    return sorted((tuple(r) for r in codes.collect()), key=str), digest(books)


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_against_plain(spark, frame):
    ship_package(spark)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=32)], int(i) % 5) for i in range(300)]
    rows += [(1000 + i, [0.5] * 32, None) for i in range(200)]  # one vector that many rows have
    rows += [(2000 + i, [float(x) for x in rng.integers(-1, 2, 32)], 7) for i in range(200)]  # many ties
    rows += [rows[5], (5, rows[9][1], 1), (None, rows[3][1], 2), (-9, [1e30] * 31 + [-1e30], 3)]
    rows += [(-1, None, 1), (-2, [None] + [0.0] * 31, 1), (-3, [float("nan")] * 32, 1), (-4, [float("inf")] * 32, 1), (-5, [], 1), (-6, [1.0] * 7, 1), (77, [1.0] * 16, 1)]
    df = frame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS error", "3 AS __x", "4 AS ids").repartition(5)
    assert found(df) == plain(rows)
    assert found(df, parts=8, entries=7, rounds=3) == plain(rows, 8, 7, 3)


def test_few_and_no_rows(spark, frame):
    ship_package(spark)
    rows = [(2, [1.0] * 16, 1), (1, [2.0] * 16, None)]
    assert found(frame(rows, SCHEMA)) == plain(rows)
    for rows in ([], [(1, None, 1)]):
        assert found(frame(rows, SCHEMA)) == ([], hashlib.sha256(b"").hexdigest())
    with pytest.raises(ValueError):
        vector_codes(frame([], SCHEMA), entries=300)


def test_trees_assign_as_brute_force():
    rng = np.random.default_rng(8)
    for scale in (3, 60, 5000, LARGEST):
        points, weights = np.unique(rng.integers(-scale, scale + 1, (1500, 4)), axis=0, return_counts=True)
        book = points[rng.integers(0, len(points), 20)] + rng.integers(-1, 2, (20, 4))
        tree, order = cover_tree(points, weights, leaf=8)
        assert sorted(order) == list(range(len(points))) and (tree.points == points[order]).all()
        distance = ((tree.points[:, None] - book[None]) ** 2).sum(axis=2)
        assert (entry_of_points(tree, book) == distance.argmin(axis=1)).all()
        count, total = entry_sums(tree, book)
        for e in range(20):
            own = distance.argmin(axis=1) == e
            assert count[e] == tree.weights[own].sum() and (total[e] == (tree.points[own] * tree.weights[own][:, None]).sum(axis=0)).all()


def test_tree_keeps_the_covering_rule():
    rng = np.random.default_rng(9)
    points = np.unique(rng.integers(0, 300, (3000, 3)), axis=0)
    tree, _ = cover_tree(points, np.ones(len(points), np.int64))
    for k in range(len(tree.first)):
        inside = tree.points[tree.first[k] : tree.last[k]]
        assert ((inside - tree.centers[k]) ** 2).sum(axis=1).max() == tree.radius2[k]
        below = range(tree.child[k], tree.child[k] + tree.children[k])
        assert sum(tree.count[c] for c in below) == (tree.count[k] if len(below) else 0)
        assert all(4 * tree.radius2[c] <= tree.radius2[k] for c in below)
        if len(below):
            assert tree.first[below[0]] == tree.first[k]


def test_most_of_a_clustered_set_is_assigned_by_subtrees():
    from fieldmark.llm.vector_codes import nearest

    rng = np.random.default_rng(3)
    middles = rng.integers(-20_000, 20_000, (30, 4))
    points = np.unique((middles[rng.integers(0, 30, 4000)] + rng.integers(-40, 41, (4000, 4))), axis=0)
    tree, _ = cover_tree(points, np.ones(len(points), np.int64))
    compared = sum(len(numbers) for numbers, _, whole in nearest(tree, middles) if not whole)
    assert compared < len(points) / 20
