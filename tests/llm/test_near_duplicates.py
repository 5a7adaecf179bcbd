"""Order sketches, alignment and classes."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

import fieldmark.llm.near_duplicates as near
from fieldmark.llm.near_duplicates import edit_distance, labelled_kmers, near_duplicates, order_sketches, word_hashes


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_alignment_is_exact():
    rng = random.Random(4)
    for _ in range(400):
        a = [rng.randint(0, 6) for _ in range(rng.randint(0, 25))]
        b = list(a) if rng.random() < 0.6 else [rng.randint(0, 6) for _ in range(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 4)):
            if b:
                b[rng.randrange(len(b))] = rng.randint(0, 6)
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            if rng.random() < 0.5:
                b.insert(rng.randint(0, len(b)), rng.randint(0, 6))
        want = plain_distance(a, b)
        for most in (0, 2, 5, 30):
            got = edit_distance(np.array(a, np.int32), np.array(b, np.int32), most)
            assert got == min(want, most + 1), (a, b, most)


def test_order_counts():
    words = [f"w{i}" for i in range(60)]
    turned = words[30:] + words[:30]
    hashes, counts = word_hashes(pa.array([" ".join(words), " ".join(turned), " ".join(words).upper() + "!"]))
    kmers, n = labelled_kmers(hashes, counts)
    rows = order_sketches(kmers, n)
    assert (rows[0] == rows[2]).all()
    assert 0 < (rows[0] == rows[1]).sum() < rows.shape[1]  # same bag of k-mers mostly, another order


def test_repeated_kmers_are_labelled():
    hashes, counts = word_hashes(pa.array(["a b c d e " * 4]))
    kmers, _ = labelled_kmers(hashes, counts)
    assert len(set(kmers.tolist())) == len(kmers)


def documents():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    rows, kind = [], {}
    for c in range(25):
        base = [word() for _ in range(rng.randint(80, 300))]
        for k in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 60) if k else 0):
                copy[rng.randrange(len(copy))] = word()
            i = len(rows)
            rows.append((i, " ".join(copy)))
            kind[i] = c
    for _ in range(20):  # one passage in different documents
        i = len(rows)
        rows.append((i, passage + " " + " ".join(word() for _ in range(150))))
        kind[i] = f"alone{i}"
    return rows, kind


def test_classes(frame):
    rows, kind = documents()
    rng = random.Random(1)
    order = list(range(len(rows)))
    rng.shuffle(order)
    renamed = [(order[i] * 7, text) for i, text in rows]
    want = {}
    for i, c in kind.items():
        want.setdefault(c, []).append(order[i] * 7)
    df = frame(renamed, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS label", "3 AS a")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(df).collect()}
    for members in want.values():
        assert {got[m] for m in members} == {min(members)}


def test_odd_rows(frame):
    rows = [(1, None), (2, ""), (3, "***"), (4, "***"), (5, "one two"), (6, "One, two!"), (7, "one two three"), (None, "one two"), (8, "x " * 30000), (9, "x " * 30000), (9, "x " * 30000)]
    got = sorted(tuple(r) for r in near_duplicates(frame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 5), (7, 7), (8, 8), (9, 8), (9, 8)]
    assert near_duplicates(frame([], "doc_id long, text string")).count() == 0


def test_one_large_group(frame):
    base = [f"word{i}" for i in range(120)]
    rows = []
    for i in range(400):
        copy = list(base)
        copy[i % 120] = f"other{i}"
        rows.append((i, " ".join(copy)))
    assert {r["class_id"] for r in near_duplicates(frame(rows, "doc_id long, text string")).collect()} == {0}


def test_star_of_copies(frame):
    """Copies that are near their original only, each with another block replaced, are one class."""
    rng = random.Random(3)
    base = [f"word{i}" for i in range(400)]
    rows = [(5000, " ".join(base))]
    for i in range(2000):
        start = rng.randrange(10) * 40
        block = [f"other{i}x{k}" for k in range(70)]
        copy = [*base[:start], *block, *base[start + 70 :]] if start + 70 <= 400 else [*base[:330], *block]
        rows.append((i, " ".join(copy)))
    hashes = [np.array([hash(w) for w in text.split()]) for _, text in rows]
    near = [(i, j) for i in range(0, len(rows), 97) for j in range(i) if (hashes[i] != hashes[j]).sum() <= 80]
    assert len(near) < len(rows) * len(range(0, len(rows), 97)) / 4  # most copies are not near each other
    assert all((hashes[0] != h).sum() <= 80 for h in hashes)
    rows += [(9000 + i, " ".join(f"own{i}x{k}" if k % 3 else base[k] for k in range(400))) for i in range(20)]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i, _ in rows[:2001]} == {0}
    assert all(got[9000 + i] == 9000 + i for i in range(20))


def test_texts_of_one_id_keep_their_words(frame):
    rng = random.Random(12)
    a, b = ([f"{c}{rng.randrange(10**6)}" for _ in range(120)] for c in "ab")
    near = lambda words: " ".join(["changed", *words[1:60], "twice", *words[61:]])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, " ".join(f"c{i}" for i in range(100)))]
    for turned in (rows, rows[::-1]):
        got = sorted(tuple(r) for r in near_duplicates(frame(turned, "doc_id long, text string")).collect())
        assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


LENGTHS = (5, 6, 8, 10, 12, 15, 20, 25, 26, 40, 80, 125, 126, 200, 400)


def pairs_by_length(share, count):
    """Pairs (2i, 2i + 1) of random texts, the second with a share of its words replaced, one at least."""
    rng = random.Random(21)
    rows, lengths = [], []
    for n in LENGTHS:
        for _ in range(count):
            words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
            other = list(words)
            for i in rng.sample(range(n), max(1, int(share * n))):
                other[i] = f"x{rng.randrange(10**9)}"
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
            lengths.append(n)
    return rows, lengths


def recall_by_length(frame, share, count=20):
    rows, lengths = pairs_by_length(share, count)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    found = {}
    for i, n in enumerate(lengths):
        found.setdefault(n, []).append(got[2 * i] == got[2 * i + 1])
    assert len(set(got.values())) >= len(lengths)  # different texts stay apart
    return {n: sum(x) / len(x) for n, x in found.items()}


def test_recall_by_length(frame):
    few = recall_by_length(frame, 0.06)
    assert min(few.values()) >= 0.9, few
    more = recall_by_length(frame, 0.12)
    assert min(r for n, r in more.items() if n <= 125) >= 0.9, more


def test_classes_are_those_of_all_pairs(frame):
    """With 3 in 100 words edited, where hardly a pair escapes the sketches; more edits are a matter of recall, above."""
    rng = random.Random(31)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for _ in range(45):
        base = [word() for _ in range(rng.choice((1, 3, 4, 5, 7, 12, 30, 70, 130, 400)))]
        texts.append(base)
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(max(1, int(0.03 * len(base)))):
                at = rng.randrange(len(copy))
                rng.choice((lambda: copy.__setitem__(at, word()), lambda: copy.insert(at, word()), lambda: len(copy) > 1 and copy.pop(at)))()
            texts.append(copy)
    rng.shuffle(texts)
    codes = [np.array([int(w[1:]) for w in t]) for t in texts]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            most = int(0.2 * max(len(codes[i]), len(codes[j])) + 1e-9)
            if edit_distance(codes[i], codes[j], most) <= most:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    want = [(i, top(i)) for i in range(len(texts))]
    got = sorted(tuple(r) for r in near_duplicates(frame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect())
    assert got == want


def test_many_edits_are_counted_by_columns(monkeypatch):
    rng = random.Random(5)
    for few in (0, 2):
        monkeypatch.setattr(near, "FEW_EDITS", few)
        for _ in range(200):
            a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 80))] for _ in "ab")
            for most in (1, 10, 90):
                assert edit_distance(np.array(a, np.int32), np.array(b, np.int32), most) == min(plain_distance(a, b), most + 1)


def test_a_common_passage_makes_no_quadratic_pairs(frame, monkeypatch):
    """Texts with seven tenths in common, of other words for the rest, meet in every bucket and are no copies."""
    rng = random.Random(9)
    passage = [f"common{i}" for i in range(350)]
    rows = [(i, " ".join(passage + [f"own{rng.randrange(10**9)}" for _ in range(150)])) for i in range(300)]
    rows += [(1000 + i, text.replace("common0 ", f"other{i} ")) for i, text in rows[:20]]
    aligned, plain = [], near.verified

    def counted(pairs, words, similarity):
        aligned.append(pairs.count())
        return plain(pairs, words, similarity)

    monkeypatch.setattr(near, "verified", counted)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 1000 for i, _ in rows}
    assert sum(aligned) < 2 * len(rows), aligned


def test_words_in_common_are_never_too_few(frame):
    rng = random.Random(6)
    texts = [[rng.randint(0, 30) for _ in range(rng.randint(1, 60))] for _ in range(40)]
    words = frame([(bytes([i]), t) for i, t in enumerate(texts)], "node binary, words array<int>")
    sets = {r["node"][0]: set(r["bag"]) for r in near.bags(words).collect()}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            common = sum((Counter(a) & Counter(b)).values())
            assert len(sets[i] & sets[j]) + len(a) - len(sets[i]) >= common
            assert len(sets[i] & sets[j]) <= common + 1
