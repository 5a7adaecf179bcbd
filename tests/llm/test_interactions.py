"""Filter interactions against a walk through all orders, document by document."""

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from fieldmark.llm.interactions import copies_of_smaller, filter_interactions

NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failing(docs, i, text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
        out.add("C")
    if re.search(r"[#$%&*|]", t):
        out.add("D")
    if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
        out.add("E")
    return out


def plain(docs, labels):
    out = {}
    parts = {lang or "" for _, _, lang in docs}
    for order in permutations("ABCDE"):
        for part in parts:
            for step in range(5):
                out[part, "".join(order), step + 1] = [0] * 7
    fails = [(lang or "", i, failing(docs, i, t)) for i, t, lang in docs]
    for part, i, failed in fails:
        good = any(j == i and q == 1 for j, q, _ in labels if i is not None)
        toxic = any(j == i and x == 1 for j, _, x in labels if i is not None)
        for order in permutations("ABCDE"):
            gone = False
            for step, name in enumerate(order):
                row = out[part, "".join(order), step + 1]
                if name in failed:
                    row[2 if gone else 1] += 1
                    if not gone:
                        row[4] += good
                        row[5] += toxic
                    row[3] += failed == {name}
                    gone = True
                row[0] += not gone
    for (part, order, step), row in out.items():
        name = order[step - 1]
        row[6] = sum(out[part, "".join(o), o.index(name) + 1][1] for o in permutations("ABCDE"))
    return sorted((*k, *v) for k, v in out.items())


def sample():
    rng = random.Random(2)
    many = [" ".join(f"w{rng.randint(0, n)}" for _ in range(m)) for n, m in ((5000, 150), (40, 150), (5000, 60), (30, 60), (9, 9))]
    many += [many[0] + " #", many[1].upper(), "ABC DEF", None, "", "x y", many[0]]
    docs = [(i, rng.choice(many), rng.choice(["en", "de", None, ""])) for i in range(60)]
    docs += [(None, many[0], "en"), (None, many[0], "en"), (7, many[2], "fr"), (7, many[2], "fr"), (8, many[3], "de"), (8, many[0], "de")]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 60, 2)] + [(4, 1, None), (4, 0, 1), (6, None, None), (None, 1, 1)]
    return docs, labels


def test_against_plain(frame):
    docs, labels = sample()
    df = frame(docs, "doc_id long, text string, lang string").selectExpr("*", "1 AS step", "2 AS __bits", "'x' AS part", "3 AS __n", "4 AS quality")
    marks = frame(labels, "doc_id long, quality int, toxic int")
    found = filter_interactions(df, marks)
    assert found.columns == NAMES
    assert sorted(tuple(r) for r in found.collect()) == plain(docs, labels)


def test_a_group_of_copies_meets_one_row(frame):
    rows = [(i, "one text of all") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(50)] + [(None, "one text of all")]
    got = copies_of_smaller(frame(rows, "doc_id long, text string").repartition(8))
    assert sorted(r[0] for r in got.select("__id").collect()) == list(range(1, 3000))


def test_empty_and_other_filters(frame):
    labels = frame([], "doc_id long, quality int, toxic int")
    assert filter_interactions(frame([], "doc_id long, text string, lang string"), labels).count() == 0
    docs = frame([(1, "a", "en"), (2, "a", "en"), (3, "b" * 200_000, "en")], "doc_id long, text string, lang string")
    got = filter_interactions(docs, labels, filters={"L": F.length("text") > 5}, copies="C")
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.shapley) for r in got.collect()}
    assert rows == {("LC", 1): (2, 1, 2), ("LC", 2): (1, 1, 2), ("CL", 1): (2, 1, 2), ("CL", 2): (1, 1, 2)}
