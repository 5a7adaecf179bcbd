"""The subsequence kernel and a small trained machine."""

import random

import numpy as np
import pyarrow as pa

from fieldmark.llm.toxicity import bare_word, fit_machine, score_toxicity, sentence_windows, subsequences, train_toxicity


def alike(a, b):
    word, bucket, weight = subsequences([a, b])
    table = np.zeros((2, 1 << 18))
    np.add.at(table, (word, bucket), weight)
    return float(table[0] @ table[1])


def test_gaps_and_insertions_count():
    assert alike("scoundrel", "scoundrel") > 0.9
    assert alike("scoundrel", "scounxdrel") > 0.4 > alike("scoundrel", "beautiful")
    assert alike("", "x") == 0
    assert alike("long" * 40, "long" * 40) > 0.5


def test_windows():
    words, place, window, text = sentence_windows(pa.array(["You f-o-o! y o u s bar.\nnext", "", "one " * 60]))
    assert bare_word("f-o-o!") == "foo" and {"foo", "yous", "bar", "next"} <= set(words)
    assert len(set(window[text == 0])) == 4 and len(set(window[text == 2])) == 3


def rows_for_test():
    rng = random.Random(9)
    calm = ["table", "window", "garden", "little", "yellow", "summer", "bottle", "market", "silver", "planet", "river", "stone"]
    rude = ["scoundrel", "nincompoop", "blockhead"]
    rows = []
    for i in range(240):
        words = [rng.choice(calm) for _ in range(rng.randint(5, 40))]
        toxic = i % 4 == 0
        if toxic:
            words.insert(rng.randint(0, len(words)), rng.choice(rude))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_and_disguised(frame):
    rows = rows_for_test()
    labels = frame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    asked = [(1000, "a yellow scoundrel"), (1001, "a yellow garden"), (1002, "you s.c.o.u.n.d.r.e.l"), (1003, "n i n c o m p o o p in summer"), (1004, "blockxhead market"), (1005, None), (1006, ""), (None, "garden")]
    docs = frame([(i, t) for i, t, _ in rows] + asked, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS word")
    machine = train_toxicity(docs, labels)
    got = {(r["doc_id"], r["text"]): r["score"] for r in score_toxicity(docs, machine).collect()}
    by = {i: s for (i, _), s in got.items()}
    # From 0.3 on a text counts as toxic; an inserted letter costs weight, not the decision.
    assert min(by[1000], by[1002], by[1003]) > 0.5 and by[1004] >= 0.3
    assert max(by[1001], by[1005], by[1006], by[None]) < 0.3
    assert all(0 <= s <= 1 for s in got.values())
    right = sum((by[i] >= 0.3) == bool(t) for i, _, t in rows)
    assert right >= 0.95 * len(rows)


def test_one_class_and_empty(frame):
    machine = fit_machine(["a b", "c d"], np.array([0, 0]))
    docs = frame([(1, "a")], "doc_id long, text string")
    assert score_toxicity(docs, machine).first()["score"] < 0.3
    empty = frame([], "doc_id long, text string")
    assert score_toxicity(empty, train_toxicity(empty, frame([], "doc_id long, toxic int"))).count() == 0
