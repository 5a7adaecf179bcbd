"""Fingerprints: edited texts against a plain version, likeness."""

import hashlib
import random

from fieldmark.llm.fingerprints import fingerprints


def rows_for_test():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(900)]
    rows = [(i * 2, " ".join(rng.choice(words) for _ in range(rng.randint(0, 400)))) for i in range(120)]
    return rows + [(1001, rows[3][1]), (1003, None), (1005, ""), (1007, "é𝒳ß" * 50), (1009, "x")]


def test_edited_texts_and_likeness(frame):
    rows = rows_for_test()
    df = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_chars", "2 AS __pos", "3 AS h")
    got = {r["doc_id"]: r for r in fingerprints(df).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    near, following = [], []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[1][:cut]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text == edited:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
        if len(text) > 500:
            near.append(r["near_edited"])
            following.append(r["near_next"])
    assert got[1001]["fingerprint"] == got[6]["fingerprint"]
    assert sum(near) / len(near) > 0.3 > 3 * sum(following) / len(following)


def test_repeated_rows_and_no_ids(frame):
    rows = [(1, "a b c"), (1, "a b c"), (2, "a b d"), (None, "a b"), (None, "a b"), (2, "other")]
    got = fingerprints(frame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6
    by = {}
    for r in got:
        by.setdefault((r["doc_id"], r["n_chars"]), set()).add(tuple(r))
    assert set(by) == {(1, 5), (2, 5), (None, 3)} and len(by[2, 5]) == 2
    assert len({tuple(r) for r in got if r["doc_id"] == 1}) == 1
    assert len({tuple(r) for r in got if r["doc_id"] is None}) == 1


def test_small_tables(frame):
    assert fingerprints(frame([], "doc_id long, text string")).count() == 0
    one = fingerprints(frame([(5, "abcdef")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1


def test_near_copies_that_hold_a_third_of_the_rows(frame):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    stop, other, base = [word() for _ in range(10)], [word() for _ in range(400)], [word() for _ in range(80)]
    rows = []
    for i in range(80):
        copy = list(base)
        copy[rng.randrange(80)] = rng.choice(other)
        rows.append((i, " ".join(stop + copy)))
    rows += [(100 + i, " ".join(stop + rng.sample(other, 80))) for i in range(80)]
    rows += [(300 + i, rows[80][1]) for i in range(80)]
    got = {r["doc_id"]: r for r in fingerprints(frame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i]["near_next"] for i in range(1, 80)) / 79 > 0.7
    alone = [got[100 + i]["near_next"] for i in range(1, 80)]
    assert sum(alone) / 79 < 0.4
    assert len({got[300 + i]["fingerprint"] for i in range(80)}) == 1
    assert not any(r["fingerprint"].startswith("text:") for r in got.values())


def test_long_texts_with_few_changes_differ(frame):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(24):
        chosen = rng.sample(words, 600)
        rows.append((2 * i, " ".join(chosen)))
        rows.append((2 * i + 1, " ".join(rng.sample(words, 18) + chosen[18:])))
    got = {r["doc_id"]: r for r in fingerprints(frame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * i]["fingerprint"] != got[2 * i + 1]["fingerprint"] for i in range(24))
    assert sum(got[2 * i + 1]["near_next"] for i in range(24)) / 24 > 0.8
