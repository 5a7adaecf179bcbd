"""Code lengths against a plain byte-by-byte model, and predictions."""

import math
from collections import Counter, defaultdict

import numpy as np

from fieldmark.llm.language import ORDER, ContextTrees, held_out, predict_language, train_language


def plain_bits(train, text):
    counts = defaultdict(Counter)
    for one in train:
        data = one.encode()
        for i in range(len(data)):
            for k in range(ORDER + 1):
                if i >= k:
                    counts[data[i - k : i]][data[i]] += 1
    data, total = b"\n" * ORDER + text.encode(), 0.0
    for i in range(ORDER, len(data)):
        bits = 0.0
        for k in range(ORDER, -1, -1):
            seen = counts.get(data[i - k : i])
            if not seen:
                continue
            n, t = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / (n + t))
                break
            bits -= math.log2(t / (n + t))
        else:
            bits += 8
        total += bits
    return total


def grams(train):
    out = []
    for k in range(1, ORDER + 2):
        found = Counter()
        for one in train:
            data = one.encode()
            for i in range(len(data) - k + 1):
                found[int.from_bytes(data[i : i + k], "big")] += 1
        keys = sorted(found)
        out.append((np.array(keys, np.int64), np.array([found[g] for g in keys], np.int64)))
    return out


def test_code_lengths_are_exact():
    train = {"a": ["the cat sat on the mat\n", "a cat"], "b": ["der Hund saß\n", "über den Hund"]}
    trees = ContextTrees.fit({name: grams(texts) for name, texts in train.items()})
    for text in ["the cat", "der Hund über", "zzz", "", "sat\nHund", "日本", "t"]:
        data = np.frombuffer(text.encode(), np.uint8)
        got = trees.code_lengths(data, np.array([0, len(data)]))[0]
        want = [plain_bits(train[name], text) for name in trees.languages]
        assert np.allclose(got, want, rtol=1e-4, atol=1e-3), text


def test_predictions(frame):
    rows = [(i, "the quick brown fox and the lazy dog", "en") for i in range(40)]
    rows += [(100 + i, "der schnelle braune Fuchs und der faule Hund", "de") for i in range(40)]
    asked = [(500, "the dog", None), (501, "der Hund", None), (502, None, "en"), (503, "", "en"), (504, "12 34", "en"), (None, "the fox", None), (500, "the dog", None)]
    df = frame(rows + asked, "doc_id long, text string, lang string").selectExpr("*", "1 AS label", "2 AS score", "3 AS gram")
    model = train_language(df)
    got = predict_language(df.filter("doc_id IS NULL OR doc_id >= 500"), model)
    assert {"label", "gram"} <= set(got.columns)
    found = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in got.collect()}
    assert found[500, "the dog"][0] == "en" and found[501, "der Hund"][0] == "de" and found[None, "the fox"][0] == "en"
    assert found[502, None] == found[503, ""] == found[504, "12 34"] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in found.values()) and got.count() == 7


def test_held_out_and_empty(frame):
    import zlib

    df = frame([(i,) for i in [*range(200), None]], "doc_id long")
    for r in df.select("doc_id", held_out().alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    empty = frame([], "doc_id long, text string, lang string")
    model = train_language(empty)
    assert predict_language(empty, model).count() == 0
    assert predict_language(frame([(1, "text", None)], "doc_id long, text string, lang string"), model).first()["lang_pred"] == "und"


def test_held_out_labels_are_not_learned(frame):
    import zlib

    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "zzz yyy", "secret") if i in out else (i, "plain words here", "en") for i in range(400)]
    assert train_language(frame(rows, "doc_id long, text string, lang string")).languages == ["en"]
