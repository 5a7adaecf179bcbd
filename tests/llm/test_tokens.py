"""Tokens against the tokenizer itself, files and packing by round trip."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldmark.llm.common import ship_package
from fieldmark.llm.packing import best_fit, pack, pack_documents, token_pieces
from fieldmark.llm.token_files import read_tokens, token_digest, write_tokens
from fieldmark.llm.tokenizing import Encoder, default_path
from fieldmark.session import work_folder

BITS = ["a", "Word", "über", "ß", "é", "é", "日本", "İ", "Σ", "'s", "'re", "don't", ".", ",", "!!", "***", "12", "x9", " ", " ", " ", "  ", "\n", "\t", "\r\n", " ", " ", "\x01", "<|", "<|endoftext|>", "|>", "-", "_", "🙂", "̀"]


def texts():
    rng = random.Random(11)
    out = [None, "", " ", "\n", "a ", " a", "a" * 3000, "word " * 9000]
    return out + ["".join(rng.choice(BITS) for _ in range(rng.randint(1, 40))) for _ in range(1500)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_exact(name):
    own, public = Encoder(default_path(name)), Tokenizer.from_file(default_path(name))
    rows = texts()
    for _ in range(2):  # the second time from the chunks kept
        got = {}
        for first, ids, counts in own.encode(pa.array(rows, pa.string()), 7):
            ends = np.cumsum(counts)
            for k, (a, b) in enumerate(zip(ends - counts, ends)):
                got[first + k] = ids[a:b].tolist()
        for i, text in enumerate(rows):
            assert got[i] == public.encode(text or "", add_special_tokens=False).ids + [7], repr(text)


def test_files_and_pruning(spark, frame):
    rows = [(i * 3, f"text number {i} " * (i % 50)) for i in range(300)] + [(None, "no id"), (6, None), (6, "again"), (6, "again")]
    path = work_folder(spark, "tokens")
    write_tokens(frame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS part"), path, default_path("byte_bpe_50k.json"), 2)
    public = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for i, text in order:
        ids = public.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted((tuple(r) for r in token_digest(read_tokens(spark, path)).collect()), key=lambda r: r[1])
    assert got == want
    plan = read_tokens(spark, path).filter("doc_id = 30")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(doc_id,30)" in plan


def test_empty_files(spark, frame):
    path = work_folder(spark, "tokens")
    write_tokens(frame([], "doc_id long, text string"), path, default_path("byte_bpe_50k.json"), 2)
    assert read_tokens(spark, path).count() == 0


def test_packing_places(frame):
    rows = [(i, "some words and more of them " * (i % 37)) for i in range(400)] + [(None, None), (5, "twice"), (5, "twice"), (900, "long " * 9000)]
    got = pack_documents(frame(rows, "doc_id long, text string"), default_path("word_bpe_49k.json"), 1, 512, block=150).collect()
    public = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    lengths = [len(public.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows]
    assert sum(r.length for r in got) == sum(lengths) and len(got) == sum(-(-n // 512) for n in lengths)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert places[0][0] == 0 and sum(n for _, n in places) <= 512
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    assert len(bins) <= -(-sum(lengths) // 512) * 1.05 + 3


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_all_capacities_hold(rule):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 200, 3000)
    sequence, offset = best_fit(lengths, 400, 5, 50_000.0, (1.0, 0.5, 0.5), rule)
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 400 and len(own) <= 5 and (own.astype(float) ** 2).sum() <= 50_000
        assert sorted(offset[sequence == s]) == sorted(np.cumsum(own[np.argsort(offset[sequence == s])]) - own[np.argsort(offset[sequence == s])])
    assert sequence.max() + 1 < len(lengths) / 2


def test_piece_too_long_is_an_error(frame):
    with pytest.raises(Exception, match="does not fit"):
        pack(frame([(1, 0, 900)], "doc_id long, piece int, length long"), 512).collect()
    assert pack(frame([], "doc_id long, piece int, length long"), 512).count() == 0


def test_ids_are_not_rounded(spark, frame):
    """Beside rows without an id, large ids keep their last digit; all rows without an id are not one block."""
    ship_package(spark)
    rows = [(9007199254740993, "a b c"), (None, "x y"), (None, None), (9007199254740993, "a b c")] + [(None, "same text")] * 50
    df = frame(rows, "doc_id long, text string").selectExpr("*", "'o' AS offset", "1 AS piece", "2 AS sequence_id")
    pieces = token_pieces(df, default_path("word_bpe_49k.json"), 1, 4096)
    packed = pack(pieces.withColumn("offset", F.lit("clash")), block=10)
    got = packed.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert len({r.sequence_id for r in got}) > 1
    for sequence in {r.sequence_id for r in got}:
        here = sorted((r.offset, r.length) for r in got if r.sequence_id == sequence)
        assert all(a + n == b for (a, n), (b, _) in zip(here, here[1:])) and here[0][0] == 0


def test_places_against_a_plain_version(frame):
    """Best fit by hand: longest first into the fullest sequence with room."""
    draw = np.random.default_rng(6)
    lengths = [int(x) for x in draw.integers(1, 100, 300)]
    df = frame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    got = pack(df, max_tokens=100, block=1000).collect()
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            best = min(fits, key=lambda i: room[i])
            room[best] -= n
        else:
            room.append(100 - n)
    used = {}
    for r in got:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sorted(used.values()) == sorted(100 - r for r in room)
