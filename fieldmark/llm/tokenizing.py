"""Exact ids of a public tokenizer for whole columns of text, in Arrow batches.

A text is cut into chunks at places no merge rule can cross, each distinct chunk
is encoded once, and the ids of the texts are gathered from the chunks.  Texts in
which such a place is not certain (runs of blanks, other blanks than space and
newline, special tokens) are encoded whole by the tokenizer itself.
"""

from __future__ import annotations

import ctypes
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Distinct chunks a worker keeps before it starts over, and bytes of text taken at once.
KEPT_CHUNKS = 300_000
SLICE_BYTES = 4_000_000
JOINED = 512
# Fixed value: how byte-level vocabularies write a blank.
BLANK = "Ġ"

# Between such a letter and such an ASCII sign or digit (apostrophes aside) every pre-tokenizer here cuts.
# The capital I with dot is no such letter, as its lower case ends in a mark.
LETTER_SIGN = r"([a-zA-Z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}])([^'\sa-zA-Z\x{00}-\x{1f}\x{7f}-\x{10ffff}])"
ODD = (
    r"[ \n]{2}|[\x{01}\t\r\x{0b}\x{0c}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]|<\|"
)


def default_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """One tokenizer file with the chunks seen so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Without a normalizer blanks count; with one, they are dropped and case is folded.
        self.blanks_count = self.tokenizer.normalizer is None
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.lens = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _chunks(self, texts: pa.Array) -> pa.Array:
        if self.blanks_count:
            marked = pc.replace_substring_regex(texts, LETTER_SIGN, "\\1\x01\\2")
            marked = pc.replace_substring(marked, " ", "\x01 ")
            return pc.split_pattern(pc.replace_substring(marked, "\n", "\x01\n\x01"), "\x01")
        plain = pc.ascii_lower(pc.replace_substring(texts, "\n", " "))
        return pc.split_pattern(pc.replace_substring_regex(plain, LETTER_SIGN, "\\1 \\2"), " ")

    def _encode_new(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The chunks in the order in which they are encoded, their numbers of ids, and all ids.

        Chunks that stay apart when joined are encoded together.
        """
        joint = (lambda c: c[:1] == " " and len(c) > 1) if self.blanks_count else (lambda c: c != "")
        together = [c for c in chunks if joint(c)]
        alone = [c for c in chunks if c and not joint(c)]
        got = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
        lens, ids = self._encode_joined(together)
        empty = [c for c in chunks if not c]
        more = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((x for row in got for x in row), np.uint32, int(more.sum()))
        return together + alone + empty, np.concatenate([lens, more, np.zeros(len(empty), np.int64)]), np.concatenate([ids, flat])

    def _encode_joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [chunks[k : k + JOINED] for k in range(0, len(chunks), JOINED)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        if self.blanks_count:
            # Each chunk has one blank, at its start, so its first id is the one that begins with a blank.
            got = self.tokenizer.encode_batch_fast(["".join(p) for p in parts], add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in got])
            begins = np.flatnonzero(self.opens[ids])
            if len(begins) == len(chunks):
                return np.diff(np.append(begins, len(ids))), ids
        glue = "" if self.blanks_count else "\n"
        lens, ids = [], []
        for part in parts:
            got = self.tokenizer.encode(glue.join(part), add_special_tokens=False)
            places = np.fromiter((p[0] for p in got.offsets), np.int64, len(got.ids))
            begins = np.cumsum([0, *[len(c) + len(glue) for c in part]])
            lens.append(np.diff(np.searchsorted(places, begins)))
            ids.append(np.array(got.ids, np.uint32))
        return np.concatenate(lens), np.concatenate(ids)

    def _places(self, chunks: list[str]) -> np.ndarray:
        """Index of each distinct chunk, encoding those not met before."""
        if len(self.index) > KEPT_CHUNKS:
            self._clear()
        get = self.index.get
        new = [c for c in chunks if get(c) is None]
        if new:
            new, lens, flat = self._encode_new(new)
            base = len(self.lens)
            self.index.update(zip(new, range(base, base + len(new))))
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lens) - lens])
            self.lens = np.concatenate([self.lens, lens])
            self.pool = np.concatenate([self.pool, flat])
        return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))

    def _regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = self._chunks(texts)
        coded = words.flatten().dictionary_encode()
        place = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy(zero_copy_only=False)]
        lens = self.lens[place]
        ends = np.cumsum(lens)
        ids = self.pool[np.repeat(self.starts[place] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
        edges = np.concatenate([[0], ends])[offsets]
        return ids, np.diff(edges)

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, ODD)
        is_odd = odd.to_numpy(zero_copy_only=False).astype(bool)
        if not is_odd.any():
            return self._regular(texts)
        ids, counts = np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if not is_odd.all():
            ids, counts[~is_odd] = self._regular(texts.filter(pc.invert(odd)))
        whole = self.tokenizer.encode_batch_fast(texts.filter(odd).to_pylist(), add_special_tokens=False)
        counts[is_odd] = [len(e.ids) for e in whole]
        out = np.empty(int(counts.sum()), np.uint32)
        from_odd = np.repeat(is_odd, counts)
        out[~from_odd] = ids
        out[from_odd] = np.fromiter((x for e in whole for x in e.ids), np.uint32, int(from_odd.sum()))
        return out, counts

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, ids per row) of slices of the column, each text ended by `end_id`."""
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(texts):
            floor = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, floor + SLICE_BYTES, "right")))
            ids, counts = self._slice(texts.slice(first, last - first))
            counts = counts + 1
            ends = np.cumsum(counts) - 1
            out = np.full(int(counts.sum()), end_id, np.uint32)
            inside = np.ones(len(out), bool)
            inside[ends] = False
            out[inside] = ids
            yield first, out, counts
            first = last
        release()


_ENCODERS: dict[str, Encoder] = {}
# The C library's allocator keeps freed blocks otherwise; other libraries have no such call.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def encoder(path: str) -> Encoder:
    """The encoder of this worker for a file; workers live on from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def release() -> None:
    """Give freed memory back to the system, as workers live on next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").data)
