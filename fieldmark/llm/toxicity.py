"""Toxicity by a support vector machine on a gapped subsequence kernel.

Two words are alike in so far as they share subsequences of 3 and 4 characters, each
weighed by DECAY to the power of its span; spans reach two characters beyond the
subsequence, so an inserted or left-out character costs weight and no more.  The kernel
of two sentences is the sum over their pairs of words.  Landmark words and the inverse
root of their kernel matrix give Nystroem features, on which a linear machine is trained
with labelled sentences.  The kernel of sentences being a sum over words, each word has
one value, which is computed once per distinct word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.language import held_out, training_rows
from fieldmark.llm.tokenizing import release
from fieldmark.session import stored

DECAY = 0.7
REACH = 2  # characters a subsequence may skip
LENGTHS = (3, 4)
BUCKETS = 1 << 18
POWER = 4  # of the kernel of two words, so that words alike in part hardly count
MAX_WORD = 40  # longer words are read as overlapping stretches of this length
WINDOW = 24  # words at most in one sentence window
KEPT_WORDS = 400_000
KERNEL_WORDS = 250  # words whose kernel values are worked out at once
ROWS = 4_096
SLICE_BYTES = 2_000_000

PATTERNS = [
    (0, *inner, last)
    for size in LENGTHS
    for last in range(size - 1, size + REACH)
    for inner in combinations(range(1, last), size - 2)
]


def bare_word(token: str) -> str:
    """Letters and digits of a token: signs put between the letters go."""
    return "".join(c for c in token if c.isalnum())


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, bucket, weight) of all subsequences, scaled so that each word has norm one."""
    stretches: list[str] = []
    owner: list[int] = []
    for i, word in enumerate(words):
        marked = f"^{word}$" if word else ""
        for k in range(0, max(1, len(marked) - max(LENGTHS) - REACH), MAX_WORD):
            stretches.append(marked[k : k + MAX_WORD + max(LENGTHS) + REACH])
            owner.append(i)
    width = MAX_WORD + max(LENGTHS) + REACH
    chars = np.zeros((len(stretches), width + max(LENGTHS) + REACH), np.uint64)
    lens = np.array([len(s) for s in stretches], np.int64)
    if lens.sum():
        flat = np.frombuffer("".join(stretches).encode("utf-32-le"), "<u4").astype(np.uint64)
        row = np.repeat(np.arange(len(stretches)), lens)
        chars[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    top = int(lens.max()) if len(lens) else 0
    for pattern in PATTERNS:
        code = np.full((len(stretches), top), len(pattern), np.uint64)
        for step in pattern:
            code = (code ^ chars[:, step : step + top]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        there = np.arange(top)[None, :] + pattern[-1] < lens[:, None]
        # A long word's stretches overlap; its own places end at MAX_WORD.
        there &= (np.arange(top) < MAX_WORD)[None, :] | (lens[:, None] < width)
        row, at = np.nonzero(there)
        weight = DECAY ** (pattern[-1] + 1)
        found.append((row, (code[row, at] >> np.uint64(40)).astype(np.int64) % BUCKETS, np.full(len(row), weight)))
    row = np.concatenate([f[0] for f in found])
    bucket = np.concatenate([f[1] for f in found])
    weight = np.concatenate([f[2] for f in found])
    word = np.array(owner, np.int64)[row] if len(owner) else row
    norm = np.sqrt(np.bincount(word, weight**2, minlength=len(words)))
    return word, bucket, weight / np.maximum(norm[word], 1e-12)


def sentence_windows(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, and per place in the texts: word, sentence window, text.

    Blanks part words; a newline, or a sign . ! ? at a word's end, ends a sentence, and
    sentences longer than WINDOW words are cut.  Three and more single letters in a row
    are one more word, spelled out.
    """
    plain = pc.replace_substring_regex(pc.replace_substring(pc.utf8_lower(texts), "\n", " \n "), r"[\t\r\x{0b}\x{0c}\x{a0}]", " ")
    split = pc.split_pattern(plain, " ")
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    tokens = coded.dictionary.to_pylist()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words: dict[str, int] = {}
    word_of = np.array([words.setdefault(bare_word(t), len(words)) for t in tokens], np.int64)
    stops = np.array([t == "\n" or t[-1:] in (".", "!", "?") for t in tokens], bool)
    single = np.array([len(t) == 1 and t.isalpha() for t in tokens], bool)
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    place = word_of[code]
    begin = np.ones(len(code), bool)
    if len(code):
        begin[1:] = stops[code[:-1]] | (text[1:] != text[:-1])
    sentence = np.cumsum(begin) - 1
    first = np.flatnonzero(begin)
    inside = np.arange(len(code)) - first[sentence] if len(code) else sentence
    window = np.unique(sentence * (1 << 32) + inside // WINDOW, return_inverse=True)[1]
    if len(code):
        lone = single[code] & np.concatenate([[True], (text[1:] == text[:-1])])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], single[code].astype(np.int8), [0]])))
        extra = [(a, b) for a, b in zip(edges[::2], edges[1::2]) if b - a >= 3 and lone[a + 1 : b].all()]
        if extra:
            spelled = [words.setdefault("".join(tokens[code[i]] for i in range(a, b)), len(words)) for a, b in extra]
            starts = np.array([a for a, _ in extra])
            place, window, text = np.concatenate([place, spelled]), np.concatenate([window, window[starts]]), np.concatenate([text, text[starts]])
    return list(words), place, window, text


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, penalty: float, rounds: int = 8) -> np.ndarray:
    """Weights of the L2 machine with squared hinge loss, by Newton steps on the active rows."""
    beta = np.zeros(x.shape[1])
    eye = penalty * np.eye(x.shape[1])
    eye[-1, -1] = 1e-6  # the last column is the constant
    active = None
    for _ in range(rounds):
        now = y * (x @ beta) < 1
        if active is not None and (now == active).all():
            break
        active = now
        gram, pull = eye.copy(), np.zeros(len(beta))
        for k in range(0, len(x), ROWS):  # in pieces, to make no copy of all rows
            rows = active[k : k + ROWS] & (cost[k : k + ROWS] > 0)
            part = x[k : k + ROWS][rows]
            scaled = part * cost[k : k + ROWS][rows][:, None]
            gram += part.T @ scaled
            pull += scaled.T @ y[k : k + ROWS][rows]
        beta = np.linalg.solve(gram, pull)
    return beta


def logistic(x: np.ndarray, y: np.ndarray, worth: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = worth * p * (1 - p)
        step = np.linalg.solve(x.T @ (x * slope[:, None]) + penalty * np.eye(x.shape[1]), x.T @ (worth * (y - p)) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Machine:
    """Landmarks by subsequence bucket, their coefficients, and the calibration of a document.

    `first[b]:first[b + 1]` are the entries of bucket b in `landmark` and `weight`.
    """

    first: np.ndarray
    landmark: np.ndarray
    weight: np.ndarray
    coefficients: np.ndarray
    constant: float
    calibration: np.ndarray

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel values of words (rows) with the landmarks (columns)."""
        m = len(self.coefficients)
        word, bucket, weight = subsequences(words)
        begin, n = self.first[bucket], self.first[bucket + 1] - self.first[bucket]
        hit = n > 0
        word, weight, begin, n = word[hit], weight[hit], begin[hit], n[hit]
        ends = np.cumsum(n)
        entry = np.repeat(begin - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
        cell = np.repeat(word * m, n) + self.landmark[entry]
        alike = np.bincount(cell, np.repeat(weight, n) * self.weight[entry], minlength=len(words) * m)
        return np.clip(alike.reshape(len(words), m), 0, None) ** POWER

    def word_values(self, words: list[str]) -> np.ndarray:
        if not len(self.coefficients):
            return np.zeros(len(words))
        parts = [self.kernel(words[k : k + KERNEL_WORDS]) @ self.coefficients for k in range(0, len(words), KERNEL_WORDS)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def document_features(self, values: np.ndarray, window: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
        """Highest window, what windows have above the negative margin, length, constant."""
        n = int(window.max()) + 1 if len(window) else 0
        score = np.bincount(window, values, minlength=n) + self.constant
        of = np.zeros(n, np.int64)
        of[window] = text
        best = np.full(texts, self.constant)
        np.maximum.at(best, of, score)
        above = np.bincount(of, np.maximum(score + 0.5, 0), minlength=texts)
        size = np.bincount(text, minlength=texts)
        return np.stack([best, np.log1p(above), above / np.sqrt(size + 1.0), np.log1p(size), np.ones(texts)], axis=1)


def fit_machine(texts: list[str], labels: np.ndarray, prior: float | None = None, landmarks: int = 256, penalty: float = 0.3, rounds: int = 3) -> Machine:
    """Train on labelled documents, whose sentences take their labels.

    Not every sentence of a toxic document is toxic: after each round only those above
    the margin's middle, and the highest of each document, stay positive examples.
    `prior` is the share of label 1 outside the sample; the calibration weighs by it.
    """
    share = float(labels.mean()) if len(labels) else 0.0
    prior = share if prior is None else prior
    if not len(texts) or labels.min() == labels.max():
        odds = np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))
        none = np.zeros(0)
        return Machine(np.zeros(BUCKETS + 1, np.int64), none.astype(np.int64), none, none, 0.0, np.array([0, 0, 0, 0, odds]))
    words, place, window, text = sentence_windows(pa.array(texts, pa.string()))
    # Landmarks: words whose documents are toxic most clearly, then frequent ones.
    seen = np.unique(place * len(texts) + text)
    toxic = np.bincount(seen // len(texts), labels[seen % len(texts)], minlength=len(words))
    clean = np.bincount(seen // len(texts), minlength=len(words)) - toxic
    lift = toxic * np.log((toxic + 0.5) / labels.sum() * (1 - labels).sum() / (clean + 0.5))
    lift[[i for i, w in enumerate(words) if not w]] = -np.inf
    order = np.lexsort((np.arange(len(words)), -lift))
    common = np.lexsort((np.arange(len(words)), -(toxic + clean)))
    chosen = [i for i in dict.fromkeys([*order[: landmarks * 3 // 4], *common[:landmarks]]) if words[i]][:landmarks]
    owner, bucket, weight = subsequences([words[i] for i in chosen])
    by = np.argsort(bucket, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))])
    machine = Machine(first, owner[by], weight[by], np.zeros(len(chosen)), 0.0, np.zeros(5))
    values, vectors = np.linalg.eigh(machine.kernel([words[i] for i in chosen]))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    n = int(window.max()) + 1
    x = np.zeros((n, root.shape[1] + 1), np.float32)
    x[:, -1] = 1.0
    # Words in turn, each added to the windows it stands in: no table of all words' features.
    by = np.lexsort((window, place // ROWS))
    edges = np.searchsorted(place[by] // ROWS, np.arange(-(-len(words) // ROWS) + 1))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        part = words[k * ROWS : (k + 1) * ROWS]
        features = np.concatenate([machine.kernel(part[i : i + KERNEL_WORDS]) @ root for i in range(0, len(part), KERNEL_WORDS)])
        for c in range(a, b, 4 * ROWS):
            rows = by[c : min(b, c + 4 * ROWS)]
            at, first_of = np.unique(window[rows], return_index=True)
            x[at, :-1] += np.add.reduceat(features[place[rows] - k * ROWS], first_of, axis=0)
    of = np.zeros(n, np.int64)
    of[window] = text
    positive = labels[of] == 1
    used = np.ones(n, bool)
    for _ in range(rounds):
        y = np.where(positive, 1.0, -1.0).astype(np.float32)
        balance = min(20.0, (~positive & used).sum() / max(1, (positive & used).sum()))
        cost = np.where(positive, balance, used).astype(np.float32)
        beta = squared_hinge(x, y, cost, penalty)
        score = x @ beta
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, of, score)
        positive = (labels[of] == 1) & ((score > 0) | (score >= best[of]))
        used = positive | (labels[of] == 0)
    machine.coefficients, machine.constant = root @ beta[:-1], float(beta[-1])
    found = machine.document_features(machine.word_values(words)[place], window, text, len(texts))
    worth = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    machine.calibration = logistic(found, labels, worth)
    return machine


def train_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", per_label: int = 1000, max_chars: int = 40_000) -> Machine:
    """A machine from at most `per_label` documents of each label, of up to `max_chars` each.

    The bounds hold for training alone and keep the sample that comes to the driver,
    and the model that every task holds, the same size for any corpus.
    """
    known = labels.filter(F.col(label).isin(0, 1)).select(doc_id, F.col(label).cast("int").alias("__label")).dropDuplicates([doc_id])
    chosen = stored(training_rows(known, "__label", per_label, doc_id), "sample")
    prior = known.filter(~held_out(doc_id)).agg(F.avg("__label")).first()[0]
    rows = docs.select(doc_id, F.col(text).cast("string").alias("__text")).filter(F.length("__text").between(1, max_chars))
    sample = rows.join(F.broadcast(chosen), doc_id).dropDuplicates(["__text"]).select(doc_id, "__text", "__label").toPandas()
    sample = sample.sort_values([doc_id, "__text"])
    return fit_machine(sample["__text"].tolist(), sample["__label"].to_numpy(np.int64), prior)


def score_toxicity(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Add score (0 to 1) to the rows of `docs`; a NULL text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kept = [c for c in docs.columns if c != "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known: dict[str, float] = {}
        for batch in batches:
            texts = pc.fill_null(batch.column(at).cast(pa.string()), "")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < len(texts):
                floor = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, floor + SLICE_BYTES, "right")))
                words, place, window, of = sentence_windows(texts.slice(first, last - first))
                new = [w for w in words if w not in known]
                if len(known) + len(new) > KEPT_WORDS:
                    known, new = {}, words
                known.update(zip(new, model.word_values(new).tolist()))
                values = np.fromiter(map(known.__getitem__, words), float, len(words))
                features = model.document_features(values[place], window, of, last - first)
                chance = 1 / (1 + np.exp(-np.clip(features @ model.calibration, -30, 30)))
                rest = [column.slice(first, last - first) for column in batch.columns]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(chance)], names=[*batch.schema.names, "score"])
                first = last
            release()

    fields = docs.select(*kept).schema.fields
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "score double"])
    at = kept.index(text)
    return docs.select(*kept).mapInArrow(score, schema)
