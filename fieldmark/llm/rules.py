"""Quality rules: one pass over the texts, a ledger of failure bits, policies on the ledger.

Each rule is evaluated once.  The ledger holds a row's measurements and one bit per rule
that it fails; verdicts of any number of policies, and what each rule changes, are then
bitwise arithmetic on the ledger, without the texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.tokenizing import release

# What is measured of a text.  Sizes are in code points.
MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct_words n_upper n_digits n_ellipses"
).split()

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
CONTINUED = bytes(range(0x80, 0xC0))
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """A condition on the measurements, in SQL, under which a text fails."""

    name: str
    fails: str


# The place of a rule is its bit, so new rules go to the end and none is ever removed.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("shouting", "100 * n_upper > 30 * word_chars"),
    Rule("duplicate_lines", "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("digits", "100 * n_digits > 20 * word_chars"),
    Rule("ellipses", "100 * n_ellipses > 30 * n_lines"),
    Rule("some_symbols", "50 * n_symbols > n_words"),
    Rule("some_repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("some_duplicate_lines", "n_dup_lines > 2 AND 100 * n_dup_lines > 15 * n_lines"),
)


@dataclass(frozen=True)
class Policy:
    """A text is rejected if it fails a rule of `rejects`, or more than `allowed` of `doubts`."""

    name: str
    version: int
    rejects: tuple[str, ...]
    doubts: tuple[str, ...] = ()
    allowed: int = 1

    @property
    def label(self) -> str:
        return f"{self.name}_v{self.version}"


BASE = Policy("base", 1, ("few_words", "repeated_words"))
PROSE = Policy(
    "prose",
    1,
    ("few_words", "repeated_words", "symbols", "shouting", "duplicate_lines", "short_words", "long_words", "digits", "ellipses"),
    ("some_symbols", "some_repeated_words", "some_duplicate_lines"),
)


def repeated_words(codes: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more; `codes` numbers the words."""
    n = len(codes)
    if n <= WINDOW:
        return 0
    size = int(codes.max()) + 1
    window = codes[:-2] * size + codes[1:-1]
    if size > 2**20:  # three numbers would not go into one
        window = np.unique(window, return_inverse=True)[1]
    _, place, times = np.unique(window * size + codes[2:], return_inverse=True, return_counts=True)
    twice = times[place] > 1
    inside = np.zeros(n, bool)
    for k in range(WINDOW):
        inside[k : n - WINDOW + 1 + k] |= twice
    return int(inside.sum())


def measure(raw: bytes) -> tuple[int, ...]:
    """MEASURES of a text in UTF-8.

    Words are runs without `[\\x20\\x09-\\x0D]`, at which `bytes.split` parts, and all
    signs that count are ASCII, so nothing is decoded.
    """

    def count(signs: bytes) -> int:
        return len(raw) - len(raw.translate(None, signs))

    words = raw.split()
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(raw) - count(CONTINUED) - count(BLANKS),
        count(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(codes),
        len(lines),
        len(number),
        count(UPPER),
        count(DIGITS),
        sum(line.rstrip().endswith((b"...", "…".encode())) for line in lines),
    )


def bit(rules: Sequence[Rule], names: Sequence[str]) -> int:
    """The mask of the named rules; an unknown name is an error."""
    place = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << place[n] for n in set(names))


def quality_ledger(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The columns of `docs` without `text`, then MEASURES and `failures`, a bit per failed rule.

    One row per row, in one pass without a shuffle.  A NULL text measures as an empty one:
    no words, all counts 0.  Equal texts get equal rows, whatever else is in them.  Columns
    of `docs` with the name of a measurement or `failures` are replaced.  At most 63 rules.
    """
    if len(rules) > 63 or len({r.name for r in rules}) < len(rules):
        raise ValueError("at most 63 rules, each with a name of its own")
    rest = [c for c in docs.columns if c != text and c not in MEASURES and c != "failures"]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One text at a time: the batch itself is all that is held.
            rows = [measure(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(len(rest))]
            found = np.array(rows, np.int64).reshape(-1, len(MEASURES))
            columns = [pa.array(found[:, i]) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *columns], names=[*rest, *MEASURES])
            release()

    chosen = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text).cast("string").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]] + [f"{m} long" for m in MEASURES])
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return chosen.mapInArrow(measured, schema).withColumn("failures", bits)


def accepted(failures: Column, policy: Policy, rules: Sequence[Rule] = RULES, without: int = 0) -> Column:
    """Whether a policy keeps rows with these bits, where the rules of mask `without` count for nothing."""
    rejects, doubts = (F.lit(bit(rules, names) & ~without).cast("long") for names in (policy.rejects, policy.doubts))
    return (failures.bitwiseAND(rejects) == 0) & (F.bit_count(failures.bitwiseAND(doubts)) <= policy.allowed)


def with_verdicts(ledger: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with a boolean column `name_vN` per policy; the texts are not needed again."""
    return ledger.withColumns({p.label: accepted(F.col("failures"), p, rules) for p in policies})


def rule_ablations(ledger: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] = RULES, by: Sequence[str] = ()) -> DataFrame:
    """What each rule does within each policy, by the columns `by`.

    policy, version, rule, n_rows, n_kept, n_failing (rows that fail the rule), n_kept_without
    (kept if the rule were left out), n_only (rejected for this rule alone) and n_kept_alone
    (kept if it were the only rule).  Rows are first counted by their bits, so that what is
    compared with the policies is one row per combination of bits.  An empty ledger has no rows.
    """
    patterns = ledger.groupBy(*by, "failures").agg(F.count(F.lit(1)).alias("__n"))
    cells = []
    for p in policies:
        for r in [r for r in rules if r.name in p.rejects + p.doubts]:
            own = bit(rules, [r.name])
            kept, without = accepted(F.col("failures"), p, rules), accepted(F.col("failures"), p, rules, own)
            alone = Policy(p.name, p.version, tuple({r.name} & set(p.rejects)), tuple({r.name} & set(p.doubts)), p.allowed)
            flags = [kept, F.col("failures").bitwiseAND(F.lit(own).cast("long")) != 0, without, without & ~kept, accepted(F.col("failures"), alone, rules)]
            cells.append(F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r.name).alias("rule"), F.array(*flags).alias("flags")))
    names = ["n_kept", "n_failing", "n_kept_without", "n_only", "n_kept_alone"]
    sums = [F.sum(F.when(F.get("__c.flags", F.lit(i)), F.col("__n")).otherwise(0)).alias(n) for i, n in enumerate(names)]
    spread = patterns.withColumn("__c", F.explode(F.array(*cells)))
    grouped = spread.groupBy(*by, F.col("__c.policy").alias("policy"), F.col("__c.version").alias("version"), F.col("__c.rule").alias("rule"))
    return grouped.agg(F.sum("__n").alias("n_rows"), *sums)
