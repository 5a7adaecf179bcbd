"""Rule ledger against a plain version, and bitwise verdicts against the rules themselves."""

import random
import re

import pytest

from fieldmark.llm.rules import BASE, MEASURES, PROSE, RULES, Policy, Rule, measure, quality_ledger, rule_ablations, with_verdicts


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
        len(lines),
        len(set(words)),
        len(re.findall("[A-Z]", text)),
        len(re.findall("[0-9]", text)),
        sum(x.rstrip(" \t\n\x0b\x0c\r").endswith(("...", "…")) for x in lines),
    )


def texts():
    rng = random.Random(11)
    pieces = ["word", "Wort", "é", " x", " ", "#1", "a|b", "...", "…", "\n", "\n\n", "\t", "\x0b", "\x0c", "\r", "\x1c", " ", "  ", "naïve", "𝕏y", "<p>", "A B"]
    many = ["".join(rng.choice(pieces) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 80))) for _ in range(120)]
    return many + [None, "", " \n\t", "a b c a b c", "a a a a", "a a a", "one", "x y z\nx y z\nx y z", " ".join(str(i % 7) for i in range(500))]


def test_measures_against_plain():
    for text in texts():
        assert measure((text or "").encode()) == plain(text), repr(text)


def test_windows_of_very_many_words():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(1_100_000)]
    rng.shuffle(words)
    raw = " ".join(words + words[10:14]).encode()
    found = dict(zip(MEASURES, measure(raw)))
    assert found["n_repeat_words"] == 8 and found["n_distinct_words"] == 1_100_000


def test_ledger_and_verdicts(spark, frame):
    rows = [(i, t, "kept") for i, t in enumerate(texts())] + [(None, "a b", "no id"), (3, texts()[3], "again")]
    df = frame(rows, "doc_id int, text string, n_words string").selectExpr("*", "array(doc_id) AS more")
    ledger = quality_ledger(df)
    assert ledger.columns == ["doc_id", "more", *MEASURES, "failures"]
    judged = with_verdicts(ledger, [BASE, PROSE]).collect()
    assert len(judged) == len(rows)
    by_id = {}
    for row in judged:
        by_id.setdefault(row.doc_id, []).append(row)
    assert by_id[3][0] == by_id[3][1]
    for i, text, _ in rows:
        row = by_id[i][0]
        assert tuple(row[m] for m in MEASURES) == plain(text)
        assert row.base_v1 == (row.n_words >= 50 and 2 * row.n_repeat_words <= row.n_words)
        assert not row.prose_v1 or row.base_v1
    assert quality_ledger(frame([], "doc_id long, text string")).count() == 0


def test_ablations_are_policies_without_a_rule(frame):
    rows = [(i, t) for i, t in enumerate(texts())]
    ledger = quality_ledger(frame(rows, "doc_id int, text string")).cache()
    found = {(r.policy, r.rule): r for r in rule_ablations(ledger, [BASE, PROSE]).collect()}
    assert len(found) == len(BASE.rejects) + len(PROSE.rejects) + len(PROSE.doubts)
    for policy in (BASE, PROSE):
        for rule in policy.rejects + policy.doubts:
            less = Policy("less", 1, tuple(n for n in policy.rejects if n != rule), tuple(n for n in policy.doubts if n != rule), policy.allowed)
            sides = with_verdicts(ledger, [policy, less]).selectExpr(
                f"count_if({policy.label}) AS kept", "count_if(less_v1) AS without", f"count_if(less_v1 AND NOT {policy.label}) AS only"
            ).first()
            row = found[policy.name, rule]
            assert (row.n_rows, row.n_kept, row.n_kept_without, row.n_only) == (len(rows), sides.kept, sides.without, sides.only)
    assert rule_ablations(ledger.limit(0), [BASE]).count() == 0


def test_rules_are_named_once(frame):
    df = frame([(1, "a")], "doc_id int, text string")
    with pytest.raises(ValueError):
        quality_ledger(df, rules=[Rule("a", "n_words < 1"), Rule("a", "n_words < 2")])
    with pytest.raises(KeyError):
        with_verdicts(quality_ledger(df), [Policy("x", 1, ("unknown",))], RULES)
