"""Line dedup against a plain version."""

import random

from fieldmark.llm.lines import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def plain(rows, min_docs=2):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    holders = {}
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [
            i is not None and len(key(x)) >= 10 and len(holders[key(x)]) >= min_docs and i > min(holders[key(x)]) for x in lines
        ]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def rows_for_test():
    rng = random.Random(3)
    lines = ["a line of some words", " A LINE of some words\t", "ÉCOLE des lignes", "école des lignes", "short", "", "  ", "only here", "0123456789", "012345678"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for i in range(40)]
    rows += [(3, "a line of some words"), (3, "a line of some words\nx"), (7, None), (8, ""), (None, "a line of some words"), (None, None)]
    return rows + rows[:5] + [(99, "\n".join(f"line number {k} of many" for k in range(3000))), (100, "\n".join(f"LINE number {k} of many" for k in range(0, 3000, 2)))]


def test_against_plain(frame):
    rows = rows_for_test()
    df = frame(rows, "doc_id int, text string").selectExpr("*", "1 AS line", "2 AS pos", "3 AS __other")
    for min_docs in (2, 4):
        got = line_dedup(df, min_docs=min_docs)
        assert {"line", "pos", "__other"} <= set(got.columns)
        found = sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)
        assert found == plain(rows, min_docs)


def test_empty_table(frame):
    assert line_dedup(frame([], "doc_id long, text string")).count() == 0
