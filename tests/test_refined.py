"""Grouped fits, hash cuts, quantiles by brackets, partial autocorrelation, scoring by pattern."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldmark.models import score, train
from fieldmark.models.normal import apply_fits, linear_fits
from fieldmark.operators import metrics, splits
from fieldmark.plans import crosssell
from tests.conftest import rows_of


def test_fits_of_all_groups(frame):
    draw = np.random.default_rng(1)
    rows = [(g, float(a), float(b), float(1e9 + g + 2 * a - 3 * b)) for g in range(5) for a, b in draw.normal(size=(40, 2))]
    rows += [(8, 1.0, 2.0, 3.0), (9, 1.0, 1.0, 5.0), (9, 2.0, 2.0, 7.0), (7, None, 1.0, 1.0), (0, 1.0, None, 99.0)]
    df = frame(rows, "g INT, a DOUBLE, b DOUBLE, y DOUBLE")
    fits = linear_fits(df, ["g"], ["a", "b"], "y")
    found = {r.g: r for r in fits.collect()}
    assert set(found) == {0, 1, 2, 3, 4, 8, 9} and found[0].n == 40
    for g in range(5):
        assert found[g].coefficients == pytest.approx([2, -3], abs=1e-5) and found[g].intercept == pytest.approx(1e9 + g, rel=1e-12)
    assert found[8].intercept == 3.0 and found[8].coefficients == [0.0, 0.0] and found[8].r2 is None
    assert found[9].coefficients == pytest.approx([1.0, 1.0])  # the shortest of many
    scored = {(r.g, r.a, r.b): r.score for r in apply_fits(df, fits, ["g"], ["a", "b"]).collect()}
    assert len(scored) == len(rows) and scored[7, None, 1.0] is None and scored[0, 1.0, None] is None
    assert scored[9, 2.0, 2.0] == pytest.approx(7.0)
    whole = linear_fits(df.filter("g < 1"), [], ["a", "b"], "y")
    assert apply_fits(df.filter("g < 1"), whole, [], ["a", "b"]).filter("abs(score - y) > 1e-3").count() == 0
    assert linear_fits(df.limit(0), ["g"], ["a"], "y").count() == 0


def test_sample_is_the_first_by_hash(frame):
    rows = [(i,) for i in range(500)] + [(7,), (None,)]
    df = frame(rows, "k INT").repartition(6)
    order = sorted(rows, key=lambda r: "" if r[0] is None else hashlib.md5(str(r[0]).encode()).hexdigest())
    for n, m in ((40, 20), (0, 5), (5, 0), (1, 1), (400, 200), (502, 1), (600, 5)):
        learn, test = splits.sample_n(df, "k", n, m)
        assert rows_of(learn) == sorted(order[:n], key=str) or sorted(map(str, rows_of(learn))) == sorted(map(str, order[:n]))
        assert sorted(map(str, rows_of(test))) == sorted(map(str, order[n : n + m]))


def test_cut_goes_into_large_cells(frame):
    df = frame([(i,) for i in range(3000)], "k INT")
    order = sorted(range(3000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    for n in (1, 17, 1500, 3000):
        cut = splits.hash_cut(df, "k", n, largest=0)
        assert len(cut[0]) == 30
        assert sorted(r[0] for r in splits.below_cut(df, "k", cut).collect()) == sorted(order[:n])
    assert splits.below_cut(df, "k", splits.hash_cut(df, "k", 9999)).count() == 3000


def test_quantiles_are_exact_on_every_path(spark, monkeypatch):
    draw = np.random.default_rng(2)
    data = [("n", float(x)) for x in draw.normal(size=4000)] + [("t", float(x // 7)) for x in range(4000)] + [("one", 5.0), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame([*data, ("n", None), ("none", None)], "k STRING, v DOUBLE").repartition(7)
    probs = {"lo": 0.0, "a": 0.1, "b": 0.25, "c": 0.5, "d": 0.999, "hi": 1.0}
    want = {k: np.quantile([v for g, v in data if g == k], list(probs.values())) for k in ("n", "t", "one", "two")}
    monkeypatch.setattr(metrics, "SKETCH", 100)  # groups of more than 500 rows are bracketed
    for most in (200_000, 3):
        got = {r["k"]: [r[n] for n in probs] for r in metrics.exact_quantiles(df, ["k"], "v", probs, most).collect()}
        assert set(got) == set(want)
        for k, values in want.items():
            assert got[k] == pytest.approx(list(values), abs=1e-12), (k, most)
    whole = metrics.exact_quantiles(df, [], "v", probs).first()
    assert list(whole) == pytest.approx(list(np.quantile([v for _, v in data], list(probs.values()))), abs=1e-12)


def test_partial_autocorrelation(spark):
    draw = np.random.default_rng(3)
    x = np.zeros(3000)
    for i in range(2, 3000):
        x[i] = 0.6 * x[i - 1] - 0.3 * x[i - 2] + draw.normal()
    rows = [("a", i, float(v)) for i, v in enumerate(x)] + [("flat", i, 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "k STRING, pos BIGINT, e DOUBLE")
    got = metrics.residual_pacf(df, ["k"], "pos", "e", 6)
    d = x - x.mean()
    r = np.array([(d[k:] * d[: len(d) - k]).sum() / (d * d).sum() for k in range(7)])
    for row in got.filter("k = 'a'").collect():
        k = row.lag
        plain = np.linalg.solve([[r[abs(i - j)] for j in range(k)] for i in range(k)], r[1 : k + 1])[-1]
        assert row.acf == pytest.approx(r[k], abs=1e-9) and row.pacf == pytest.approx(plain, abs=1e-9)
    assert [x.pacf for x in got.filter("k = 'flat'").collect()] == [None] * 6


def test_patterns_give_the_rows_their_figures(frame):
    draw = random.Random(4)
    flags = ["f1", "f2", "f3"]
    rows = [(i, *[draw.choice([0, 1, 1, None]) for _ in flags]) for i in range(300)] + [(5, 1, 1, 0), (None, 0, 0, 1)]
    df = frame(rows, "id INT, f1 INT, f2 INT, f3 INT")
    models = train.one_model_per_target(df.dropna(), flags)
    got = score.predictions_by_target(models, df, ["id"])
    assert got.count() == len(rows) and got.columns == ["id", *flags]
    for target in flags:
        others = [f for f in flags if f != target]
        plain = train.apply_model(models[target], df.select("id", *others))
        want = plain.select("id", F.round(F.element_at(F.from_json(F.to_json(F.struct("probability")), "probability STRUCT<values:ARRAY<DOUBLE>>")["probability"]["values"], 2), 9).alias("p"))
        assert sorted(map(str, rows_of(want))) == sorted(map(str, rows_of(got.select("id", F.round(target, 9).alias("p")))))
    lists = crosssell.recommendations(df, "id", flags)
    assert lists.count() == len(rows)
    assert all(sorted(r[1:]) == flags for r in lists.collect())


@pytest.mark.parametrize("rows", [10, 10_000])
def test_group_apply_calls_once_per_short_group_and_bounds_pieces(frame, rows):
    """Short groups are one call each, long ones are cut; both give the sums of whole groups."""
    df = frame([(k, i, float(i)) for k, n in ((1, 300), (2, 3), (None, 2)) for i in range(n)], "k INT, t INT, v DOUBLE")

    def partial(part):
        return pd.DataFrame({"k": part["k"].iloc[:1], "n": [len(part)], "s": [part["v"].sum()], "calls": [1], "most": [len(part)]})

    def finish(parts):
        return pd.DataFrame({"k": parts["k"].iloc[:1], "n": [parts["n"].sum()], "s": [parts["s"].sum()], "calls": [parts["calls"].sum()], "most": [parts["most"].max()]})

    schema = "k INT, n BIGINT, s DOUBLE, calls BIGINT, most BIGINT"
    out = {r.k: r for r in score.group_apply(df, ["k"], F.col("t"), partial, schema, finish, schema, rows).collect()}
    assert {k: (r.n, r.s) for k, r in out.items()} == {1: (300, 44850.0), 2: (3, 3.0), None: (2, 1.0)}
    assert out[2].calls == out[None].calls == 1
    assert (out[1].calls, out[1].most) == (1, 300) if rows > 300 else (out[1].calls > 10 and out[1].most < 40)
