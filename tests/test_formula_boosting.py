"""Formulas as expressions, and several classes boosted jointly."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from fieldmark.models import score, train
from fieldmark.models.cells import cells as weighted_cells
from fieldmark.models.cells import fit_bins, in_few_tasks
from fieldmark.models.formula import Term, levels_of, terms_of
from fieldmark.session import work_folder
from tests.conftest import rows_of

SCHEMA = "id INT, f STRING, g STRING, x DOUBLE, y DOUBLE"


def test_terms(frame):
    schema = frame([], SCHEMA).schema
    assert terms_of("y ~ x + f:g", schema) == ("y", [Term(("x",), ()), Term((), ("f", "g"))], True)
    assert terms_of("y~f*x - 1", schema)[1:] == ([Term((), ("f",)), Term(("x",), ()), Term(("x",), ("f",))], False)
    for bad in ("y ~ f + z", "z ~ f", "f ~ x", "y ~ f - x"):
        with pytest.raises(ValueError):
            terms_of(bad, schema)


def test_levels_of_all_factors_in_one_pass(frame):
    df = frame([(1, "a", "u", 1.0, 1.0), (2, "b", "u", 1.0, 1.0), (3, "b", None, 1.0, 1.0), (4, "c", "v", 1.0, 1.0), (5, "a", "v", 1.0, 1.0), (6, "b", "u", 1.0, 1.0)], SCHEMA)
    _, terms, _ = terms_of("y ~ f + f:g", df.schema)
    found = list(levels_of(df, terms).values())
    assert found[0] == ["b", "a", "c"]
    assert [x.split("\u001f") for x in found[1]] == [["b", "u"], ["a", "u"], ["a", "v"], ["c", "v"]]


def cells(rows):
    sums = {}
    for _, f, g, _, y in rows:
        sums.setdefault((f, g), []).append(y)
    return {k: sum(v) / len(v) for k, v in sums.items()}


def test_each_row_gets_one_row_in_one_pass(frame):
    draw = random.Random(4)
    rows = [(i % 7, draw.choice("abc"), draw.choice("uvw"), draw.random(), draw.random()) for i in range(200)]
    df = frame(rows, SCHEMA)
    model = train.train_formula(df, "y ~ f:g", LinearRegression(fitIntercept=False))
    asked = frame([*rows, (1, "z", "u", 0.0, 0.0), (1, None, "u", 0.0, 0.0), (None, "a", "u", 0.0, 0.0)], SCHEMA)
    scored = score.score_model(model, asked, ["id", "f", "g"], "s", None)
    mean = cells(rows)
    got = [(r.f, r.g, r.s) for r in scored.collect()]
    assert len(got) == 203
    for f, g, s in got:
        assert s is None if (f, g) not in mean else s == pytest.approx(mean[f, g], abs=1e-6)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_factor_with_constant_and_slopes(frame):
    draw = random.Random(5)
    truth = {"a": (1.0, 2.0), "b": (-3.0, 0.5), "c": (0.0, -1.0)}
    rows = [(i, f, "u", x, truth[f][0] + truth[f][1] * x) for i, (f, x) in enumerate((draw.choice("abc"), draw.random() * 9) for _ in range(300))]
    df = frame(rows, SCHEMA)
    for formula in ("y ~ f*x", "y ~ f + f:x", "y ~ f*x - 1"):
        estimator = LinearRegression(solver="normal", fitIntercept="-" not in formula)
        got = score.score_model(train.train_formula(df, formula, estimator), df, ["y"], "s", None)
        assert all(r.s == pytest.approx(r.y, abs=1e-5) for r in got.collect()), formula


def test_unknown_values_do_not_train(frame):
    rows = [(1, "a", "u", 1.0, 2.0), (2, "a", "u", None, 100.0), (3, "b", "u", 1.0, 4.0), (4, "b", "u", 1.0, None), (5, "c", "u", None, 5.0)]
    df = frame(rows, SCHEMA)
    model = train.train_formula(df, "y ~ f + x:x", LinearRegression(regParam=0.0))
    got = {r.id: r.s for r in score.score_model(model, df, ["id"], "s", None).collect()}
    assert got[1] == pytest.approx(2.0) and got[3] == pytest.approx(4.0) and got[4] == pytest.approx(4.0)
    assert got[2] is None and got[5] is None
    with pytest.raises(ValueError):
        train.train_formula(df.limit(0), "y ~ f", LinearRegression())


@pytest.fixture(scope="module")
def three(spark):
    draw = random.Random(6)
    rows = [(i, a := draw.random(), b := draw.random(), 0 if a + b < 0.8 else 1 if a > b else 2) for i in range(600)]
    return spark.createDataFrame(rows, "id INT, a DOUBLE, b DOUBLE, y INT").cache()


def test_classes_are_one_model(spark, three):
    model = train.train_boosted(three, ["a", "b"], "y", "multinomial", trees=12, depth=3, rate=0.5)
    out = score.score_classes(model, three, ["id", "y"], [0, 1, 2])
    assert out.filter("predicted = y").count() > 570
    sums = out.select(F.round(sum(F.col(f"probability_{i}") for i in range(3)), 9).alias("s")).distinct()
    assert rows_of(sums) == [(1.0,)]
    path = work_folder(spark, "model")
    model.write().overwrite().save(path)
    again = score.score_classes(PipelineModel.load(path), three, ["id", "y"], [0, 1, 2])
    assert rows_of(again) == rows_of(out)
    unknown = spark.createDataFrame([(1, None, 0.5), (2, 0.1, 0.1)], "id INT, a DOUBLE, b DOUBLE")
    assert rows_of(score.score_classes(model, unknown, ["id"], [0, 1, 2]), "id", "predicted") == [(1, None), (2, 0)]


def test_class_without_rows_and_two_classes(spark):
    data = spark.createDataFrame([(float(i % 2), 3 if i % 2 else 0) for i in range(40)] + [(None, 1)], "a DOUBLE, y INT")
    model = train.train_boosted(data, ["a"], "y", "multinomial", trees=10, depth=1, rate=1.0)
    got = score.score_classes(model, data.dropna(), ["y"], [0, 1, 2, 3]).distinct()
    assert rows_of(got, "y", "predicted") == [(0, 0), (3, 3)]
    assert got.filter("probability_1 > 1e-6 OR probability_2 > 1e-6").count() == 0
    with pytest.raises(ValueError):
        train.train_boosted(data.limit(0), ["a"], "y", "multinomial")


def test_boosting_passes_over_cells(spark, monkeypatch):
    """Rows of equal bins are one weighted row: trees see no more rows than there are cells."""
    rows = [(float(i % 3), float(i % 4), float(i % 2 + i % 3)) for i in range(2400)]
    data = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, y DOUBLE").repartition(40)
    sizes = []
    monkeypatch.setattr(train, "cells", lambda *a: [c := weighted_cells(*a), sizes.append(c.count())][0])
    model = train.train_boosted(data, ["a", "b"], "y", "gaussian", trees=3, depth=5)
    assert sizes == [12] and in_few_tasks(data).rdd.getNumPartitions() == 1
    means = {}
    for a, b, y in rows:
        means.setdefault((a, b), []).append(y)
    for r in train.apply_model(model, data).select("a", "b", "prediction").distinct().collect():
        assert r.prediction == pytest.approx(sum(means[r.a, r.b]) / len(means[r.a, r.b]))
    unknown = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0)], "a DOUBLE, b DOUBLE")
    assert [r.prediction for r in train.apply_model(model, unknown).collect()] == [None, None]


def test_least_rows_of_a_node_count_the_rows_behind_cells(spark):
    data = spark.createDataFrame([(0.0, 1.0)] * 4 + [(1.0, 5.0)] * 20, "a DOUBLE, y DOUBLE")
    for least, parted in ((4, True), (5, False)):
        model = train.train_boosted(data, ["a"], "y", "gaussian", trees=1, depth=1, minInstancesPerNode=least)
        assert train.apply_model(model, data).select("prediction").distinct().count() == 1 + parted


def test_cuts_of_many_values_are_quantiles_of_all_rows(spark):
    binner = fit_bins(spark.range(0, 3200).select(F.col("id").cast("double").alias("a"), (F.col("id") % 5).alias("b")), ["a", "b"])
    a, b = binner.getSplitsArray()
    assert len(a) == 33 and b[1:-1] == pytest.approx([0.5, 1.5, 2.5, 3.5])
    binned = binner.transform(spark.range(0, 3200).select(F.col("id").cast("double").alias("a"), F.lit(1).alias("b")))
    counts = [r[0] for r in binned.groupBy("_bin_a").count().select("count").collect()]
    assert len(counts) == 32 and max(counts) <= 104


def test_rounds_are_grown_together(spark):
    """A round is one job a level for all its classes, and many rounds leave no query behind."""
    draw = random.Random(8)
    rows = [(a := draw.random(), b := draw.random(), int(a * 2 + b * 2)) for _ in range(400)]
    data = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, y INT").coalesce(1).cache()
    data.count()
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    jobs = {}
    for trees in (2, 12):
        context.setJobGroup(f"rounds {trees}", "boosting")
        train.train_boosted(data, ["a", "b"], "y", "multinomial", trees=trees, depth=3)
        jobs[trees] = len(tracker.getJobIdsForGroup(f"rounds {trees}"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[12] - jobs[2] == 10 * 3


def test_trees_are_those_of_plain_boosting(spark):
    """Against boosting in plain Python over the same cuts, with rows on both sides of them and weights."""
    draw = random.Random(9)
    rows = [(float(draw.randrange(6)), float(draw.randrange(5)), draw.random() * 3) for _ in range(300)]
    data = spark.createDataFrame([(a, b, y + a * b) for a, b, y in rows], "a DOUBLE, b DOUBLE, y DOUBLE")
    model = train.train_boosted(data, ["a", "b"], "y", "gaussian", trees=4, depth=2, rate=0.3)
    known = [(a, b, y + a * b) for a, b, y in rows]

    def mean(part):
        return sum(z for _, z in part) / len(part)

    def grow(part, depth):
        best = None
        for f in (0, 1):
            for cut in range(6):
                left, right = [r for r in part if r[0][f] <= cut], [r for r in part if r[0][f] > cut]
                if left and right:
                    gain = len(left) * len(right) / len(part) ** 2 * (mean(left) - mean(right)) ** 2
                    if best is None or gain > best[0] * (1 + 1e-9):
                        best = (gain, f, cut, left, right)
        if not depth or best is None:
            return lambda x, m=mean(part): m
        _, f, cut, left, right = best
        below, above = grow(left, depth - 1), grow(right, depth - 1)
        return lambda x: below(x) if x[f] <= cut else above(x)

    margins = [0.0] * len(known)
    for round_ in range(4):
        part = [((a, b), 2 * (y - m) if round_ else y) for (a, b, y), m in zip(known, margins)]
        tree = grow(part, 2)
        margins = [m + (0.3 if round_ else 1.0) * tree((a, b)) for (a, b, _), m in zip(known, margins)]
    expected = {(a, b): m for (a, b, _), m in zip(known, margins)}
    for r in train.apply_model(model, data).select("a", "b", "prediction").distinct().collect():
        assert r.prediction == pytest.approx(expected[r.a, r.b])


def test_filter_on_the_prediction_names_each_tree_once(spark, three):
    """Spark moves the filter before the model with all the prediction is made of."""
    model = train.train_boosted(three, ["a", "b"], "y", "multinomial", trees=2, depth=1)
    plan = train.apply_model(model, three).filter("prediction IS NOT NULL").select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(") < 40


def test_kept_rows_are_not_kept_twice(spark, monkeypatch):
    """Rows the caller keeps are read from there, by forests and by boosted trees."""
    data = spark.createDataFrame([(float(i % 7), float(i % 5)) for i in range(200)], "a DOUBLE, y DOUBLE").persist()
    data.count()
    kept, persist = [], type(data).persist
    monkeypatch.setattr(type(data), "persist", lambda self, *a: [kept.append(self.columns), persist(self, *a)][1])
    train.train_forest(data, ["a"], "y", False, trees=2, depth=2)
    train.train_boosted(data, ["a"], "y", "gaussian", trees=2, depth=2)
    assert kept == []
    data.unpersist()
