"""Models on data with a known answer, registry, streams against batch, sources."""

import random
from datetime import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from checks.q_models import SENSORS, train_tree
from fieldmark.models import registry, score, train
from fieldmark.operators.metrics import binary_metrics
from fieldmark.plans import crosssell, energy, flights, maintenance, matching, retail, rul
from fieldmark.session import work_folder
from fieldmark.sources import tables
from fieldmark.sources.versions import read_table
from fieldmark.streaming import arrivals
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def points(spark):
    draw = random.Random(3)
    rows = []
    for i in range(600):
        a, b = draw.random(), draw.random()
        rows.append((i, a, b, 3 * a - 2 * b + 1, int(a > b), int(a * 3), float(draw.randrange(3))))
    return spark.createDataFrame(rows, "id INT, a DOUBLE, b DOUBLE, y DOUBLE, two INT, three INT, fold DOUBLE").cache()


def test_linear_finds_the_plane(points):
    model = train.train_linear(points, ["a", "b"], "y")
    assert list(model.stages[-1].coefficients) == pytest.approx([3, -2], abs=1e-3)


@pytest.mark.parametrize("fit", [train.train_logistic, train.train_boosted, train.train_forest, train.train_tree])
def test_two_classes(points, fit):
    extra = {"trees": 5} if fit is train.train_boosted else {}
    model = fit(points, ["a", "b"], "two", **extra)
    assert binary_metrics(model.transform(points), "two", "prediction").first()["accuracy"] > 0.85


def test_three_classes(points):
    for model in (
        train.train_multinomial(points, ["a", "b"], "three"),
        train.train_boosted(points, ["a", "b"], "three", "multinomial", trees=3),
        train.train_mlp(points, ["a", "b"], "three", 3),
    ):
        out = score.score_classes(model, points, ["id", "three"], [0, 1, 2])
        assert out.filter("predicted = three").count() > 500


def test_tree_query_sweeps_all_depths(spark):
    """The sweep of the source goes to depth 16, where a tree tells rows apart that one of depth 8 does not."""
    draw = random.Random(3)
    rows = [(1 + i % 4, float(i // 4), *[draw.random() for _ in SENSORS]) for i in range(1200)]
    cycles = spark.createDataFrame(rows, f"id INT, cycle DOUBLE, {', '.join(f'{s} DOUBLE' for s in SENSORS)}").withColumn("pos", F.col("cycle"))
    got = {r[-1]: r for r in train_tree(SimpleNamespace(cycles=cycles)).collect()}
    assert set(got) == {f"depth {d}" for d in (1, 2, 4, 8, 16)}
    assert got["depth 16"].rmse < got["depth 8"].rmse


def test_weighted_patterns_give_the_same_model(spark):
    draw = random.Random(5)
    rows = [(i, draw.randrange(2), draw.randrange(2), draw.randrange(2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id INT, p INT, q INT, r INT")
    merged = train.one_model_per_target(df, ["p", "q", "r"])
    for target, model in merged.items():
        plain = train.train_logistic(df, [f for f in ("p", "q", "r") if f != target], target)
        assert list(model.stages[-1].coefficients) == pytest.approx(list(plain.stages[-1].coefficients), abs=1e-4)
    lists = crosssell.ranked_list(score.predictions_by_target(merged, df, ["id"]), "id", ["p", "q", "r"])
    assert lists.count() == 400
    assert lists.filter("array_size(array_distinct(array(Product1, Product2, Product3))) < 3").count() == 0


def test_sweep_measures_every_setting(points):
    settings = [{"rate": 0.2, "min_rows": 1, "trees": 3}, {"rate": 0.1, "min_rows": 5, "trees": 2}, {"rate": 0.3, "min_rows": 2, "trees": 4}]
    table, models = train.random_sweep(points, "fold", ["a", "b"], "y", settings)
    assert rows_of(table, "setting", "rate") == [("0", 0.2), ("1", 0.1), ("2", 0.3)]
    assert len(models) == 3


def test_threshold(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (0.6,)], "s DOUBLE")
    assert score.score_threshold(df, "s", 0.5).count() == 2
    assert [r["s_label"] for r in score.score_threshold(df, "s", 0.5, keep=False).collect()] == [0, 0, 1]


def test_score_stats_can_run_twice(spark, points):
    base = work_folder(spark, "t")
    scored = points.select("id", F.col("a").alias("s"))
    for _ in range(2):
        ticks = iter((1.0, 3.0))
        stats = score.score_stats(scored, f"{base}/out", f"{base}/stats", "g", F.col("s") > 0.5, lambda: next(ticks))
    hits = scored.filter("s > 0.5").count()
    assert spark.read.parquet(f"{base}/out").count() == hits
    assert rows_of(stats, "rows", "matches", "duration", "rate") == [(600, hits, 2.0, 300.0)] * 2


def test_registry_keeps_and_finds_versions(spark, points):
    folder = work_folder(spark, "t")
    first = train.train_linear(points, ["a"], "y")
    second = train.train_linear(points, ["a", "b"], "y")
    registry.save_model(first, spark, folder, "m", 1, dt(2024, 1, 1))
    registry.save_model(second, spark, folder, "m", 2, dt(2024, 2, 1))
    assert registry.load_model(spark, folder, "m").stages[-1].numFeatures == 2
    assert registry.load_model(spark, folder, "m", dt(2024, 1, 15)).stages[-1].numFeatures == 1
    with pytest.raises(LookupError):
        registry.load_model(spark, folder, "other")


def test_rebuild_only_on_decline(spark, points):
    folder = work_folder(spark, "t")
    details = registry.register_details(
        spark.createDataFrame([("m", "x", "t", 1.0, "o", 0.5, "Manual"), ("n", "x", "t", 4.0, "o", 0.5, "Manual")], registry.DETAILS), folder
    )
    history = registry.log_performance(
        spark.createDataFrame(
            [("m", "c1", dt(2024, 1, 1), 0.9, 1.0), ("m", "c2", dt(2024, 2, 1), 0.5, 1.0), ("n", "c1", dt(2024, 1, 1), 0.5, 1.0)],
            registry.PERFORMANCE,
        ),
        folder,
    )

    def build(_):
        return train.train_linear(points, ["a"], "y"), 0.7

    better = spark.createDataFrame([("m", 0.6), ("n", 0.5)], "id STRING, response_rate DOUBLE")
    assert registry.rebuild_on_decline(spark, folder, history, better, details, build, dt(2024, 3, 1)).count() == 0
    worse = spark.createDataFrame([("m", 0.6), ("n", 0.4)], "id STRING, response_rate DOUBLE")
    fresh = registry.rebuild_on_decline(spark, folder, history, worse, details, build, dt(2024, 3, 1))
    assert rows_of(fresh, "id", "version", "build_type") == [("n", 5.0, "Automatic")]
    registry.load_model(spark, folder, "n")


def test_run_log_keeps_the_error(spark):
    folder = work_folder(spark, "t")
    with pytest.raises(ZeroDivisionError):
        with registry.run_log(spark, folder, 1, dt(2024, 1, 1), "101", dt(2024, 1, 1)):
            1 / 0
    with registry.run_log(spark, folder, 2, dt(2024, 1, 1), "101", dt(2024, 1, 1)):
        pass
    assert rows_of(registry.runs(spark, folder), "step", "success_flag", "error") == [(1, -1, "division by zero"), (2, 0, "")]


SENSOR = "k INT, t TIMESTAMP, day STRING, v DOUBLE"


def sensor_files(spark, parts):
    """One file per part, so that each part is a batch of its own."""
    path = work_folder(spark, "t")
    for part in parts:
        spark.createDataFrame(part, SENSOR).coalesce(1).write.mode("append").parquet(path)
    return path, spark.readStream.schema(SENSOR).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_upsert_equals_batch(spark):
    parts = [
        [(1, dt(2024, 1, 1, 1), "d1", 1.0), (2, dt(2024, 1, 2, 1), "d2", 2.0)],
        [(1, dt(2024, 1, 1, 1), "d1", 5.0), (1, dt(2024, 1, 1, 1), "d1", 4.0), (3, dt(2024, 1, 3, 1), "d3", 3.0)],
    ]
    _, stream = sensor_files(spark, parts)
    base = work_folder(spark, "t")
    arrivals.stream_upsert(stream, f"{base}/table", ["k", "t"], "day", ["v"], f"{base}/state").awaitTermination()
    got = rows_of(read_table(spark, f"{base}/table"), "k", "v")
    assert [g[0] for g in got] == [1, 2, 3] and got[1:] == [(2, 2.0), (3, 3.0)] and got[0][1] == 5.0
    # The same rows again change nothing.
    again = arrivals.latest_per_key(spark.createDataFrame(parts[1], SENSOR), ["k", "t", "day"], ["v"])
    arrivals.upsert_partitions(again, f"{base}/table", ["k", "t"], "day")
    arrivals.upsert_partitions(again, f"{base}/table", ["k", "t"], "day")
    assert rows_of(read_table(spark, f"{base}/table"), "k", "v") == [(1, 5.0), (2, 2.0), (3, 3.0)]


def test_stream_tumbling_equals_batch(spark):
    parts = [[(i % 2, dt(2024, 1, 1, h, 7 * i % 60), "d", float(i)) for i in range(20)] for h in range(3)]
    path, stream = sensor_files(spark, parts)
    base = work_folder(spark, "t")
    means = arrivals.tumbling_means(stream, "t", ["k"], "v", late="10 hours")
    arrivals.store_tumbling(means, f"{base}/w", ["k"], f"{base}/state").awaitTermination()
    columns = ("k", "window_start", "mean_v", "n")
    batch = arrivals.tumbling_means(spark.read.schema(SENSOR).parquet(path), "t", ["k"], "v")
    assert rows_of(read_table(spark, f"{base}/w"), *columns) == rows_of(batch, *columns)


def test_scores_arrive_once(spark, points):
    path, base = work_folder(spark, "t"), work_folder(spark, "t")
    for part in range(2):
        points.filter(F.col("id") % 2 == part).coalesce(1).write.mode("append").parquet(path)
    model = train.train_logistic(points, ["a", "b"], "two")
    for _ in range(2):  # the second start finds nothing new
        stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(path)
        arrivals.score_on_arrival(stream, lambda: model, ["id"], f"{base}/s", f"{base}/state", F.col("id") >= 100).awaitTermination()
    got = spark.read.parquet(f"{base}/s")
    assert got.count() == 500 and got.select("id").distinct().count() == 500


def test_csv_fails_fast_and_keeps_null(spark):
    path = work_folder(spark, "t")
    spark.createDataFrame([("1,",), ("2,3.5",)], "v STRING").coalesce(1).write.text(path)
    assert rows_of(tables.csv_source(spark, path, "a INT, b DOUBLE", header=False)) == [(1, None), (2, 3.5)]
    spark.createDataFrame([("x,1.0",)], "v STRING").coalesce(1).write.mode("append").text(path)
    with pytest.raises(Exception):
        tables.csv_source(spark, path, "a INT, b DOUBLE", header=False).collect()


def test_strip_quotes(spark):
    df = spark.createDataFrame([('"a"', 1)], "s STRING, n INT")
    assert rows_of(tables.strip_quotes(df)) == [("a", 1)]


def test_load_many_needs_schemas(spark):
    with pytest.raises(KeyError):
        tables.load_many(spark, {"a": "/nowhere"}, {})


def test_forecast_times():
    start, end, first, last = energy.forecast_times(dt(2024, 2, 29, 10, 22, 5))
    assert (start, end) == (dt(2023, 2, 28, 10, 15), dt(2024, 2, 29, 10, 15))
    assert (first, last) == (dt(2024, 2, 29, 10, 30), dt(2024, 2, 29, 16, 15))


def test_rolling_retrain_can_run_twice(spark):
    draw = random.Random(1)
    times = [dt(2024, 1, d, h, m) for d in range(1, 6) for h in range(24) for m in (0, 15, 30, 45)]
    demand = spark.createDataFrame([("r", t, 100.0 + t.hour + draw.random()) for t in times], "region STRING, time TIMESTAMP_NTZ, load DOUBLE")
    heat = spark.createDataFrame([("r", dt(2024, 1, d, h), float(h)) for d in range(1, 7) for h in range(24)], "region STRING, time TIMESTAMP_NTZ, temperature DOUBLE")
    as_of = dt(2024, 1, 5, 12, 0)
    demand = demand.withColumn("region", F.lit(101))
    heat = heat.withColumn("region", F.lit(101))
    once = energy.rolling_retrain(demand, heat, None, as_of, trees=2, depth=4)
    assert once.count() == 24
    twice = energy.rolling_retrain(demand, heat, once, as_of, trees=2, depth=4)
    assert rows_of(twice) == rows_of(once)


def test_maintenance_third_rows_only(spark):
    tele = spark.createDataFrame([(1, dt(2024, 1, 1, h), float(h), 1.0, 1.0, 1.0) for h in range(9)], "machineID BIGINT, datetime TIMESTAMP_NTZ, volt DOUBLE, rotate DOUBLE, pressure DOUBLE, vibration DOUBLE")
    err = spark.createDataFrame([(dt(2024, 1, 1, 1), 1, "error2")], "datetime TIMESTAMP_NTZ, machineID BIGINT, errorID STRING")
    out = maintenance.rolling_features(tele, err)
    assert rows_of(out, "datetime", "voltmean", "voltsd", "error2count", "error1count") == [
        (dt(2024, 1, 1, 2), 1.0, 1.0, 1, 0), (dt(2024, 1, 1, 5), 4.0, 1.0, 1, 0), (dt(2024, 1, 1, 8), 7.0, 1.0, 1, 0)
    ]


def test_engine_features_use_training_bounds(spark):
    cycles = spark.createDataFrame([(i, c, c - 1, float(c * i), 7.0) for i in (1, 2) for c in range(1, 41)], "id INT, cycle INT, pos BIGINT, s1 DOUBLE, s2 DOUBLE")
    training = rul.labelled_cycles(cycles, ["s1", "s2"])
    truth = spark.createDataFrame([(1, 10), (2, 50)], "id INT, RUL INT")
    testing = rul.labelled_cycles(cycles, ["s1", "s2"], truth)
    fit, (train_set, test_set) = rul.normalised(training, testing)
    assert {"s2", "a2", "sd2"} <= set(fit.dropped) and "s1" in train_set.columns
    assert rows_of(test_set, "id", "cycle_orig", "RUL", "label1", "label2") == [(1, 40, 10, 1, 2), (2, 40, 50, 0, 0)]
    assert rul.chosen_features(train_set, "label1", 2)


def test_engine_sets_are_rolled_once(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(i, c, c - 1, draw.random(), draw.random()) for i in (1, 2, 3) for c in range(1, 13)]
    cycles = spark.createDataFrame(rows, "id INT, cycle INT, pos BIGINT, s1 DOUBLE, s2 DOUBLE")
    truth = spark.createDataFrame([(1, 10), (2, 50)], "id INT, RUL INT")
    whole, last = rul.labelled_cycles(cycles, ["s1", "s2"]), rul.labelled_cycles(cycles, ["s1", "s2"], truth)
    calls, roll = [], rul.rolling_partial
    monkeypatch.setattr(rul, "rolling_partial", lambda *a: [calls.append(a), roll(*a)][1])
    both = rul.labelled_sets(cycles, ["s1", "s2"], truth)
    assert len(calls) == 1
    assert [df.columns for df in both] == [whole.columns, last.columns]
    assert [rows_of(df) for df in both] == [rows_of(whole), rows_of(last)]


def test_retail_rules_and_horizons(spark):
    from datetime import timedelta

    rows = [("a", dt(2020, 1, 6) + timedelta(weeks=w), 30.0 + w % 5) for w in range(120)]
    rows += [("b", dt(2020, 1, 6) + timedelta(weeks=w), 10.0) for w in range(120)]
    df = spark.createDataFrame(rows, "k STRING, time TIMESTAMP_NTZ, value DOUBLE")
    grid = retail.usable_series(df, ["k"], "time", "value", 4)
    assert rows_of(grid.groupBy("k").count()) == [("a", 120)]
    out = retail.horizon_training_rows(retail.weekly_features(grid, "time", "value"), ["k"], "value", 4)
    assert rows_of(out.groupBy("horizon").count()) == [(h, 116 - 26 - (h - 1)) for h in range(1, 5)]


def test_matching_scores_every_person(spark):
    draw = random.Random(2)
    people = spark.createDataFrame([(i, [draw.random() for _ in range(3)]) for i in range(60)], "PersonId INT, rt ARRAY<DOUBLE>")
    project = spark.createDataFrame([(7, [1.0, 0.0, 0.0])], "ProjectId INT, pt ARRAY<DOUBLE>")
    labelled = people.withColumns({"pt": F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)), "label": (F.element_at("rt", 1) > 0.5).cast("int")})
    for products in (False, True):
        model = matching.train_matcher(labelled, trees=3, depth=2, products=products)
        assert matching.match_project(model, people, project, 0.0, products).count() == 60


def test_products_are_made_in_passes_not_kept(spark, monkeypatch):
    """The trees are those of Spark ML on the long vectors, which are never kept."""
    draw = random.Random(12)
    rows = []
    for i in range(300):
        rt, pt = [[round(draw.uniform(-1, 1), 2) for _ in range(3)] for _ in "rp"]
        rows.append((i, rt, pt, int(rt[0] * pt[1] + 0.3 * rt[2] > draw.uniform(-0.2, 0.2))))
    pairs = spark.createDataFrame(rows, "PersonId INT, rt ARRAY<DOUBLE>, pt ARRAY<DOUBLE>, label INT")
    vectors = matching.pair_vectors(pairs, True).withColumn("label", F.col("label").cast("double"))
    plain = GBTClassifier(maxIter=4, maxDepth=3, stepSize=0.2, minInstancesPerNode=10, seed=train.SEED).fit(vectors)
    monkeypatch.setattr(matching, "fit_kept", lambda *_: pytest.fail("vectors are kept"))
    monkeypatch.setattr(matching, "pair_vectors", lambda *_: pytest.fail("vectors are made"))
    model = matching.train_matcher(pairs, trees=4, depth=3, products=True)
    got = {r.PersonId: r.s for r in score.score_model(model, vectors, ["PersonId"], "s").collect()}
    for r in plain.transform(vectors).select("PersonId", "probability").collect():
        assert got[r.PersonId] == pytest.approx(r.probability[1])
    with pytest.raises(ValueError):
        matching.train_matcher(pairs.withColumn("label", F.lit(2)), products=True)


def test_delay_model(spark):
    df = spark.createDataFrame([(float(i % 7 + (o == "a") * 5), float(i % 24), i % 7 + 1, o) for i in range(100) for o in "ab"], "ArrDelay DOUBLE, CRSDepTime DOUBLE, DayOfWeek INT, Origin STRING")
    model = flights.delay_model(df)
    assert model.stages[-1].summary.r2 > 0.9
