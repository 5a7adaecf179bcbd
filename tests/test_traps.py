"""Small hand-made rows for the places where the meaning is easy to miss."""

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmark.functions import calendar as cal
from fieldmark.functions import numbers as num
from fieldmark.operators import aggregates, forecast, joins, metrics, reshape, rows, splits, windows
from fieldmark.plans import churn
from tests.conftest import rows_of

ACTIVITY = "UserId STRING, TransactionId BIGINT, TransactionTime TIMESTAMP_NTZ, ItemId BIGINT, Quantity DOUBLE, Val DOUBLE, Location STRING, ProductCategory STRING"


def activity(user, number, day, item=1, quantity=1.0):
    return (user, number, dt(2024, 1, day, 12), item, quantity, 10.0, "x", "y")


def test_whole_mean_recency_and_single_row_deviation(frame):
    df = frame(
        [activity("a", 1, 1), activity("a", 2, 1), activity("a", 3, 6), activity("a", 9, 31), activity("b", 4, 2)], ACTIVITY
    )
    got = {r["UserId"]: r for r in aggregates.customer_features(df, 10).collect()}
    # Gaps 0, 0, 5: the mean 1.67 is cut to 1.
    assert got["a"]["AvgTimeDelta"] == 1
    assert got["a"]["UniqueTransactionId"] == 3
    assert got["a"]["Recency"] == 25 - 10
    assert got["b"]["StDevQuantity"] == 0.0 and got["b"]["AvgTimeDelta"] == 0


def test_tags(frame):
    df = frame([activity("a", 1, 1), activity("a", 2, 30), activity("b", 3, 1), activity("c", 4, 31)], ACTIVITY)
    assert rows_of(churn.churn_tags(df, 10)) == [("a", "Nonchurner", "0"), ("b", "Churner", "1")]


def test_lag_interval_equal_times(frame):
    df = frame([activity("a", 2, 1), activity("a", 1, 1), activity("a", 3, 4), activity("b", 5, 9)], ACTIVITY)
    out = windows.lag_interval(df, "UserId", "TransactionTime", "TransactionId")
    assert rows_of(out, "TransactionId", "interval") == [(1, 0), (2, 0), (3, 3), (5, 0)]


TELEMETRY = "m BIGINT, t TIMESTAMP_NTZ"


def test_event_at_row_time_is_not_earlier(frame):
    data = frame([(1, dt(2024, 1, 2, 6)), (1, dt(2024, 1, 2, 7)), (1, dt(2024, 1, 4, 0)), (2, dt(2024, 1, 2, 6))], TELEMETRY)
    events = frame([(1, dt(2024, 1, 2, 6), "comp1"), (1, dt(2024, 1, 1, 23), "comp2")], "m BIGINT, at TIMESTAMP_NTZ, comp STRING")
    out = joins.days_since_last(data, events, "m", "t", "at", "comp", ["comp1", "comp2"])
    assert rows_of(out.filter("m = 1"), "sincelastcomp1", "sincelastcomp2") == [(None, 1), (0, 1), (2, 3)]
    assert rows_of(out.filter("m = 2"), "sincelastcomp1", "sincelastcomp2") == [(None, None)]


def test_chained_ages_need_the_first_component(frame):
    kinds = ["comp1", "comp2", "comp3", "comp4"]
    data = frame([(1, dt(2024, 1, 5))], TELEMETRY)
    events = frame([(1, dt(2024, 1, 1), "comp2"), (1, dt(2024, 1, 1), "comp4")], "m BIGINT, at TIMESTAMP_NTZ, comp STRING")
    free = joins.days_since_last(data, events, "m", "t", "at", "comp", kinds)
    assert rows_of(free, *[f"sincelast{k}" for k in kinds]) == [(None, 4, None, 4)]
    chained = joins.days_since_last(data, events, "m", "t", "at", "comp", kinds, chained=True)
    assert rows_of(chained, *[f"sincelast{k}" for k in kinds]) == [(None, None, None, None)]


def test_horizon_counts_hour_marks_and_multiplies(frame):
    data = frame([(1, dt(2024, 1, 1, 10, 30)), (1, dt(2024, 1, 5))], TELEMETRY)
    failures = frame(
        [(1, dt(2024, 1, 1, 10, 5), "a"), (1, dt(2024, 1, 2, 10, 59), "b"), (1, dt(2024, 1, 2, 11, 0), "c")],
        "m BIGINT, f TIMESTAMP_NTZ, failure STRING",
    )
    out = joins.horizon_label(data, failures, "m", "t", "f", "failure")
    assert rows_of(out, "failure") == [("a",), ("b",), ("none",)]
    near = joins.horizon_label(data, failures, "m", "t", "f", "failure", nearest=True)
    assert rows_of(near, "failure") == [("a",), ("none",)]


def test_upsert_replaces_adds_and_repeats(frame):
    target = frame([(1, "old", 1.0), (2, "old", 2.0)], "k INT, s STRING, v DOUBLE")
    source = frame([(2, None), (3, 9.0)], "k INT, v DOUBLE")
    once = joins.merge_upsert(target, source, ["k"])
    assert rows_of(once) == [(1, "old", 1.0), (2, "old", None), (3, None, 9.0)]
    assert rows_of(joins.merge_upsert(once, source, ["k"])) == rows_of(once)


def test_upsert_refuses_a_double_key(frame):
    target = frame([(1, 1.0)], "k INT, v DOUBLE")
    source = frame([(2, 1.0), (2, 2.0)], "k INT, v DOUBLE")
    with pytest.raises(Exception, match="two source rows"):
        joins.merge_upsert(target, source, ["k"]).collect()


def test_second_project_row_is_an_error(frame):
    people = frame([(1,)], "p INT")
    projects = frame([(1,), (2,)], "q INT")
    with pytest.raises(Exception):
        joins.cross_join_score_input(people, projects, {"q": "q"}).collect()


def test_grid_has_every_step(frame):
    data = frame([("a", dt(2024, 1, 1), 1.0), ("a", dt(2024, 1, 29), 2.0), ("b", dt(2024, 1, 8), 3.0)], "k STRING, t TIMESTAMP_NTZ, v DOUBLE")
    out = joins.series_spine(data, ["k"], "t", 7, "pos")
    assert out.count() == 2 * 5
    assert rows_of(out.filter("k = 'a' and v is not null"), "pos", "v") == [(0, 1.0), (4, 2.0)]


def test_fill_from_lag_does_and_does_not_recurse(frame):
    values = [1.0, None, None, None, 5.0, None]
    df = frame([("a", i, v) for i, v in enumerate(values)], "k STRING, pos BIGINT, v DOUBLE")
    plain = windows.fill_from_lag(df, ["k"], "pos", ["v"], 2)
    assert [r[1] for r in rows_of(plain, "pos", "v")] == [1.0, 3.0, 1.0, 3.0, 5.0, 3.0]
    deep = windows.fill_from_lag_recursive(df, ["k"], "pos", ["v"], 2, rows=1)
    assert [r[1] for r in rows_of(deep, "pos", "v")] == [1.0, None, 1.0, None, 5.0, None]


def test_rul_labels_with_truth(frame):
    df = frame([(1, c) for c in range(1, 41)], "id INT, cycle INT")
    out = {r["cycle"]: r for r in windows.rul_label(df, "id", "cycle").collect()}
    assert (out[40]["RUL"], out[40]["label1"], out[40]["label2"]) == (0, 1, 2)
    assert (out[10]["RUL"], out[10]["label1"], out[10]["label2"]) == (30, 1, 1)
    assert (out[9]["RUL"], out[9]["label1"], out[9]["label2"]) == (31, 0, 0)
    truth = frame([(1, 100)], "id INT, RUL INT")
    assert windows.rul_label(df, "id", "cycle", truth).agg(F.min("RUL")).first()[0] == 100


def test_rolling_partial_single_row(frame):
    df = frame([(1, 0, 4.0), (1, 1, 8.0)], "id INT, pos BIGINT, s1 DOUBLE")
    out = windows.rolling_partial(df, ["id"], "pos", ["s1"])
    assert rows_of(out, "a1", F.round("sd1", 6)) == [(4.0, 0.0), (6.0, 2.828427)]


def test_minmax_uses_training_bounds_and_drops_constant_and_unknown(frame):
    schema = "id INT, a DOUBLE, b DOUBLE, c DOUBLE"
    train = frame([(1, 0.0, 5.0, None), (2, 10.0, 5.0, 1.0)], schema)
    test = frame([(3, 20.0, 6.0, 1.0)], schema)
    fit = rows.minmax_fit(train, ["a", "b", "c"])
    assert fit.dropped == ("b", "c")
    assert rows_of(rows.minmax_apply(test, fit, {"a": "a_orig"})) == [(3, 2.0, 20.0)]


def test_series_rules(frame):
    data = [("few", 30.0)] + [("low", v) for v in (20.0, 30.0)] + [("good", v) for v in (21.0, None, 30.0)]
    df = frame(data, "k STRING, v DOUBLE")
    assert rows_of(forecast.series_rules(df, ["k"], "v", 2, 20)) == [("few", 1), ("good", 0), ("low", 2)]


def test_series_rules_split(frame):
    def series(k, values):
        return [(k, i, len(values), v) for i, v in enumerate(values)]

    data = series("tail", [1.0] * 3 + [None] * 6 + [1.0] * 4)
    data += series("test", [1.0] * 9 + [None] * 3 + [1.0])
    data += series("good", [1.0] * 4 + [None] * 5 + [None] * 2 + [1.0] * 2)
    df = frame(data, "k STRING, pos BIGINT, size BIGINT, v DOUBLE")
    out = forecast.series_rules_split(df, ["k"], "pos", "size", "v", 4)
    assert rows_of(out) == [("good", 0), ("tail", 3), ("test", 4)]


def test_smoothing_is_the_recursion(frame):
    values = [3.0, 5.0, 4.0, 8.0, 6.0]
    level = values[0]
    for v in values[1:]:
        level = 0.2 * v + 0.8 * level
    train = frame([("a", i, v) for i, v in enumerate(values)], "k STRING, pos BIGINT, v DOUBLE")
    test = frame([("a", 5)], "k STRING, pos BIGINT")
    # A season longer than the series leaves only the level.
    out = forecast.decompose_smooth(train, test, ["k"], "pos", "v", season=52)
    assert out.first()["forecast"] == pytest.approx(level)


def test_seasonal_naive_repeats_the_last_season(frame):
    train = frame([("a", i, float(i)) for i in range(6)], "k STRING, pos BIGINT, v DOUBLE")
    test = frame([("a", i) for i in range(6, 12)], "k STRING, pos BIGINT")
    out = forecast.seasonal_naive(train, test, ["k"], "pos", "v", season=4)
    assert [r[1] for r in rows_of(out, "pos", "forecast")] == [2.0, 3.0, 4.0, 5.0, 2.0, 3.0]


def test_horizon_lags_of_a_short_series(frame):
    df = frame([("a", i, float(i)) for i in range(5)], "k STRING, pos BIGINT, v DOUBLE")
    out = windows.lag_by_horizon(df, ["k"], "pos", "v", lags=2, horizon=2)
    assert rows_of(out, "horizon", "pos", "lag1", "lag2") == [
        (1, 2, 1.0, 0.0), (1, 3, 2.0, 1.0), (1, 4, 3.0, 2.0), (2, 3, 1.0, 0.0), (2, 4, 2.0, 1.0)
    ]


def test_binary_metrics_by_positive_class(frame):
    df = frame([(1, 1), (1, 0), (0, 0), (0, 0)], "o INT, p INT")
    one = metrics.binary_metrics(df, "o", "p", 1).first()
    assert (one["accuracy"], one["precision"], one["recall"]) == (0.75, 1.0, 0.5)
    zero = metrics.binary_metrics(df, "o", "p", 0).first()
    assert (zero["accuracy"], zero["precision"], zero["recall"]) == (0.75, pytest.approx(2 / 3), 1.0)


def test_macro_figures_need_every_class(frame):
    df = frame([(0, 0), (1, 0)], "o INT, p INT")
    row = metrics.multiclass_metrics(df, "o", "p", [0, 1]).first()
    assert row["macro_precision"] is None and row["macro_recall"] == 0.5


def test_zero_denominators(frame):
    df = frame([(0.0, 1.0), (2.0, 1.0)], "y DOUBLE, f DOUBLE")
    assert metrics.mape(df, "y", "f").first()["mape"] == 0.5
    assert df.select(num.safe_divide(F.lit(1), F.lit(0))).first()[0] is None


def test_auc_with_equal_scores(frame):
    df = frame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "y INT, s DOUBLE")
    assert metrics.auc(df, "y", "s").first()["auc"] == pytest.approx(3.5 / 4)


def test_equal_scores_rank_by_name(frame):
    df = frame([(1, "b", 0.5), (1, "a", 0.5), (1, "c", 0.9)], "c INT, p STRING, s DOUBLE")
    ranked = windows.rank_products(df, "c", "p", "s")
    assert rows_of(ranked, "rank", "p") == [(1, "c"), (2, "a"), (3, "b")]
    assert rows_of(reshape.pivot_ranked(ranked, "c", "rank", "p", 3)) == [(1, "c", "a", "b")]


def test_unknown_delay_is_not_late(frame):
    df = frame([(None,), (15.0,), (16.0,)], "d DOUBLE")
    assert [r[0] for r in df.select(num.threshold_flag(F.col("d"), 15)).collect()] == [0, 0, 1]
    cut = frame([(-1.7,), (1.7,)], "x DOUBLE").select(num.truncate_number(F.col("x")))
    assert [r[0] for r in cut.collect()] == [-1, 1]


@pytest.mark.parametrize(
    ("day", "flag"),
    [("2012-11-26", "us_thanksgiving"), ("2012-11-26", "cyber_monday"), ("2012-09-03", "us_labor_day"),
     ("2012-12-31", "christmas"), ("2012-01-02", "us_new_year")],
)
def test_holidays_on_monday_weeks(frame, day, flag):
    df = frame([(day,)], "d STRING").select(F.col("d").cast("timestamp_ntz").alias("t"))
    row = df.select(*[c.alias(n) for n, c in cal.holiday_columns(F.col("t")).items()]).first()
    assert row[flag] == 1


def test_hour_marks(frame):
    df = frame([(dt(2024, 1, 1, 0, 59), dt(2024, 1, 1, 1, 1))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert df.select(cal.hour_boundaries(F.col("a"), F.col("b"))).first()[0] == 1


def test_leap_day_has_no_place_in_the_next_year(frame):
    df = frame([(dt(2024, 2, 29, 1),), (dt(2024, 3, 1, 1),)], "t TIMESTAMP_NTZ")
    out = rows.redate_rows(df, "t", "2023-06-01 00:00:00", "2024-12-31 00:00:00")
    assert rows_of(out) == [(None,), (dt(2023, 3, 1, 1),)]


def test_splits_are_disjoint_and_complete(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    for train, test in (
        splits.repeatable_split(df, "id", 70),
        splits.stratified_split(df, "id", "label", 0.75),
    ):
        assert train.join(test, "id").count() == 0
        assert train.unionByName(test).distinct().count() == 1000
    train, _ = splits.stratified_split(df, "id", "label", 0.75)
    assert rows_of(train.groupBy("label").count()) == [(0, 675), (1, 75)]


def test_exact_folds(spark):
    out = splits.disjoint_folds(spark.range(103), "id", 5, exact=True)
    assert rows_of(out.groupBy("fold").count()) == [(None, 3), (0, 20), (1, 20), (2, 20), (3, 20), (4, 20)]
    assert splits.disjoint_folds(spark.range(3), "id", 5, exact=True).filter("fold is not null").count() == 0


def test_best_offset(frame):
    index = [float((i * 7) % 11) for i in range(40)]
    series = frame([("a", i, index[i + 3]) for i in range(30)], "k STRING, pos BIGINT, v DOUBLE")
    idx = frame([(i, v) for i, v in enumerate(index)], "ipos BIGINT, iv DOUBLE")
    row = windows.best_index_lag(series, idx, ["k"], "pos", "v", "ipos", "iv", 6).first()
    assert row["offset"] == 3 and row["correlation"] == pytest.approx(1.0)


def test_samples_are_the_first_by_hash(spark):
    df = spark.range(500)
    train, test = (rows_of(part) for part in splits.sample_n(df, "id", 40, 20))
    by_hash = [r[0] for r in df.orderBy(splits.hash_order(F.col("id")), "id").collect()]
    assert train == sorted((i,) for i in by_hash[:40]) and test == sorted((i,) for i in by_hash[40:60])


def test_roc_leaves_out_rows_without_a_score(frame):
    df = frame([(1, 0.9), (0, 0.6), (0, None), (None, 0.7)], "label INT, score DOUBLE")
    assert rows_of(metrics.roc_points(df, "label", "score", 2), "threshold", "fpr") == [(0.0, 1.0), (0.5, 1.0), (1.0, 0.0)]


def test_undeclared_classes_do_not_count(frame):
    df = frame([(0, 0), (1, 1), (2, 2), (0, 2)], "o INT, p INT")
    assert metrics.multiclass_metrics(df, "o", "p", [0, 1]).first()["overall_accuracy"] == 1
    assert metrics.class_report(df, "o", "p", [0, 1]).first()["accuracy"] == 1


def test_upsert_errors_show_in_pruned_plans(frame):
    target = frame([(1, 1)], "k INT, v INT")
    double = frame([(1, 2), (1, 3)], "k INT, v INT")
    with pytest.raises(Exception, match="two source rows"):
        joins.merge_upsert(target, double, ["k"]).select("k").collect()


def test_chained_needs_four_kinds(frame):
    rows = frame([(1, None)], "k INT, t TIMESTAMP")
    with pytest.raises(ValueError, match="four kinds"):
        joins.days_since_last(rows, rows.withColumns({"at": F.col("t"), "c": F.lit("x")}), "k", "t", "at", "c", ["x"], chained=True)
