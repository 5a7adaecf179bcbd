"""Evaluation metrics as grouped aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmark.functions.numbers import safe_divide
from fieldmark.operators.ordered import last_known, over_blocks, running_sums, sort_cells
from fieldmark.session import measured, stored

# Fixed value: half width of the 95 % band in standard deviations.
BAND_95 = 1.96
# Fixed value: whisker length of a box plot in interquartile ranges.
WHISKER = 1.5


def _total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def confusion_matrix(df: DataFrame, observed: str, predicted: str, levels: Sequence) -> DataFrame:
    """Counts for every pair of declared levels, zeros included."""
    counts = df.agg(
        *[
            F.struct(
                F.lit(o).alias("observed"),
                F.lit(p).alias("predicted"),
                F.count_if((F.col(observed) == F.lit(o)) & (F.col(predicted) == F.lit(p))).alias("n"),
            ).alias(f"c{i}_{j}")
            for i, o in enumerate(levels)
            for j, p in enumerate(levels)
        ]
    )
    return counts.select(F.inline(F.array(*counts.columns)))


def binary_metrics(df: DataFrame, observed: str, predicted: str, positive=1) -> DataFrame:
    """Accuracy, precision, recall and F-score for the class taken as positive."""
    o, p = F.col(observed) == F.lit(positive), F.col(predicted) == F.lit(positive)
    c = df.agg(
        F.count_if(o & p).alias("tp"),
        F.count_if(o & ~p).alias("fn"),
        F.count_if(~o & p).alias("fp"),
        F.count_if(~o & ~p).alias("tn"),
    )
    tp, fn, fp, tn = (F.col(x) for x in ("tp", "fn", "fp", "tn"))
    precision, recall = safe_divide(tp, tp + fp), safe_divide(tp, tp + fn)
    return c.select(
        safe_divide(tp + tn, tp + fn + fp + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        safe_divide(2 * precision * recall, precision + recall).alias("fscore"),
    )


def _class_counts(df: DataFrame, observed: str, predicted: str, levels: Sequence) -> DataFrame:
    """One row: hits d*, observed r* and predicted q* per level, and n.

    As in the confusion matrix, only rows with two declared levels count.
    """
    o, p = F.col(observed), F.col(predicted)
    known = df.filter(o.isin(list(levels)) & p.isin(list(levels)))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, level in enumerate(levels):
        aggs += [
            F.count_if((o == F.lit(level)) & (p == F.lit(level))).alias(f"d{i}"),
            F.count_if(o == F.lit(level)).alias(f"r{i}"),
            F.count_if(p == F.lit(level)).alias(f"q{i}"),
        ]
    return known.agg(*aggs)


def multiclass_metrics(df: DataFrame, observed: str, predicted: str, levels: Sequence) -> DataFrame:
    """Overall and average accuracy, micro and macro precision and recall.

    Precision divides by what was predicted and recall by what was observed.
    A class never seen on one side leaves its macro figure NULL.
    """
    counts = _class_counts(df, observed, predicted, levels)
    k = len(levels)
    d = [F.col(f"d{i}") for i in range(k)]
    r = [F.col(f"r{i}") for i in range(k)]
    q = [F.col(f"q{i}") for i in range(k)]
    n = F.col("n")
    accuracy = [safe_divide(n - r[i] - q[i] + 2 * d[i], n) for i in range(k)]
    return counts.select(
        safe_divide(_total(d), n).alias("overall_accuracy"),
        (_total(accuracy) / k).alias("average_accuracy"),
        safe_divide(_total(d), _total(q)).alias("micro_precision"),
        (_total([safe_divide(d[i], q[i]) for i in range(k)]) / k).alias("macro_precision"),
        safe_divide(_total(d), _total(r)).alias("micro_recall"),
        (_total([safe_divide(d[i], r[i]) for i in range(k)]) / k).alias("macro_recall"),
    )


def class_report(df: DataFrame, observed: str, predicted: str, levels: Sequence) -> DataFrame:
    """One row per class with its own, averaged and baseline figures."""
    counts = _class_counts(df, observed, predicted, levels)
    k = len(levels)
    n = F.col("n")
    d = [F.col(f"d{i}") for i in range(k)]
    r = [F.col(f"r{i}") for i in range(k)]
    q = [F.col(f"q{i}") for i in range(k)]
    precision = [safe_divide(d[i], q[i]) for i in range(k)]
    recall = [safe_divide(d[i], r[i]) for i in range(k)]
    f1 = [safe_divide(2 * precision[i] * recall[i], precision[i] + recall[i]) for i in range(k)]
    share = [safe_divide(r[i], n) for i in range(k)]
    accuracy = safe_divide(_total(d), n)
    expected = _total([share[i] * safe_divide(q[i], n) for i in range(k)])
    # Each class against the rest: its hits and true rejections, over n per class.
    agreeing = _total([n - r[i] - q[i] + 2 * d[i] for i in range(k)])
    micro = safe_divide(_total(d), _total(r))
    largest = F.greatest(*r)
    # The first of the most frequent classes, as a place in the level list.
    majority = reduce(
        lambda rest, i: F.when(r[i] == largest, F.lit(i)).otherwise(rest), reversed(range(k)), F.lit(None)
    )
    rows = []
    for i, level in enumerate(levels):
        is_majority = majority == i
        majority_precision = F.when(is_majority, share[i]).otherwise(0.0)
        rows.append(
            F.struct(
                F.lit(level).alias("class"),
                accuracy.alias("accuracy"),
                precision[i].alias("precision"),
                recall[i].alias("recall"),
                f1[i].alias("f1"),
                (_total(precision) / k).alias("macro_precision"),
                (_total(recall) / k).alias("macro_recall"),
                (_total(f1) / k).alias("macro_f1"),
                safe_divide(agreeing, n * k).alias("average_accuracy"),
                micro.alias("micro_average"),
                safe_divide(largest, n).alias("majority_accuracy"),
                majority_precision.alias("majority_precision"),
                F.when(is_majority, 1.0).otherwise(0.0).alias("majority_recall"),
                F.when(is_majority, 2 * share[i] / (share[i] + 1)).otherwise(0.0).alias("majority_f1"),
                safe_divide(accuracy - expected, 1 - expected).alias("kappa"),
                F.lit(1.0 / k).alias("random_accuracy"),
                share[i].alias("random_precision"),
                F.lit(1.0 / k).alias("random_recall"),
                (2 * share[i] / (k * share[i] + 1)).alias("random_f1"),
                _total([s * s for s in share]).alias("weighted_accuracy"),
                share[i].alias("weighted_precision"),
                share[i].alias("weighted_recall"),
                share[i].alias("weighted_f1"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def regression_metrics(df: DataFrame, observed: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, relative absolute and squared error, and R2 on complete rows."""
    known = df.filter(F.col(observed).isNotNull() & F.col(predicted).isNotNull())
    mean = known.groupBy(*keys).agg(F.avg(observed).alias("_mean"))
    based = known.join(measured(mean), list(keys), "left") if keys else known.withColumn("_mean", mean.scalar())
    error = F.col(observed) - F.col(predicted)
    spread = F.col(observed) - F.col("_mean")
    sums = based.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        safe_divide(F.sum(F.abs(error)), F.sum(F.abs(spread))).alias("rae"),
        safe_divide(F.sum(error * error), F.sum(spread * spread)).alias("rse"),
    )
    return sums.withColumn("r2", 1 - F.col("rse"))


def roc_points(df: DataFrame, label: str, score: str, points: int = 100) -> DataFrame:
    """False and true positive rate at the cut-offs 0, 1/points, .., 1.

    A row passes a cut-off if its score is not below it.  Rows are reduced to
    `points`+1 buckets before anything is ordered.  Rows without a score or a label
    do not count.
    """
    df = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    bucket = F.least(F.greatest(F.floor(F.col(score) * points), F.lit(0)), F.lit(points))
    counts = df.groupBy(bucket.alias("bucket")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")
    )
    cuts = df.sparkSession.range(points + 1).select(F.col("id").alias("bucket"))
    # One row per cut-off, so one task is enough.
    above = Window.partitionBy().orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    filled = cuts.join(counts, "bucket", "left").fillna(0, subset=["_p", "_n"])
    return filled.select(
        (F.col("bucket") / F.lit(float(points))).alias("threshold"),
        safe_divide(F.sum("_n").over(above), F.sum("_n").over(every)).alias("fpr"),
        safe_divide(F.sum("_p").over(above), F.sum("_p").over(every)).alias("tpr"),
    )


def auc_from_points(points: DataFrame) -> DataFrame:
    """Area under the points of `roc_points` by trapezoids, from (0, 0)."""
    along = Window.partitionBy().orderBy(F.desc("threshold"))
    steps = points.withColumns(
        {
            "_f": F.coalesce(F.lag("fpr").over(along), F.lit(0.0)),
            "_t": F.coalesce(F.lag("tpr").over(along), F.lit(0.0)),
        }
    )
    area = (F.col("fpr") - F.col("_f")) * (F.col("tpr") + F.col("_t")) / 2
    return steps.agg(F.sum(area).alias("auc"))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the curve: rows are first merged by distinct score."""
    scores = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(score)
        .agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    )
    ordered = sort_cells(scores, [score], "_sorted")
    running = running_sums(ordered, [], [score], F.col("_sorted"), {"_below": F.col("_n")})
    wins = F.col("_p") * (F.col("_below") - F.col("_n") / 2)
    return running.agg(
        safe_divide(F.sum(wins), F.sum("_p").cast("double") * F.sum("_n")).alias("auc")
    )


def mape(df: DataFrame, actual: str, forecast: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of |forecast - actual| / actual; rows with actual 0 do not count."""
    ratio = F.try_divide(F.abs(F.col(forecast) - F.col(actual)).cast("double"), F.col(actual))
    return df.groupBy(*keys).agg(F.avg(ratio).alias("mape"))


def forecast_accuracy(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    actual: str,
    forecasts: Mapping[str, str],
    block: int = 8192,
) -> DataFrame:
    """ME, RMSE, MAE, MPE, MAPE and MASE per series and method.

    MASE divides by the mean step between neighbouring known actual values of
    the same rows.  The previous actual value is looked up once for all methods.
    """
    known = df.filter(F.col(actual).isNotNull())
    cell = F.floor(F.col(pos) / F.lit(block))
    stepped = last_known(known, keys, [pos], cell, {"_before": F.col(actual)})
    values = F.explode(
        F.array(
            *[F.struct(F.lit(m).alias("method"), F.col(c).cast("double").alias("_f")) for m, c in forecasts.items()]
        )
    )
    long = stepped.select(*keys, actual, "_before", values.alias("_m")).select(
        *keys, actual, "_before", "_m.method", "_m._f"
    )
    error = F.col(actual) - F.col("_f")
    percent = 100 * F.try_divide(error, F.col(actual).cast("double"))
    out = long.groupBy(*keys, "method").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error).alias("me"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(percent).alias("mpe"),
        F.avg(F.abs(percent)).alias("mape"),
        F.avg(F.abs(F.col(actual) - F.col("_before"))).alias("_step"),
    )
    return out.withColumn("mase", safe_divide(F.col("mae"), F.col("_step"))).drop("_step")


def weighted_summary(
    metrics: DataFrame, keys: Sequence[str], weight: str, means: Sequence[str], roots: Sequence[str] = ("rmse",)
) -> DataFrame:
    """Weighted means over series; root metrics as root of the mean square."""
    w = F.col(weight)
    aggs = [safe_divide(F.sum(w * F.col(m)), F.sum(F.when(F.col(m).isNotNull(), w))).alias(m) for m in means]
    aggs += [
        F.sqrt(safe_divide(F.sum(w * F.col(r) * F.col(r)), F.sum(F.when(F.col(r).isNotNull(), w)))).alias(r)
        for r in roots
    ]
    return metrics.groupBy(*keys).agg(*aggs)


def residual_bands(df: DataFrame, keys: Sequence[str], actual: str, forecast: str) -> DataFrame:
    """Mean and deviation of forecast - actual, with the 95 % band."""
    error = F.col(forecast) - F.col(actual)
    return (
        df.groupBy(*keys)
        .agg(F.avg(error).alias("error_mean"), F.stddev_samp(error).alias("error_sd"))
        .withColumns({"band_low": -BAND_95 * F.col("error_sd"), "band_high": BAND_95 * F.col("error_sd")})
    )


def residual_acf(
    df: DataFrame, keys: Sequence[str], pos: str, error: str, lags: int = 10
) -> DataFrame:
    """Autocorrelation of the errors at lag 1..lags per series."""
    means = measured(df.groupBy(*keys).agg(F.avg(error).alias("_mean")))
    centred = df.select(*keys, pos, error).join(means, list(keys), "inner")
    centred = centred.select(*keys, pos, (F.col(error) - F.col("_mean")).alias("_d"))
    lagged = over_blocks(
        centred,
        keys,
        pos,
        {f"_d{k}": lambda w, k=k: F.lag("_d", k).over(w) for k in range(1, lags + 1)},
        before=lags,
    )
    sums = lagged.groupBy(*keys).agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_s"),
        *[F.sum(F.col("_d") * F.col(f"_d{k}")).alias(f"_s{k}") for k in range(1, lags + 1)],
    )
    cells = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), safe_divide(F.col(f"_s{k}"), F.col("_s")).alias("acf"))
            for k in range(1, lags + 1)
        ]
    )
    return sums.select(*keys, F.inline(cells))


def residual_pacf(df: DataFrame, keys: Sequence[str], pos: str, error: str, lags: int = 10) -> DataFrame:
    """Autocorrelation and partial autocorrelation of the errors at lag 1..lags per series.

    The recursion of Durbin and Levinson is a fold over the autocorrelations of a series,
    which are one short array, so nothing is read or moved beyond `residual_acf`.  A lag that
    leaves no variance, or a series without spread, has NULL from there on.
    """
    acf = residual_acf(df, keys, pos, error, lags)
    series = acf.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("_r"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)

    def step(state: Column, k: Column) -> Column:
        known, r = state["phi"], F.slice("_r", 1, k - 1)
        left = F.lit(1.0) - dot(known, r)
        here = safe_divide(F.get("_r", k - 1) - dot(known, F.reverse(r)), left)
        # Computed once: the new coefficient is used for each of the others.
        moved = F.transform(
            F.array(here),
            lambda p: F.struct(
                F.concat(F.zip_with(known, F.reverse(known), lambda x, y: x - p * y), F.array(p)).alias("phi"),
                F.concat(state["out"], F.array(p)).alias("out"),
            ),
        )
        return F.get(moved, F.lit(0))

    none = F.array().cast("array<double>")
    folded = F.aggregate(F.sequence(F.lit(1), F.lit(lags)), F.struct(none.alias("phi"), none.alias("out")), step, lambda s: s["out"])
    both = F.arrays_zip(F.sequence(F.lit(1), F.lit(lags)).alias("lag"), F.col("_r").alias("acf"), folded.alias("pacf"))
    return series.select(*keys, F.inline(both).alias("lag", "acf", "pacf"))


# Rank error allowed to the first look at quantiles is 1 / this; it only decides how much is looked at again.
SKETCH = 10_000


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], most: int = 200_000
) -> DataFrame:
    """Interpolated quantiles per group, exact, without sorting a group.

    A first aggregate brackets every wanted rank by sketches that merge.  A second look
    counts what lies below each bracket, and the distinct values inside, about 4 in
    SKETCH of the rows; only these are ordered.  `df` is read twice, so store it if it is
    costly.  Brackets with more than `most` distinct values are ordered across tasks.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    ends = [(max(p - 2 / SKETCH, 0.0), min(p + 2 / SKETCH, 1.0)) for p in probs.values()]
    sketch = F.percentile_approx("_v", [e for pair in ends for e in pair], SKETCH)
    seen = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), sketch.alias("_at"))
    # Of few rows the bracket might be narrower than the step from one rank to the next.
    few = F.col("_size") <= 5 * SKETCH
    brackets = F.array(
        *[
            F.struct(
                F.lit(i).alias("q"),
                (F.col("_min") if low == 0 else F.when(few, F.col("_min")).otherwise(F.get("_at", F.lit(2 * i)))).alias("low"),
                (F.col("_max") if high == 1 else F.when(few, F.col("_max")).otherwise(F.get("_at", F.lit(2 * i + 1)))).alias("high"),
            )
            for i, (low, high) in enumerate(ends)
        ]
    )
    bounds = measured(seen.select(*keys, "_size", brackets.alias("_b")))
    placed = rows.join(bounds.select(*keys, "_b"), keys) if keys else rows.withColumn("_b", bounds.select("_b").scalar())
    # A value below a bracket counts without its value; one above it is not needed.
    inside = F.transform("_b", lambda b: F.when(F.col("_v") <= b["high"], F.struct(b["q"].alias("q"), F.when(F.col("_v") >= b["low"], F.col("_v")).alias("v"))))
    spread = placed.select(*keys, F.explode(F.filter(inside, lambda x: x.isNotNull())).alias("x"))
    counts = stored(spread.groupBy(*keys, F.col("x.q").alias("_q"), F.col("x.v").alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "brackets")
    group = [*keys, "_q"]
    widest = counts.groupBy(*group).count().agg(F.max("count").alias("m")).first()["m"] or 0
    if widest <= most:
        along = Window.partitionBy(*group).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
        running = counts.withColumn("_upto", F.sum("_n").over(along))
    else:
        ordered = sort_cells(counts, [*[F.col(k) for k in group], F.col("_v").asc_nulls_first()], "_sorted")
        running = running_sums(ordered, group, [F.col("_v").asc_nulls_first()], F.col("_sorted"), {"_upto": F.col("_n")})
    sized = running.join(bounds.select(*keys, "_size"), keys) if keys else running.withColumn("_size", bounds.select("_size").scalar())
    first = F.col("_upto") - F.col("_n")
    out = []
    for i, (name, p) in enumerate(probs.items()):
        rank = (F.col("_size") - 1) * F.lit(p)

        def at(wanted: Column, i: int = i) -> Column:
            return F.max(F.when((F.col("_q") == i) & (first <= wanted) & (wanted < F.col("_upto")), F.col("_v")))

        low, high = at(F.floor(rank)), at(F.ceil(rank))
        out.append((low + (high - low) * F.max(rank - F.floor(rank))).alias(name))
    return sized.groupBy(*keys).agg(*out)


def metric_outliers(
    metrics: DataFrame, keys: Sequence[str], metric: str
) -> DataFrame:
    """Rows outside the whiskers of their group's box plot.

    The metrics are computed once; quartiles and rows are read from what is stored.
    """
    metrics = stored(metrics, "metrics")
    quartiles = exact_quantiles(metrics, keys, metric, {"_q1": 0.25, "_q3": 0.75})
    joined = metrics.join(measured(quartiles), list(keys), "inner")
    reach = (F.col("_q3") - F.col("_q1")) * WHISKER
    outside = (F.col(metric) < F.col("_q1") - reach) | (F.col(metric) > F.col("_q3") + reach)
    return joined.filter(outside).drop("_q1", "_q3")
