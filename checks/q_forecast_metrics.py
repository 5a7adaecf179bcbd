"""Series rules, baseline forecasts and evaluation metrics."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from checks.base import Tables, cents, query, r6
from checks.q_sources_rows import SPINE
from checks.q_windows import SPLIT, train_test, weekly
from fieldmark.operators import forecast as fc
from fieldmark.operators import metrics as m
from fieldmark.session import stored

KEYS = ["id1", "id2"]
SEASON = 52


@query(
    "series_rules",
    """SELECT id1, id2, CAST(CASE WHEN count(value) < 150 THEN 1 WHEN count_if(value <= 20) > 0 THEN 2 ELSE 0 END AS INTEGER) AS judge
    FROM sales GROUP BY 1, 2""",
    "sales",
)
def series_rules(t: Tables):
    return fc.series_rules(t.sales, KEYS, "value", min_length=150, threshold=20)


@query(
    "series_rules_split",
    f"""WITH {SPINE}, placed AS (SELECT *, row_number() OVER (PARTITION BY id1, id2 ORDER BY time) AS p, count(*) OVER (PARTITION BY id1, id2) AS n FROM spine)
    SELECT id1, id2, CAST(CASE WHEN sum(CASE WHEN p <= n - 4 AND p > n - 10 AND value IS NULL THEN 1 ELSE 0 END) = 6 THEN 3
      WHEN sum(CASE WHEN p > n - 4 AND value IS NULL THEN 1 ELSE 0 END) > 2 THEN 4 ELSE 0 END AS INTEGER) AS judge FROM placed GROUP BY 1, 2""",
    "sales",
)
def series_rules_split(t: Tables):
    data = stored(weekly(t), "weekly")
    sized = data.withColumn("size", data.agg(F.max("pos").alias("m")).scalar() + 1)
    return fc.series_rules_split(sized, KEYS, "pos", "size", "value", 4)


@query(
    "extend_future",
    """SELECT id1, id2, time, value FROM sales UNION ALL SELECT id1, id2, last + to_days(CAST(7 * s AS INTEGER)), NULL FROM
    (SELECT id1, id2, max(time) AS last FROM sales GROUP BY 1, 2), (SELECT unnest([1, 2, 3, 4]) AS s)""",
    "sales",
)
def extend_future(t: Tables):
    return fc.extend_future(t.sales, KEYS, "time", 4)


SNAIVE = f"""{SPLIT}, naive AS (
  SELECT t.id1, t.id2, t.pos, CAST(t.pos - e AS INTEGER) AS horizon, coalesce(r.value, m) AS forecast
  FROM test t JOIN ends x ON t.id1 = x.id1 AND t.id2 = x.id2
  JOIN train r ON r.id1 = t.id1 AND r.id2 = t.id2 AND r.pos = e - {SEASON} + 1 + (t.pos - e - 1) % {SEASON})"""


def naive(t: Tables):
    train, test = train_test(t)
    return train, fc.seasonal_naive(train, test.select(*KEYS, "pos"), KEYS, "pos", "value", SEASON)


@query("seasonal_naive", f"WITH {SNAIVE} SELECT * FROM naive", "sales")
def seasonal_naive(t: Tables):
    return naive(t)[1]


@query(
    "forecast_interval",
    f"""WITH {SNAIVE}, filled AS (SELECT id1, id2, pos, coalesce(value, m) AS v FROM train JOIN ends USING (id1, id2)),
    res AS (SELECT a.id1, a.id2, sqrt(avg((a.v - b.v) * (a.v - b.v))) AS s FROM filled a JOIN filled b
      ON a.id1 = b.id1 AND a.id2 = b.id2 AND b.pos = a.pos - {SEASON} GROUP BY 1, 2)
    SELECT id1, id2, pos, horizon, forecast, round(forecast - {NormalDist().inv_cdf(0.9)!r} * s, 6) + 0.0 AS lo80,
      round(forecast + {NormalDist().inv_cdf(0.9)!r} * s, 6) + 0.0 AS hi80 FROM naive JOIN res USING (id1, id2)""",
    "sales",
)
def forecast_interval(t: Tables):
    train, forecast = naive(t)
    residuals = fc.naive_residual_size(train, KEYS, "pos", "value", SEASON)
    out = fc.forecast_interval(forecast, residuals, KEYS, SEASON, 80)
    return out.withColumns({"lo80": r6("lo80"), "hi80": r6("hi80")})


@query(
    "decompose_smooth",
    f"""WITH {SPLIT}, filled AS (SELECT id1, id2, pos, e, coalesce(value, m) AS v FROM train JOIN ends USING (id1, id2)),
    ma AS (SELECT *, CASE WHEN count(*) OVER w = 52 THEN avg(v) OVER w END AS ma FROM filled
      WINDOW w AS (PARTITION BY id1, id2 ORDER BY pos ROWS BETWEEN 25 PRECEDING AND 26 FOLLOWING)),
    raw AS (SELECT id1, id2, pos % 52 AS ph, avg(v - ma) AS r FROM ma GROUP BY 1, 2, 3),
    idx AS (SELECT id1, id2, ph, coalesce(r - avg(r) OVER (PARTITION BY id1, id2), 0) AS s FROM raw),
    lev AS (SELECT id1, id2, max(e) AS e, sum((CASE WHEN pos = 0 THEN power(0.8, e - pos) ELSE 0.2 * power(0.8, e - pos) END) * (v - s)) AS l
      FROM filled JOIN idx USING (id1, id2) WHERE ph = pos % 52 GROUP BY 1, 2)
    SELECT t.id1, t.id2, t.pos, CAST(t.pos - lev.e AS INTEGER) AS horizon, round(l + s, 5) + 0.0 AS forecast
    FROM test t JOIN lev USING (id1, id2) JOIN idx i ON i.id1 = t.id1 AND i.id2 = t.id2 AND ph = t.pos % 52""",
    "sales",
)
def decompose_smooth(t: Tables):
    train, test = train_test(t)
    out = fc.decompose_smooth(train, test.select(*KEYS, "pos"), KEYS, "pos", "value", SEASON)
    return out.withColumn("forecast", r6("forecast", 5))


GRID3 = "(SELECT unnest([0, 1, 2]) AS {0})"


@query(
    "confusion_matrix",
    f"""SELECT CAST(o AS INTEGER) AS observed, CAST(p AS INTEGER) AS predicted, count(observed) AS n
    FROM {GRID3.format('o')} CROSS JOIN {GRID3.format('p')} LEFT JOIN classified ON observed = o AND predicted = p GROUP BY 1, 2""",
    "classified",
)
def confusion_matrix(t: Tables):
    return m.confusion_matrix(t.classified, "observed", "predicted", [0, 1, 2])


BINARY = """SELECT (tp + tn) / (tp + fn + fp + tn) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
  2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) AS fscore FROM (SELECT
  CAST(sum(CASE WHEN label = {0} AND guess = {0} THEN 1 ELSE 0 END) AS DOUBLE) AS tp, CAST(sum(CASE WHEN label = {0} AND guess <> {0} THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
  CAST(sum(CASE WHEN label <> {0} AND guess = {0} THEN 1 ELSE 0 END) AS DOUBLE) AS fp, CAST(sum(CASE WHEN label <> {0} AND guess <> {0} THEN 1 ELSE 0 END) AS DOUBLE) AS tn
  FROM (SELECT label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS guess FROM scored))"""


def guessed(t: Tables):
    return t.scored.withColumn("guess", (F.col("score") > 0.5).cast("int"))


@query("binary_metrics", BINARY.format(1), "scored")
def binary_metrics(t: Tables):
    return m.binary_metrics(guessed(t), "label", "guess", 1)


@query("binary_metrics_zero_positive", BINARY.format(0), "scored")
def binary_metrics_zero_positive(t: Tables):
    return m.binary_metrics(guessed(t), "label", "guess", 0)


PER_CLASS = """cm AS (SELECT observed AS o, predicted AS p, count(*)::DOUBLE AS n FROM classified GROUP BY 1, 2),
  tot AS (SELECT sum(n) AS n FROM cm),
  cls AS (SELECT c, coalesce(sum(n) FILTER (o = c AND p = c), 0) AS d, coalesce(sum(n) FILTER (o = c), 0) AS r, coalesce(sum(n) FILTER (p = c), 0) AS q
    FROM cm, (SELECT unnest([0, 1, 2]) AS c) GROUP BY c)"""


@query(
    "multiclass_metrics",
    f"""WITH {PER_CLASS} SELECT round(sum(d) / max(n), 9) AS overall_accuracy, round(avg((n - r - q + 2 * d) / n), 9) AS average_accuracy,
    round(sum(d) / sum(q), 9) AS micro_precision, round(avg(d / q), 9) AS macro_precision, round(sum(d) / sum(r), 9) AS micro_recall, round(avg(d / r), 9) AS macro_recall
    FROM cls, tot""",
    "classified",
)
def multiclass_metrics(t: Tables):
    out = m.multiclass_metrics(t.classified, "observed", "predicted", [0, 1, 2])
    return out.select(*[r6(c, 9).alias(c) for c in out.columns])


@query(
    "class_report",
    f"""WITH {PER_CLASS}, one AS (SELECT c, d / q AS pr, d / r AS re, 2 * (d / q) * (d / r) / (d / q + d / r) AS f1, r / n AS s, q / n AS g, d, r, q, n FROM cls, tot),
    al AS (SELECT sum(d) / max(n) AS acc, avg(pr) AS mp, avg(re) AS mr, avg(f1) AS mf, sum(n - r - q + 2 * d) / (3 * max(n)) AS aa, sum(d) / sum(r) AS mi, max(r) AS big, max(s) AS ma, sum(s * g) AS ex, sum(s * s) AS wa FROM one),
    maj AS (SELECT min(c) AS c0 FROM one, al WHERE r = big),
    fin AS (SELECT c AS class, acc AS accuracy, pr AS precision, re AS recall, f1, mp AS macro_precision, mr AS macro_recall, mf AS macro_f1, aa AS average_accuracy, mi AS micro_average,
      ma AS majority_accuracy, CASE WHEN c = c0 THEN s ELSE 0 END AS majority_precision, CASE WHEN c = c0 THEN 1.0::DOUBLE ELSE 0 END AS majority_recall,
      CASE WHEN c = c0 THEN 2 * s / (s + 1) ELSE 0 END AS majority_f1, (acc - ex) / (1 - ex) AS kappa, 1 / 3.0::DOUBLE AS random_accuracy, s AS random_precision,
      1 / 3.0::DOUBLE AS random_recall, 2 * s / (3 * s + 1) AS random_f1, wa AS weighted_accuracy, s AS weighted_precision, s AS weighted_recall, s AS weighted_f1
      FROM one, al, maj)
    SELECT class, round(COLUMNS(* EXCLUDE class), 9) + 0.0 FROM fin""",
    "classified",
)
def class_report(t: Tables):
    out = m.class_report(t.classified, "observed", "predicted", [0, 1, 2])
    return out.select("class", *[r6(c, 9).alias(c) for c in out.columns if c != "class"])


@query(
    "regression_metrics",
    """SELECT round(avg(abs(value - f_wave)), 6) AS mae, round(sqrt(avg((value - f_wave) ^ 2)), 6) AS rmse,
    round(sum(abs(value - f_wave)) / sum(abs(value - mv)), 6) AS rae, round(sum((value - f_wave) ^ 2) / sum((value - mv) ^ 2), 6) AS rse,
    round(1 - sum((value - f_wave) ^ 2) / sum((value - mv) ^ 2), 6) AS r2 FROM (SELECT *, avg(value) OVER () AS mv FROM forecast_rows)""",
    "forecast_rows",
)
def regression_metrics(t: Tables):
    out = m.regression_metrics(t.forecast_rows, "value", "f_wave")
    return out.select(*[r6(c).alias(c) for c in out.columns])


ROC = """(SELECT k / 100.0::DOUBLE AS threshold, (SELECT count(*) FILTER (label = 0 AND b >= k) / count(*) FILTER (label = 0) FROM bucketed) AS fpr,
  (SELECT count(*) FILTER (label = 1 AND b >= k) / count(*) FILTER (label = 1) FROM bucketed) AS tpr FROM (SELECT unnest(range(101)) AS k))"""
BUCKETED = "bucketed AS (SELECT label, least(greatest(floor(score * 100), 0), 100) AS b FROM scored)"


@query("roc_points", f"WITH {BUCKETED} SELECT * FROM {ROC}", "scored")
def roc_points(t: Tables):
    return m.roc_points(t.scored, "label", "score")


@query(
    "auc_from_points",
    f"""WITH {BUCKETED}, pts AS {ROC} SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 6) AS auc FROM
    (SELECT *, coalesce(lag(fpr) OVER (ORDER BY threshold DESC), 0) AS f0, coalesce(lag(tpr) OVER (ORDER BY threshold DESC), 0) AS t0 FROM pts)""",
    "scored",
)
def auc_from_points(t: Tables):
    return m.auc_from_points(m.roc_points(t.scored, "label", "score")).select(r6("auc").alias("auc"))


@query(
    "auc",
    """SELECT round((sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2) / (p * n), 6) AS auc FROM
    (SELECT label, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2 AS r,
     count_if(label = 1) OVER () AS p, count_if(label = 0) OVER () AS n FROM scored) GROUP BY p, n""",
    "scored",
)
def auc(t: Tables):
    return m.auc(t.scored, "label", "score").select(r6("auc").alias("auc"))


@query("mape", "SELECT id2, round(avg(abs(f_wave - value) / value), 6) AS mape FROM forecast_rows GROUP BY 1", "forecast_rows")
def mape(t: Tables):
    return m.mape(t.forecast_rows, "value", "f_wave", ["id2"]).withColumn("mape", r6("mape"))


METHODS = {"flat": "f_flat", "wave": "f_wave"}
ACCURACY = "acc AS (" + " UNION ALL ".join(
    f"""SELECT id1, id2, '{name}' AS method, count(*) AS n, avg(value - {f}) AS me, sqrt(avg((value - {f}) ^ 2)) AS rmse, avg(abs(value - {f})) AS mae,
    avg(100 * (value - {f}) / value) AS mpe, avg(abs(100 * (value - {f}) / value)) AS mape, avg(abs(value - {f})) / avg(abs(value - before)) AS mase
    FROM (SELECT *, lag(value) OVER (PARTITION BY id1, id2 ORDER BY pos) AS before FROM forecast_rows) GROUP BY 1, 2"""
    for name, f in METHODS.items()
) + ")"
MEASURES = ["me", "rmse", "mae", "mpe", "mape", "mase"]


def accuracy(t: Tables):
    return m.forecast_accuracy(t.forecast_rows, KEYS, "pos", "value", METHODS)


@query(
    "forecast_accuracy",
    f"WITH {ACCURACY} SELECT id1, id2, method, n, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in MEASURES) + " FROM acc",
    "forecast_rows",
)
def forecast_accuracy(t: Tables):
    return accuracy(t).withColumns({c: r6(c) for c in MEASURES})


@query(
    "weighted_summary",
    f"""WITH {ACCURACY} SELECT method, round(sum(n * mae) / sum(n), 6) AS mae, round(sum(n * mase) / sum(n), 6) AS mase,
    round(sqrt(sum(n * rmse * rmse) / sum(n)), 6) AS rmse FROM acc GROUP BY 1""",
    "forecast_rows",
)
def weighted_summary(t: Tables):
    out = m.weighted_summary(accuracy(t), ["method"], "n", ["mae", "mase"])
    return out.withColumns({c: r6(c) for c in ("mae", "mase", "rmse")})


@query(
    "residual_bands",
    """SELECT id2, round(avg(f_wave - value), 6) AS error_mean, round(stddev_samp(f_wave - value), 6) AS error_sd,
    round(-1.96::DOUBLE * stddev_samp(f_wave - value), 6) AS band_low, round(1.96::DOUBLE * stddev_samp(f_wave - value), 6) AS band_high
    FROM forecast_rows GROUP BY 1""",
    "forecast_rows",
)
def residual_bands(t: Tables):
    out = m.residual_bands(t.forecast_rows, ["id2"], "value", "f_wave")
    return out.select("id2", *[r6(c).alias(c) for c in out.columns if c != "id2"])


ACF = f"""WITH {SPINE}, e AS (SELECT id1, id2, row_number() OVER w AS p, coalesce(value, 0) - 25 AS err FROM spine WINDOW w AS (PARTITION BY id1, id2 ORDER BY time)),
    d AS (SELECT id1, id2, p, err - avg(err) OVER (PARTITION BY id1, id2) AS d FROM e),
    s AS (SELECT id1, id2, sum(d * d) AS s FROM d GROUP BY 1, 2)
    SELECT a.id1, a.id2, CAST(k AS INTEGER) AS lag, round(sum(a.d * b.d) / any_value(s), 6) + 0.0 AS acf
    FROM d a, (SELECT unnest([1, 2, 3, 4, 5]) AS k), d b, s
    WHERE b.id1 = a.id1 AND b.id2 = a.id2 AND b.p = a.p - k AND s.id1 = a.id1 AND s.id2 = a.id2 GROUP BY 1, 2, 3"""


@query("residual_acf", ACF, "sales")
def residual_acf(t: Tables):
    errors = stored(weekly(t), "weekly").select(*KEYS, "pos", (F.coalesce("value", F.lit(0.0)) - 25).alias("error"))
    return m.residual_acf(errors, KEYS, "pos", "error", 5).withColumn("acf", r6("acf"))


@query(
    "residual_pacf",
    f"""SELECT * FROM (WITH RECURSIVE ac AS (SELECT id1, id2, list(acf ORDER BY lag) AS r FROM ({ACF.replace("round(sum(a.d * b.d) / any_value(s), 6) + 0.0", "sum(a.d * b.d) / any_value(s)")}) GROUP BY 1, 2),
    steps AS (SELECT id1, id2, r, 1 AS k, [r[1]] AS phi, r[1] AS p FROM ac UNION ALL
      SELECT id1, id2, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - q * phi[k + 1 - j]), q), q FROM (
        SELECT *, (r[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 1 - j])))
          / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j]))) AS q FROM steps WHERE k < 5))
    SELECT id1, id2, k AS lag, round(r[k], 6) + 0.0 AS acf, round(p, 5) + 0.0 AS pacf FROM steps)""",
    "sales",
)
def residual_pacf(t: Tables):
    errors = stored(weekly(t), "weekly").select(*KEYS, "pos", (F.coalesce("value", F.lit(0.0)) - 25).alias("error"))
    return m.residual_pacf(errors, KEYS, "pos", "error", 5).withColumns({"acf": r6("acf"), "pacf": r6("pacf", 5)})


@query(
    "metric_outliers",
    f"""WITH {ACCURACY}, b AS (SELECT method, quantile_cont(mae, 0.25) AS q1, quantile_cont(mae, 0.75) AS q3 FROM acc GROUP BY 1)
    SELECT id1, id2, acc.method, round(mae, 6) AS mae FROM acc JOIN b ON acc.method = b.method
    WHERE mae < q1 - 1.5 * (q3 - q1) OR mae > q3 + 1.5 * (q3 - q1)""",
    "forecast_rows",
)
def metric_outliers(t: Tables):
    measured = accuracy(t).select(*KEYS, "method", "mae")
    return m.metric_outliers(measured, ["method"], "mae").withColumn("mae", r6("mae"))


@query(
    "exact_quantiles",
    """SELECT event_type, round(quantile_cont(round(value * 100), 0.1), 6) AS p10, round(quantile_cont(round(value * 100), 0.5), 6) AS p50,
    round(quantile_cont(round(value * 100), 0.9), 6) AS p90 FROM events GROUP BY 1""",
)
def exact_quantiles(t: Tables):
    values = t.events.select("event_type", cents("value").alias("v"))
    out = m.exact_quantiles(values, ["event_type"], "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return out.withColumns({c: r6(c) for c in ("p10", "p50", "p90")})
