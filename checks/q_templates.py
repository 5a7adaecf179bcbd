"""Whole templates and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from checks.base import CHURN_DAYS, COMPONENTS, ERRORS, Tables, query, r6
from checks.q_aggregates import TAGS
from checks.q_joins import HASH
from fieldmark.functions import calendar as cal
from fieldmark.models import train
from fieldmark.operators.metrics import class_report, mape
from fieldmark.plans import churn, energy, maintenance, retail, rul
from fieldmark.session import stored, work_folder
from fieldmark.sources.versions import read_table
from fieldmark.streaming import arrivals

SENSORS = maintenance.SENSORS
ROLLED = ", ".join(
    f"{'avg' if k == 'mean' else 'stddev_samp'}({s}) OVER (PARTITION BY t.machineID ORDER BY t.datetime ROWS {n} PRECEDING) AS {s}{k}{tail}"
    for n, tail in ((2, ""), (23, "_24hrs"))
    for k in ("mean", "sd")
    for s in SENSORS
)
COUNTS = ", ".join(
    f"CAST(sum(coalesce(e.{e}, 0)) OVER (PARTITION BY t.machineID ORDER BY t.datetime ROWS 23 PRECEDING) AS BIGINT) AS {e}count"
    for e in ERRORS
)
NAMES = [f"{s}{k}{tail}" for tail in ("", "_24hrs") for k in ("mean", "sd") for s in SENSORS]
FINAL = f"""ec AS (SELECT datetime, machineID, {", ".join(f"sum(CASE WHEN errorID = '{e}' THEN 1 ELSE 0 END) AS {e}" for e in ERRORS)} FROM errors GROUP BY 1, 2),
  rolled AS (SELECT * FROM (SELECT t.machineID, t.datetime, {ROLLED}, {COUNTS}, row_number() OVER (PARTITION BY t.machineID ORDER BY t.datetime) AS rn
    FROM telemetry t LEFT JOIN ec e ON t.machineID = e.machineID AND t.datetime = e.datetime) WHERE rn % 3 = 0),
  comp AS (SELECT r.machineID, r.datetime, {", ".join(f"min(CASE WHEN comp = '{c}' THEN date_diff('day', m.datetime, r.datetime) END) AS {c}" for c in COMPONENTS)}
    FROM rolled r LEFT JOIN maint m ON r.machineID = m.machineID AND r.datetime > m.datetime GROUP BY 1, 2),
  label AS (SELECT r.machineID, r.datetime, f.failure FROM rolled r JOIN failures f ON r.machineID = f.machineID
    WHERE date_diff('hour', r.datetime, f.datetime) BETWEEN 0 AND 24)
  SELECT r.machineID, r.datetime, {", ".join(f"round({c}, 6) AS {c}" if "sd" in c else c for c in NAMES)}, {", ".join(f"{e}count" for e in ERRORS)},
    {", ".join(f"coalesce(c.{c}, 0)::BIGINT AS sincelast{c}" for c in COMPONENTS)}, m.model, m.age, coalesce(l.failure, 'none') AS failure
  FROM rolled r LEFT JOIN comp c ON r.machineID = c.machineID AND r.datetime = c.datetime
  LEFT JOIN machines m ON r.machineID = m.machineID LEFT JOIN label l ON r.machineID = l.machineID AND r.datetime = l.datetime"""


def labelled(t: Tables):
    return maintenance.labelled_features(t.telemetry, t.errors, t.maint, t.machines, t.failures)


@query("maintenance_features", f"WITH {FINAL}", "telemetry errors maint machines failures")
def maintenance_features(t: Tables):
    return labelled(t).withColumns(
        {
            **{c: r6(c) for c in NAMES if "sd" in c},
            **{f"sincelast{c}": F.col(f"sincelast{c}").cast("bigint") for c in COMPONENTS},
        }
    )


@query("maintenance_model")
def maintenance_model(t: Tables):
    data = maintenance.with_label_index(labelled(t))
    before, after = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-22 01:00:00", "2024-01-23 01:00:00"))
    training, testing = maintenance.split(data, before, after)
    names = [c for c in maintenance.feature_names(data) if c != "label"]
    model = train.train_boosted(training, names, "label", "multinomial")
    return class_report(train.apply_model(model, testing), "label", "prediction", [0.0, 1.0, 2.0, 3.0, 4.0])


AS_OF = datetime(2024, 1, 25, 12, 7, 30)
LAGS = energy.LOAD_LAGS
ENERGY = f"""hours AS (SELECT region, time AS h, temperature FROM temperature WHERE time BETWEEN TIMESTAMP '2023-01-25 12:00:00' AND TIMESTAMP '2024-01-25 18:00:00'),
  regions AS (SELECT DISTINCT region FROM demand),
  readings AS (SELECT region, time, load FROM demand WHERE time BETWEEN TIMESTAMP '2023-01-25 12:00:00' AND TIMESTAMP '2024-01-25 12:00:00'
    UNION ALL SELECT region, unnest(generate_series(TIMESTAMP '2024-01-25 12:15:00', TIMESTAMP '2024-01-25 18:00:00', INTERVAL 15 MINUTE)), NULL FROM regions),
  known AS (SELECT r.region, r.time, r.load, h.temperature FROM readings r JOIN hours h ON r.region = h.region AND date_trunc('hour', r.time) = h.h),
  grid AS (SELECT region, unnest(generate_series(TIMESTAMP '2023-01-25 12:00:00', TIMESTAMP '2024-01-25 18:00:00', INTERVAL 15 MINUTE)) AS time FROM regions),
  raw AS (SELECT g.region, g.time, k.load, k.temperature FROM grid g LEFT JOIN known k ON g.region = k.region AND g.time = k.time),
  filled AS (SELECT region, time, coalesce(load, lag(load, 96) OVER w, avg(load) OVER (PARTITION BY region)) AS load,
    coalesce(temperature, lag(temperature, 96) OVER w, avg(temperature) OVER (PARTITION BY region)) AS temperature,
    floor((row_number() OVER w - 1) / 96) AS t FROM raw WINDOW w AS (PARTITION BY region ORDER BY time)),
  out AS (SELECT *, {", ".join(f"lag(load, {n}) OVER (PARTITION BY region ORDER BY time) AS lag{n}" for n in LAGS)},
    CASE WHEN dayofweek(time) IN (0, 6) THEN 1 ELSE 0 END AS weekend FROM filled)
  SELECT region, time, round(load, 6) AS load, round(temperature, 6) AS temperature, {", ".join(f"round(lag{n}, 6) AS lag{n}" for n in LAGS)},
    CAST(hour(time) AS INTEGER) AS hourofday, CAST(dayofweek(time) + 1 AS INTEGER) AS dayinweek, CAST(month(time) AS INTEGER) AS monofyear, weekend,
    CASE WHEN hour(time) BETWEEN 8 AND 18 THEN 1 ELSE 0 END AS businesstime, CASE WHEN hour(time) BETWEEN 5 AND 8 THEN 1 ELSE 0 END AS ismorning,
    round(t / 365.25, 6) + 0.0 AS linear_trend, {", ".join(f"round({f}(t * 2 * pi() * {s} / 365.25) * {w}, 6) + 0.0 AS {p}_{f}{s}" for s in (1, 2) for f in ("cos", "sin") for p, w in (("we", "weekend"), ("wd", "(1 - weekend)")))}
  FROM out"""


@query("per_region_run", f"WITH {ENERGY}", "demand temperature")
def per_region_run(t: Tables):
    features = energy.energy_features(t.demand, t.temperature, *energy.forecast_times(AS_OF))
    floats = [c for c, kind in features.dtypes if kind == "double"]
    return features.withColumns({c: r6(c) for c in floats})


@query("rolling_retrain")
def rolling_retrain(t: Tables):
    first = energy.rolling_retrain(t.demand, t.temperature, None, AS_OF)
    actual = t.demand.withColumnRenamed("load", "actual")
    return mape(first.join(actual, ["region", "time"]), "actual", "load", ["region"])


USABLE = f"""good AS (SELECT id1, id2 FROM sales GROUP BY 1, 2 HAVING count(value) >= 52 AND count_if(value <= 0) = 0),
  kept AS (SELECT s.* FROM sales s JOIN good USING (id1, id2)),
  g AS (SELECT id1, id2, unnest(generate_series((SELECT min(time) FROM kept), (SELECT max(time) FROM kept), INTERVAL 7 DAY)) AS time FROM good),
  spine AS (SELECT g.id1, g.id2, g.time, k.value, row_number() OVER (PARTITION BY g.id1, g.id2 ORDER BY g.time) - 1 AS pos,
    count(*) OVER (PARTITION BY g.id1, g.id2) AS size FROM g LEFT JOIN kept k ON k.id1 = g.id1 AND k.id2 = g.id2 AND k.time = g.time),
  passed AS (SELECT id1, id2 FROM spine GROUP BY 1, 2 HAVING sum(CASE WHEN pos < size - 4 AND pos >= size - 10 AND value IS NULL THEN 1 ELSE 0 END) < 6
    AND sum(CASE WHEN pos >= size - 4 AND value IS NULL THEN 1 ELSE 0 END) <= 2)"""
# Years wide around those of the tables.
HOLIDAYS = """WITH years AS (SELECT range AS y FROM range(1980, 2040)),
  firsts AS (SELECT y, make_date(y, 11, 1) AS n, make_date(y, 9, 1) AS s FROM years)
  SELECT 'us_new_year' AS name, make_date(y, 1, 1) AS d FROM years UNION ALL SELECT 'us_labor_day', s + CAST((8 - isodow(s)) % 7 AS INTEGER) FROM firsts
  UNION ALL SELECT 'us_thanksgiving', n + CAST((11 - isodow(n)) % 7 + 21 AS INTEGER) FROM firsts
  UNION ALL SELECT 'cyber_monday', n + CAST((11 - isodow(n)) % 7 + 25 AS INTEGER) FROM firsts UNION ALL SELECT 'christmas', make_date(y, 12, 25) FROM years"""
HOLIDAY_NAMES = ["us_new_year", "us_labor_day", "us_thanksgiving", "cyber_monday", "christmas"]


def usable(t: Tables):
    return retail.usable_series(t.sales, ["id1", "id2"], "time", "value", 4, min_length=52, threshold=0)


@query(
    "retail_features",
    f"""WITH {USABLE}, holidays AS ({HOLIDAYS}), weeks AS (SELECT DISTINCT CAST(time AS DATE) AS day FROM spine),
    flags AS (SELECT day, {", ".join(f"CAST(max(CASE WHEN name = '{h}' THEN 1 ELSE 0 END) AS INTEGER) AS {h}" for h in HOLIDAY_NAMES)}
      FROM weeks LEFT JOIN holidays ON d <= day AND day < d + 7 GROUP BY 1)
    SELECT id1, id2, time, pos, size, round(ln(value), 6) AS value, CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month,
      CAST(ceil(day(time) / 7.0) AS INTEGER) AS weekofmonth,
      CAST(strftime(time + to_days(CAST((7 - dayofweek(time)) % 7 AS INTEGER)), '%U') AS INTEGER) AS weekofyear, {", ".join(HOLIDAY_NAMES)},
      {", ".join(f"round({f}(pos % 52 * 2 * pi() * {s} / 52), 6) + 0.0 AS {f}{s}" for s in range(1, 5) for f in ("cos", "sin"))}
    FROM spine JOIN passed USING (id1, id2) JOIN flags ON day = CAST(time AS DATE)""",
    "sales",
)
def retail_features(t: Tables):
    features = retail.weekly_features(usable(t), "time", "value")
    floats = [c for c, kind in features.dtypes if kind == "double"]
    return features.withColumns({c: r6(c) for c in floats})


KEYS = ["id1", "id2"]


def retail_sets(t: Tables):
    """Features on logarithms, unknown weeks as sales of 1, training rows of all horizons and test rows."""
    features = stored(retail.weekly_features(usable(t).fillna(1.0, subset=["value"]), "time", "value"), "features")
    return retail.horizon_training_rows(features, KEYS, "value", 4), retail.horizon_test_rows(features, KEYS, "value", 4)


@query("retail_model")
def retail_model(t: Tables):
    """Forest and boosted trees on the training rows, measured on the test rows of every series."""
    rows, tested = retail_sets(t)
    names = [c for c in rows.columns if c not in ("id1", "id2", "time", "pos", "size", "value")]
    rows = rows.select(*names, "value").persist(StorageLevel.MEMORY_AND_DISK)  # both models read them
    try:
        models = {"forest": train.train_forest(rows, names, "value", False), "boosted": train.train_boosted(rows, names, "value", "gaussian")}
    finally:
        rows.unpersist()
    return retail.sales_forecast(models, tested, KEYS, "value")[1]


LAG_LINE = f"""WITH {USABLE}, f AS (SELECT id1, id2, pos, size, ln(coalesce(value, 1.0)) AS v FROM spine JOIN passed USING (id1, id2)),
  h AS (SELECT unnest([1, 2, 3, 4]) AS horizon),
  train AS (SELECT t.v, p.v AS x FROM f t, h, f p WHERE t.pos < t.size - 4 AND t.pos >= horizon + 25 AND p.id1 = t.id1 AND p.id2 = t.id2 AND p.pos = t.pos - horizon),
  line AS (SELECT regr_slope(v, x) AS s, regr_intercept(v, x) AS b FROM train),
  test AS (SELECT t.id1, t.id2, t.pos, CAST(t.pos - t.size + 5 AS INTEGER) AS horizon, t.v, p.v AS x, b + s * p.v AS fc
    FROM f t JOIN f p ON p.id1 = t.id1 AND p.id2 = t.id2 AND p.pos = t.size - 5, line WHERE t.pos >= t.size - 4)"""


def lag_line(t: Tables):
    rows, tested = retail_sets(t)
    return retail.sales_forecast({"line": train.train_linear(rows, ["lag1"], "value", solver="normal")}, tested, KEYS, "value")


@query(
    "retail_forecast",
    f"{LAG_LINE} SELECT id1, id2, pos, horizon, round(exp(v), 4) AS value, round(exp(fc), 4) AS forecast_line FROM test",
    "sales",
)
def retail_forecast(t: Tables):
    """A line on the last known value, back from logarithms, for the test rows of every series."""
    return lag_line(t)[0].withColumns({c: r6(c, 4) for c in ("value", "forecast_line")})


@query(
    "retail_forecast_metrics",
    f"{LAG_LINE} SELECT 'line' AS model, round(avg(abs(v - fc)), 6) AS mae, round(sqrt(avg((v - fc) ^ 2)), 6) AS rmse FROM test",
    "sales",
)
def retail_forecast_metrics(t: Tables):
    return lag_line(t)[1].select("model", r6("mae").alias("mae"), r6("rmse").alias("rmse"))


CHURN_GROUPS = f"""{TAGS}, data AS (SELECT UserId, CAST(TagId AS INTEGER) AS label, CASE WHEN CAST(Age AS INTEGER) >= 33 THEN 1 ELSE 0 END AS older,
    {HASH.format('UserId')} % 100 < 70 AS learns FROM tags JOIN users USING (UserId)),
  shares AS (SELECT older, avg(label) AS p FROM data WHERE learns GROUP BY 1),
  scored AS (SELECT UserId, label, p FROM data JOIN shares USING (older) WHERE NOT learns)"""


def churn_run(t: Tables):
    """With one yes/no feature the scores are the shares of the customers trained on."""
    tagged = churn.churn_tags(t.activities, CHURN_DAYS).join(t.users, "UserId")
    tagged = tagged.withColumn("older", (F.col("Age").cast("int") >= 33).cast("double"))
    return churn.churn_scores(tagged, ["older"], train=lambda df, f, label: train.train_logistic(df, f, label, tol=1e-10))


@query("churn_scores", f"WITH {CHURN_GROUPS} SELECT UserId, label, round(p, 4) AS score FROM scored", "activities users")
def churn_scores(t: Tables):
    return churn_run(t)[1].withColumn("score", r6("score", 4))


@query(
    "churn_auc",
    f"""WITH {CHURN_GROUPS}, g AS (SELECT p, count_if(label = 1) AS y, count_if(label = 0) AS n FROM scored GROUP BY 1),
    b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under FROM g)
    SELECT round(sum(y * (under + n / 2)) / (sum(y) * sum(n)), 6) AS auc FROM b""",
    "activities users",
)
def churn_auc(t: Tables):
    return churn_run(t)[2].select(r6("auc").alias("auc"))


def engine_sets(t: Tables):
    """Labels, rolling features and normalisation of the training engines and of the last cycles to test on."""
    sensors = ["s1", "s2", "s3", "s4"]
    truth = t.truth.select((F.col("s_suppkey") + 1).alias("id"), "RUL")
    training, testing = rul.labelled_sets(t.cycles, sensors, truth)
    _, (train_set, test_set) = rul.normalised(training, testing)
    return stored(train_set, "engines"), stored(test_set, "tested")


@query("engine_life_model")
def engine_life_model(t: Tables):
    """Two classes: feature choice and a forest."""
    train_set, test_set = engine_sets(t)
    names = rul.chosen_features(train_set, "label1", 8)
    model = train.train_forest(train_set, names, "label1", True, trees=8, depth=8)
    return train.apply_model(model, test_set).select("id", "RUL", "label1", "prediction")


@query("engine_life_regression")
def engine_life_regression(t: Tables):
    """Forest, boosted trees and a line for the remaining life, measured on the last cycles."""
    train_set, test_set = engine_sets(t)
    names = rul.chosen_features(train_set, "RUL")
    models = {
        "forest": train.train_forest(train_set, names, "RUL", False),
        "boosted": train.train_boosted(train_set, names, "RUL", "gaussian"),
        "line": train.train_linear(train_set, names, "RUL"),
    }
    return rul.life_metrics(models, test_set)


@query("engine_life_classes")
def engine_life_classes(t: Tables):
    """Three classes by forest, joint boosting and multinomial regression."""
    train_set, test_set = engine_sets(t)
    names = rul.chosen_features(train_set, "label2")
    models = {
        "forest": train.train_forest(train_set, names, "label2"),
        "boosted": train.train_boosted(train_set, names, "label2", "multinomial"),
        "multinomial": train.train_multinomial(train_set, names, "label2"),
    }
    return rul.class_metrics(models, test_set)


ENGINE_LINE = """WITH ends AS (SELECT id, max(cycle) AS last FROM cycles GROUP BY 1),
  line AS (SELECT regr_slope(last - cycle, s1) AS s, regr_intercept(last - cycle, s1) AS b FROM cycles JOIN ends USING (id)),
  test AS (SELECT id, cycle, s_suppkey % 40 AS RUL, b + s * s1 AS guess FROM cycles JOIN ends USING (id) JOIN supplier ON s_suppkey + 1 = id, line WHERE cycle = last)"""


def engine_line(t: Tables):
    train_set, test_set = engine_sets(t)
    return {"line": train.train_linear(train_set, ["s1"], "RUL", solver="normal")}, test_set


@query("engine_life_scores", f"{ENGINE_LINE} SELECT id, cycle AS cycle_orig, round(guess, 4) AS line FROM test", "cycles")
def engine_life_scores(t: Tables):
    """The scoring table of a line on one sensor; normalisation does not change a line."""
    return rul.life_scores(*engine_line(t)).withColumn("line", r6("line", 4))


@query(
    "engine_life_metrics",
    f"{ENGINE_LINE} SELECT 'line' AS model, round(avg(abs(RUL - guess)), 4) AS mae, round(sqrt(avg((RUL - guess) ^ 2)), 4) AS rmse FROM test",
    "cycles",
)
def engine_life_metrics(t: Tables):
    return rul.life_metrics(*engine_line(t)).select("model", r6("mae", 4).alias("mae"), r6("rmse", 4).alias("rmse"))


def event_stream(t: Tables):
    """The events table as a stream of files."""
    schema = t.events.schema
    return t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)


@query(
    "stream_tumbling",
    """SELECT event_type, time_bucket(INTERVAL '15 minutes', ts) AS window_start, avg(round(value * 100)) AS mean_hundredths, count(*) AS n
    FROM events GROUP BY 1, 2""",
)
def stream_tumbling(t: Tables):
    base = work_folder(t.spark, "tumbling")
    stream = event_stream(t).withColumn("hundredths", F.round(F.col("value") * 100)).withColumn("ts", F.col("ts").cast("timestamp"))
    means = arrivals.tumbling_means(stream, "ts", ["event_type"], "hundredths")
    arrivals.store_tumbling(means, f"{base}/windows", ["event_type"], f"{base}/state").awaitTermination()
    stored = read_table(t.spark, f"{base}/windows")
    return stored.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "mean_hundredths", "n")


@query(
    "stream_upsert",
    """SELECT user_id, date_trunc('hour', ts) AS hour, strftime(max(ts), '%Y-%m-%d') AS day, arg_max(event_type, (ts, event_id)) AS event_type,
    arg_max(value, (ts, event_id)) AS value, max(event_id) AS event_id FROM events GROUP BY 1, 2""",
)
def stream_upsert(t: Tables):
    base = work_folder(t.spark, "upsert")
    hour = cal.hour_start(F.col("ts"))
    rows = event_stream(t).select(
        "user_id", hour.alias("hour"), F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value", "ts", "event_id"
    )
    arrivals.stream_upsert(rows, f"{base}/table", ["user_id", "hour"], "day", ["ts", "event_id"], f"{base}/state").awaitTermination()
    return read_table(t.spark, f"{base}/table").drop("ts")


@query(
    "stream_upsert_in_parts",
    """SELECT user_id, strftime(ts, '%Y-%m') AS month, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id
    FROM events GROUP BY 1, 2""",
)
def stream_upsert_in_parts(t: Tables):
    """The newest event of a user and month, from four files in falling order of time."""
    base = work_folder(t.spark, "parts")
    rows = t.events.select("user_id", F.date_format("ts", "yyyy-MM").alias("month"), "event_type", "ts", "event_id")
    quarters = F.ntile(4).over(Window.orderBy(F.col("first").desc()))
    months = rows.groupBy("month").agg(F.min("ts").alias("first")).select("month", quarters.alias("file"))
    dealt = rows.join(months, "month")
    for part in range(1, 5):
        dealt.filter(F.col("file") == part).drop("file").coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    arrivals.stream_upsert(stream, f"{base}/table", ["user_id"], "month", ["ts", "event_id"], f"{base}/state").awaitTermination()
    return read_table(t.spark, f"{base}/table")


# Windows are final once the watermark, the newest time minus 20 minutes, has passed their end.
FINAL = """w AS (SELECT event_type, time_bucket(INTERVAL '15 minutes', ts) AS window_start, avg(round(value * 100)) AS mean_hundredths, count(*) AS n
    FROM events GROUP BY 1, 2),
  newest AS (SELECT max(ts) - INTERVAL '20 minutes' AS mark FROM events)"""


@query(
    "stream_final_windows",
    f"WITH {FINAL} SELECT w.* FROM w, newest WHERE window_start + INTERVAL '15 minutes' <= mark",
)
def stream_final_windows(t: Tables):
    base = work_folder(t.spark, "final")
    stream = event_stream(t).withColumn("hundredths", F.round(F.col("value") * 100)).withColumn("ts", F.col("ts").cast("timestamp"))
    means = arrivals.tumbling_means(stream, "ts", ["event_type"], "hundredths")
    arrivals.final_windows(means, f"{base}/windows", f"{base}/state").awaitTermination()
    stored = t.spark.read.parquet(f"{base}/windows")
    return stored.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "mean_hundredths", "n")


@query(
    "score_on_arrival_shares",
    """WITH e AS (SELECT event_id, hour(ts) < 12 AS early, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label FROM events)
    SELECT event_id, round(avg(label) OVER (PARTITION BY early), 4) AS score FROM e""",
)
def score_on_arrival_shares(t: Tables):
    """With one yes/no feature the score of an event is the share of errors in its half of the day."""
    base = work_folder(t.spark, "arrival")
    early = (F.hour("ts") < 12).cast("double").alias("early")
    known = t.events.select(early, (F.col("event_type") == "error").cast("int").alias("label"))
    model = train.train_logistic(known, ["early"], "label", tol=1e-10)
    stream = event_stream(t).select("event_id", early)
    arrivals.score_on_arrival(stream, lambda: model, ["event_id"], f"{base}/scores", f"{base}/state").awaitTermination()
    return t.spark.read.parquet(f"{base}/scores").select("event_id", r6("score", 4).alias("score"))


@query("score_on_arrival")
def score_on_arrival(t: Tables):
    base = work_folder(t.spark, "arrival")
    labelled_events = t.events.select("value", F.hour("ts").alias("hour"), (F.col("event_type") == "error").cast("int").alias("label"))
    model = train.train_logistic(labelled_events, ["value", "hour"], "label")
    stream = event_stream(t).select("event_id", "event_type", "value", F.hour("ts").alias("hour"))
    arrivals.score_on_arrival(stream, lambda: model, ["event_id"], f"{base}/scores", f"{base}/state").awaitTermination()
    return t.spark.read.parquet(f"{base}/scores").select("event_id", "score")
