"""Top rows, set operations, reshaping, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import BRANDS, Tables, query, r6
from checks.q_aggregates import CORR
from checks.q_joins import HASH
from checks.q_windows import brand_scores
from fieldmark.operators import reshape, splits, windows
from fieldmark.operators.metrics import regression_metrics
from fieldmark.operators.ordered import clock_cell, positions


@query("top_n", "SELECT machineID, datetime, volt FROM telemetry ORDER BY machineID, datetime LIMIT 10", "telemetry")
def top_n(t: Tables):
    return reshape.top_n(t.telemetry.select("machineID", "datetime", "volt"), ["machineID", "datetime"], 10)


@query(
    "top_corr_features",
    "SELECT feature, round(c, 6) AS correlation FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, l_quantity)) AS c FROM lineitem" for c in CORR)
    + ") ORDER BY c DESC, feature LIMIT 2",
)
def top_corr_features(t: Tables):
    return reshape.top_corr_features(t.lineitem, CORR, "l_quantity", 2).withColumn("correlation", r6("correlation"))


@query(
    "latest_model",
    "SELECT o_orderpriority AS name, max(o_orderdate) AS created, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS model FROM orders GROUP BY 1",
)
def latest_model(t: Tables):
    models = t.orders.select(
        F.col("o_orderpriority").alias("name"), F.col("o_orderdate").alias("created"), F.col("o_orderkey").alias("model")
    )
    return reshape.latest_model(models, "name", "created", "model")


FORECAST_ERRORS = """SELECT '{0}' AS method, sqrt(avg((value - {0}) * (value - {0}))) AS rmse FROM forecast_rows"""


@query(
    "best_by_rmse",
    "SELECT method, round(rmse, 6) AS rmse FROM ("
    + FORECAST_ERRORS.format("f_flat")
    + " UNION ALL "
    + FORECAST_ERRORS.format("f_wave")
    + ") ORDER BY rmse, method LIMIT 1",
    "forecast_rows",
)
def best_by_rmse(t: Tables):
    parts = {m: regression_metrics(t.forecast_rows, "value", m).select("rmse") for m in ("f_flat", "f_wave")}
    best = reshape.best_by_rmse(reshape.bind_metrics(parts, "method"), "rmse", "method")
    return best.select("method", r6("rmse").alias("rmse"))


@query(
    "union_all",
    "SELECT region, time, load, NULL::DOUBLE AS temperature FROM demand UNION ALL SELECT region, time, NULL, temperature FROM temperature",
    "demand temperature",
)
def union_all(t: Tables):
    return reshape.union_all([t.demand, t.temperature])


@query("distinct_keys", "SELECT DISTINCT id1, id2 FROM sales", "sales")
def distinct_keys(t: Tables):
    return reshape.distinct_keys(t.sales, ["id1", "id2"])


FLAGS = [f"b{i}" for i in range(1, len(BRANDS) + 1)]


@query(
    "unpivot_scores",
    "SELECT cust_id, product, score FROM (UNPIVOT (SELECT * FROM purchases) ON "
    + ", ".join(FLAGS)
    + " INTO NAME product VALUE score)",
    "purchases",
)
def unpivot_scores(t: Tables):
    return reshape.unpivot_scores(t.purchases, ["cust_id"], FLAGS)


@query(
    "pivot_ranked",
    """WITH ranked AS (SELECT o_custkey, p_brand, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, p_brand) AS rank
    FROM (SELECT o_custkey, p_brand, round(sum(l_quantity)) % 97 AS score FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)) SELECT o_custkey, """
    + ", ".join(f"max(CASE WHEN rank = {r} THEN p_brand END) AS Product{r}" for r in range(1, 20))
    + " FROM ranked GROUP BY 1",
)
def pivot_ranked(t: Tables):
    ranked = windows.rank_products(brand_scores(t), "o_custkey", "p_brand", "score")
    return reshape.pivot_ranked(ranked, "o_custkey", "rank", "p_brand", 19)


@query(
    "reshape_long",
    "SELECT PersonId, CAST(generate_subscripts(rt, 1) - 1 AS INTEGER) AS pos, unnest(rt) AS value FROM resumes",
    "resumes",
)
def reshape_long(t: Tables):
    return reshape.reshape_long(t.resumes, ["PersonId"], "rt")


@query(
    "bind_metrics",
    "SELECT method, round(rmse, 6) AS rmse FROM ("
    + FORECAST_ERRORS.format("f_flat")
    + " UNION ALL "
    + FORECAST_ERRORS.format("f_wave")
    + ")",
    "forecast_rows",
)
def bind_metrics(t: Tables):
    parts = {m: regression_metrics(t.forecast_rows, "value", m).select(r6("rmse").alias("rmse")) for m in ("f_flat", "f_wave")}
    return reshape.bind_metrics(parts, "method")


@query(
    "repeatable_split",
    f"SELECT c_custkey, CASE WHEN {HASH.format('c_custkey')} % 100 < 70 THEN 'train' ELSE 'test' END AS part FROM customer",
)
def repeatable_split(t: Tables):
    train, test = splits.repeatable_split(t.customer.select("c_custkey"), "c_custkey", 70)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "stratified_split",
    """SELECT c_custkey, CASE WHEN r < ceil(n * 0.75) THEN 'train' ELSE 'test' END AS part FROM (SELECT c_custkey,
    row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) - 1 AS r,
    count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)""",
)
def stratified_split(t: Tables):
    train, test = splits.stratified_split(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", "c_mktsegment")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.drop("c_mktsegment")


@query(
    "time_split_gap",
    """SELECT machineID, datetime, CASE WHEN datetime < TIMESTAMP '2024-01-20 01:00:00' THEN 'train' ELSE 'test' END AS part FROM telemetry
    WHERE datetime < TIMESTAMP '2024-01-20 01:00:00' OR datetime > TIMESTAMP '2024-01-21 01:00:00'""",
    "telemetry",
)
def time_split_gap(t: Tables):
    before, after = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-20 01:00:00", "2024-01-21 01:00:00"))
    train, test = splits.time_split_gap(t.telemetry.select("machineID", "datetime"), "datetime", before, after)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "series_tail_split",
    """SELECT id1, id2, time, CASE WHEN r <= 4 THEN 'test' ELSE 'train' END AS part FROM
    (SELECT *, row_number() OVER (PARTITION BY id1, id2 ORDER BY time DESC) AS r FROM sales)""",
    "sales",
)
def series_tail_split(t: Tables):


    placed = positions(t.sales, ["id1", "id2"], ["time"], clock_cell("time", 364), "pos", "size")
    train, test = splits.series_tail_split(placed, "pos", "size", 4)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("id1", "id2", "time", "part")


@query("disjoint_folds", f"SELECT o_orderkey, CAST({HASH.format('o_orderkey')} % 5 AS INTEGER) AS fold FROM orders")
def disjoint_folds(t: Tables):
    return splits.disjoint_folds(t.orders.select("o_orderkey"), "o_orderkey", 5)


@query(
    "disjoint_folds_exact",
    """SELECT o_orderkey, CAST(CASE WHEN r < n // 7 * 7 THEN r // (n // 7) ELSE -1 END AS INTEGER) AS fold FROM (SELECT o_orderkey,
    row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders)""",
)
def disjoint_folds_exact(t: Tables):
    out = splits.disjoint_folds(t.orders.select("o_orderkey"), "o_orderkey", 7, exact=True)
    return out.fillna(-1, subset=["fold"])


@query(
    "downsample",
    """SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey, o_orderstatus,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS r,
    count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) WHERE r < floor(n * 0.4::DOUBLE)""",
)
def downsample(t: Tables):
    return splits.downsample(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], "o_orderkey", 0.4)


@query(
    "sample_n",
    """SELECT page_id, CASE WHEN r < 40 THEN 'train' ELSE 'test' END AS part FROM (SELECT page_id,
    row_number() OVER (ORDER BY md5(CAST(page_id AS VARCHAR)), page_id) - 1 AS r FROM pages) WHERE r < 60""",
)
def sample_n(t: Tables):
    train, test = splits.sample_n(t.pages.select("page_id"), "page_id", 40, 20)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
