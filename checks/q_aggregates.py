"""Grouped and whole-table summaries, and the churn template."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import CHURN_DAYS, COMPONENTS, ERRORS, Tables, cents, query, r6
from fieldmark.operators import aggregates as agg
from fieldmark.plans import churn

FEATURES = """feats AS (
  SELECT a.UserId, sum(Quantity) AS TotalQuantity, sum(Val) AS TotalValue,
    coalesce(stddev_samp(Quantity), 0) AS StDevQuantity, coalesce(stddev_samp(Val), 0) AS StDevValue,
    CAST(floor(sum(gap) / count(*)) AS BIGINT) AS AvgTimeDelta,
    date_diff('day', max(TransactionTime), (SELECT max(TransactionTime) FROM activities)) - 365 AS Recency,
    count(DISTINCT TransactionId) AS UniqueTransactionId, count(DISTINCT ItemId) AS UniqueItemId,
    count(DISTINCT Location) AS UniqueLocation, count(DISTINCT ProductCategory) AS UniqueProductCategory
  FROM (SELECT *, coalesce(date_diff('day', lag(TransactionTime) OVER (PARTITION BY UserId ORDER BY TransactionTime, TransactionId),
               TransactionTime), 0) AS gap FROM activities) a
  WHERE TransactionTime <= (SELECT max(TransactionTime) FROM activities) - INTERVAL 365 DAY GROUP BY 1)"""
PLAIN = """UserId, coalesce(TotalQuantity, -1) AS TotalQuantity, TotalValue, round(StDevQuantity, 6) AS StDevQuantity,
  round(StDevValue, 3) AS StDevValue, AvgTimeDelta, Recency, UniqueTransactionId, UniqueItemId, UniqueLocation, UniqueProductCategory"""
TAGS = """tags AS (SELECT UserId, CASE WHEN count(*) - count_if(early) <= 0 THEN 'Churner' ELSE 'Nonchurner' END AS Tag,
  CASE WHEN count(*) - count_if(early) <= 0 THEN '1' ELSE '0' END AS TagId
  FROM (SELECT *, TransactionTime <= (SELECT max(TransactionTime) FROM activities) - INTERVAL 365 DAY AS early FROM activities)
  GROUP BY 1 HAVING count_if(early) > 0)"""


def _plain(df):
    return df.withColumns(
        {
            "TotalQuantity": F.coalesce("TotalQuantity", F.lit(-1.0)),
            "StDevQuantity": r6("StDevQuantity"),
            "StDevValue": r6("StDevValue", 3),
            "Recency": F.col("Recency").cast("bigint"),
        }
    )


@query("customer_features", f"WITH {FEATURES} SELECT {PLAIN} FROM feats", "activities")
def customer_features(t: Tables):
    return _plain(agg.customer_features(t.activities, CHURN_DAYS))


RATIOS = ", ".join(
    f"coalesce(Total{w} / (Unique{p} + 1), -1) AS Total{w}perUnique{p}"
    for w in ("Quantity", "Value")
    for p in ("TransactionId", "ItemId", "Location", "ProductCategory")
)


@query(
    "churn_template",
    f"WITH {FEATURES}, {TAGS} SELECT {PLAIN.replace('UserId', 'f.UserId', 1)}, {RATIOS}, Age, Address, Gender, UserType, Tag, TagId "
    "FROM feats f LEFT JOIN users u ON f.UserId = u.UserId JOIN tags g ON f.UserId = g.UserId",
    "activities users",
)
def churn_template(t: Tables):
    out = churn.churn_training_set(t.activities, t.users, CHURN_DAYS)
    ratios = [c for c in out.columns if "perUnique" in c]
    return _plain(out).withColumns({c: F.coalesce(c, F.lit(-1.0)) for c in ratios})


@query("churn_tags", f"WITH {TAGS} SELECT * FROM tags", "activities")
def churn_tags(t: Tables):
    return churn.churn_tags(t.activities, CHURN_DAYS)


@query(
    "count_distinct",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS unique_l_partkey, count(DISTINCT l_orderkey) AS unique_l_orderkey, "
    "count(DISTINCT l_returnflag) AS unique_l_returnflag, count(DISTINCT l_shipdate) AS unique_l_shipdate FROM lineitem GROUP BY 1",
)
def count_distinct(t: Tables):
    return agg.count_distinct(t.lineitem, ["l_suppkey"], ["l_partkey", "l_orderkey", "l_returnflag", "l_shipdate"])


@query(
    "conditional_counts",
    "SELECT datetime, machineID, "
    + ", ".join(f"CAST(sum(CASE WHEN errorID = '{e}' THEN 1 ELSE 0 END) AS BIGINT) AS {e}" for e in ERRORS)
    + " FROM errors GROUP BY 1, 2",
    "errors",
)
def conditional_counts(t: Tables):
    return agg.conditional_counts(t.errors, ["datetime", "machineID"], "errorID", ERRORS)


@query("value_counts", "SELECT comp, count(*) AS n FROM maint GROUP BY 1", "maint")
def value_counts(t: Tables):
    return agg.value_counts(t.maint, "comp")


@query(
    "global_means",
    "SELECT avg(round(o_totalprice * 100)) AS avg_price, avg(o_custkey) AS avg_o_custkey FROM orders",
)
def global_means(t: Tables):
    return agg.global_means(t.orders.withColumn("price", cents("o_totalprice")), ["price", "o_custkey"])


SUMMARY = ["volt", "rotate", "pressure", "vibration"]


@query(
    "column_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, count(*) - count({c}) AS missing, avg({c}) AS mean, "
        f"round(stddev_samp({c}), 6) AS sd, min({c}) AS min, max({c}) AS max FROM telemetry"
        for c in SUMMARY
    ),
    "telemetry",
)
def column_summary(t: Tables):
    return agg.column_summary(t.telemetry, SUMMARY).withColumn("sd", r6("sd"))


@query(
    "grouped_summary",
    "SELECT errorID, count(machineID) AS n, avg(machineID) AS mean, round(stddev_samp(machineID), 6) AS sd, "
    "min(machineID) AS min, max(machineID) AS max FROM errors GROUP BY 1",
    "errors",
)
def grouped_summary(t: Tables):
    return agg.grouped_summary(t.errors, ["errorID"], "machineID").withColumn("sd", r6("sd"))


@query(
    "histogram",
    """SELECT event_type, CASE WHEN value < 0 THEN 0 WHEN value >= 200 THEN 21 ELSE floor(value / 10)::BIGINT + 1 END AS bin,
    count(*) AS n FROM events GROUP BY 1, 2""",
)
def histogram(t: Tables):
    return agg.histogram(t.events, "value", 0, 200, 20, ["event_type"])


CORR = ["l_extendedprice", "l_discount", "l_tax", "l_partkey"]


@query(
    "correlation_with_label",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(abs(corr({c}, l_quantity)), 6) AS correlation FROM lineitem" for c in CORR
    ),
)
def correlation_with_label(t: Tables):
    return agg.correlation_with_label(t.lineitem, CORR, "l_quantity").withColumn("correlation", r6("correlation"))


@query(
    "cube_cells",
    "SELECT Origin, DayOfWeek, avg(ArrDelay) AS mean_ArrDelay, count(ArrDelay) AS n FROM flights GROUP BY 1, 2",
    "flights",
)
def cube_cells(t: Tables):
    return agg.cube_cells(t.flights, ["Origin", "DayOfWeek"], "ArrDelay")


@query(
    "elapsed_by_group",
    "SELECT user_id, (floor(epoch_us(max(ts)) / 1000) - floor(epoch_us(min(ts)) / 1000)) / 1000.0 AS duration FROM events GROUP BY 1",
)
def elapsed_by_group(t: Tables):
    return agg.elapsed_by_group(t.events, ["user_id"], "ts", "ts")


@query(
    "string_agg_group",
    """SELECT c_mktsegment, string_agg(CAST(c_nationkey AS VARCHAR), ',' ORDER BY c_nationkey) AS members,
    min(c_nationkey) AS first_member, max(c_nationkey) AS last_member
    FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer) GROUP BY 1""",
)
def string_agg_group(t: Tables):
    return agg.string_agg_group(t.customer, ["c_mktsegment"], "c_nationkey")


@query("group_members", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def group_members(t: Tables):
    return agg.group_members(t.customer, ["c_nationkey"], "c_mktsegment")


@query(
    "last_record_rate",
    """WITH perf AS (SELECT c_mktsegment AS id, date_trunc('month', o_orderdate)::TIMESTAMP AS perf_date,
        round(count_if(o_orderstatus = 'F') / count(*), 6) AS rate
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    newest AS (SELECT id, max(perf_date) AS d FROM perf GROUP BY 1),
    before AS (SELECT p.id, arg_max(p.rate, p.perf_date) AS last_rate FROM perf p JOIN newest n ON p.id = n.id AND p.perf_date < n.d GROUP BY 1)
    SELECT p.id, last_rate, p.rate AS new_rate, CAST(last_rate > p.rate AS INTEGER) AS rebuild
    FROM perf p JOIN newest n ON p.id = n.id AND p.perf_date = n.d JOIN before b ON p.id = b.id""",
)
def last_record_rate(t: Tables):
    perf = campaign_performance(t)
    newest = perf.groupBy("id").agg(F.max("perf_date").alias("d"))
    marked = perf.join(newest, "id")
    current = marked.filter("perf_date = d").drop("d")
    return agg.last_record_rate(marked.filter("perf_date < d").drop("d"), current, "id", "perf_date", "rate")


def campaign_performance(t: Tables):
    """Share of finished orders per segment and month, as campaign results."""
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("id"))
    month = F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz")
    return t.orders.join(c, "o_custkey").groupBy("id", month.alias("perf_date")).agg(
        r6(F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("rate")
    )
