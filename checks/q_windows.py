"""Lags, rolling statistics, positions and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import CTE, ERRORS, Tables, query, r6
from checks.q_joins import HOURLY_ERRORS, GRID15
from checks.q_sources_rows import SPINE
from fieldmark.operators import aggregates, joins, ordered, windows
from fieldmark.operators.rows import fill_mean
from fieldmark.plans import energy, maintenance
from fieldmark.session import stored

ROW_LAGS = energy.LOAD_LAGS
SENSORS = maintenance.SENSORS


def grid15(t: Tables):
    """Demand of every region on the full 15-minute grid, with its position."""
    regions = t.demand.select("region").distinct()
    grid = joins.time_grid(regions, *joins.time_span(t.demand, "time"), 900, pos="pos")
    return joins.spine_join(grid, t.demand, ["region"], "time")


def weekly(t: Tables):
    """Sales of every series on the full weekly grid, with position."""
    return joins.series_spine(t.sales, ["id1", "id2"], "time", 7, "pos")


@query(
    "lag_interval",
    "SELECT TransactionId, UserId, coalesce(date_diff('day', lag(TransactionTime) OVER (PARTITION BY UserId "
    "ORDER BY TransactionTime, TransactionId), TransactionTime), 0) AS interval FROM activities",
    "activities",
)
def lag_interval(t: Tables):
    out = windows.lag_interval(t.activities, "UserId", "TransactionTime", "TransactionId")
    return out.select("TransactionId", "UserId", F.col("interval").cast("bigint").alias("interval"))


def _rolled(kind: str, n: int, nulls: bool = False) -> str:
    parts = ", ".join(
        f"{'round(' if kind == 'stddev_samp' else ''}{kind}({s}) OVER w{', 6)' if kind == 'stddev_samp' else ''} AS {s}"
        for s in SENSORS
    )
    where = " WHERE volt IS NOT NULL" if nulls else ""
    return (
        f"SELECT * FROM (SELECT machineID, datetime, {parts} FROM telemetry "
        f"WINDOW w AS (PARTITION BY machineID ORDER BY datetime ROWS {n} PRECEDING)){where}"
    )


def _stat(t: Tables, function, n: int):
    out = function(t.placed_telemetry, ["machineID"], "pos", {f"_{s}": s for s in SENSORS}, n)
    return out.select("machineID", "datetime", *[F.col(f"_{s}").alias(s) for s in SENSORS])


@query("rolling_mean", _rolled("avg", 2), "telemetry")
def rolling_mean(t: Tables):
    return _stat(t, windows.rolling_mean, 2)


@query("rolling_mean_24", _rolled("avg", 23), "telemetry")
def rolling_mean_24(t: Tables):
    return _stat(t, windows.rolling_mean, 23)


@query("rolling_stdev", _rolled("stddev_samp", 2, nulls=True), "telemetry")
def rolling_stdev(t: Tables):
    return _stat(t, windows.rolling_stdev, 2).withColumns({s: r6(s) for s in SENSORS})


@query("rolling_stdev_24", _rolled("stddev_samp", 23, nulls=True), "telemetry")
def rolling_stdev_24(t: Tables):
    return _stat(t, windows.rolling_stdev, 23).withColumns({s: r6(s) for s in SENSORS})


@query(
    "every_nth_row",
    "SELECT machineID, datetime, volt FROM (SELECT *, row_number() OVER (PARTITION BY machineID ORDER BY datetime) AS rn "
    "FROM telemetry) WHERE rn % 3 = 0",
    "telemetry",
)
def every_nth_row(t: Tables):
    return windows.every_nth_row(t.placed_telemetry, "pos", 3).select("machineID", "datetime", "volt")


@query(
    "rolling_counts",
    f"WITH {HOURLY_ERRORS} SELECT machineID, datetime, "
    + ", ".join(f"CAST(sum({e}) OVER w AS BIGINT) AS {e}count" for e in ERRORS)
    + " FROM filled WINDOW w AS (PARTITION BY machineID ORDER BY datetime ROWS 23 PRECEDING)",
    "telemetry errors",
)
def rolling_counts(t: Tables):
    keys = ["machineID", "datetime"]
    counts = aggregates.conditional_counts(t.errors, keys, "errorID", ERRORS)
    filled = joins.left_join_fill(t.placed_telemetry, counts, keys, {e: 0 for e in ERRORS})
    out = windows.rolling_counts(filled, ["machineID"], "pos", {f"{e}count": e for e in ERRORS})
    return out.select(*keys, *[f"{e}count" for e in ERRORS])


@query(
    "rolling_partial",
    "SELECT id, cycle, "
    + ", ".join(
        f"avg(s{i}) OVER w AS a{i}, round(coalesce(stddev_samp(s{i}) OVER w, 0), 4) AS sd{i}" for i in range(1, 5)
    )
    + " FROM cycles WINDOW w AS (PARTITION BY id ORDER BY cycle ROWS 4 PRECEDING)",
    "cycles",
)
def rolling_partial(t: Tables):
    out = windows.rolling_partial(t.cycles, ["id"], "pos", ["s1", "s2", "s3", "s4"])
    return out.select("id", "cycle", *[f"a{i}" for i in range(1, 5)], *[r6(f"sd{i}", 4).alias(f"sd{i}") for i in range(1, 5)])


@query(
    "multi_lag",
    f"WITH grid AS ({GRID15}) SELECT region, time, load, "
    + ", ".join(f"lag(load, {n}) OVER w AS lag{n}" for n in ROW_LAGS)
    + " FROM grid WINDOW w AS (PARTITION BY region ORDER BY time)",
    "demand",
)
def multi_lag(t: Tables):
    return windows.multi_lag(grid15(t), ["region"], "pos", "load", ROW_LAGS).drop("pos")


@query(
    "fill_from_lag",
    f"""WITH grid AS ({GRID15}) SELECT region, time, coalesce(load, lag(load, 96) OVER (PARTITION BY region ORDER BY time),
    avg(load) OVER (PARTITION BY region)) AS load FROM grid""",
    "demand",
)
def fill_from_lag(t: Tables):
    return windows.fill_from_lag(grid15(t), ["region"], "pos", ["load"], 96).drop("pos")


@query(
    "fill_from_lag_recursive",
    f"""WITH RECURSIVE {CTE['demand']}, grid AS MATERIALIZED (SELECT region, time, load, row_number() OVER (PARTITION BY region ORDER BY time) - 1 AS pos FROM ({GRID15})),
    walk AS (SELECT region, time, pos, load FROM grid WHERE pos < 24
      UNION ALL SELECT g.region, g.time, g.pos, coalesce(g.load, w.load) FROM walk w JOIN grid g ON g.region = w.region AND g.pos = w.pos + 24)
    SELECT region, time, load FROM walk""",
)
def fill_from_lag_recursive(t: Tables):
    return windows.fill_from_lag_recursive(grid15(t), ["region"], "pos", ["load"], 24, rows=8).drop("pos")


@query(
    "series_position",
    "SELECT id1, id2, time, row_number() OVER (PARTITION BY id1, id2 ORDER BY time) - 1 AS pos FROM sales",
    "sales",
)
def series_position(t: Tables):
    cell = ordered.clock_cell("time", 364)
    return windows.series_position(t.sales, ["id1", "id2"], ["time"], cell).select("id1", "id2", "time", "pos")


LABELS = """CASE WHEN RUL <= 30 THEN 1 ELSE 0 END AS label1,
  CASE WHEN RUL <= 15 THEN 2 WHEN RUL <= 30 THEN 1 ELSE 0 END AS label2"""


@query(
    "rul_label",
    f"SELECT id, cycle, RUL, {LABELS} FROM (SELECT id, cycle, max(cycle) OVER (PARTITION BY id) - cycle AS RUL FROM cycles)",
    "cycles",
)
def rul_label(t: Tables):
    return windows.rul_label(t.cycles.select("id", "cycle"), "id", "cycle")


@query(
    "rul_label_truth",
    f"""SELECT id, cycle, RUL, {LABELS} FROM (SELECT id, cycle, max(cycle) OVER (PARTITION BY id) + s_suppkey % 40 - cycle AS RUL
    FROM cycles JOIN supplier ON s_suppkey + 1 = id)""",
    "cycles",
)
def rul_label_truth(t: Tables):
    truth = t.truth.select((F.col("s_suppkey") + 1).alias("id"), "RUL")
    return windows.rul_label(t.cycles.select("id", "cycle"), "id", "cycle", truth)


@query(
    "last_cycle",
    "SELECT id, cycle, s1, s2 FROM (SELECT *, max(cycle) OVER (PARTITION BY id) AS m FROM cycles) WHERE cycle = m",
    "cycles",
)
def last_cycle(t: Tables):
    return windows.last_cycle(t.cycles.select("id", "cycle", "s1", "s2"), "id", "cycle")


BRAND_SCORE = "(round(sum(l_quantity)) % 97)"


@query(
    "rank_products",
    f"""SELECT o_custkey, p_brand, score, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, p_brand) AS INTEGER) AS rank
    FROM (SELECT o_custkey, p_brand, {BRAND_SCORE} AS score FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",
)
def rank_products(t: Tables):
    return windows.rank_products(brand_scores(t), "o_custkey", "p_brand", "score")


def brand_scores(t: Tables):
    li, p, o = t.lineitem, t.part, t.orders
    joined = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
    return joined.groupBy("o_custkey", "p_brand").agg((F.round(F.sum("l_quantity")) % 97).alias("score"))


@query(
    "ntile_buckets",
    """SELECT bucket, min(c_custkey) AS min_c_custkey, max(c_custkey) AS max_c_custkey, count(*) AS n FROM
    (SELECT c_custkey, CAST(ntile(7) OVER (ORDER BY c_acctbal, c_custkey) AS INTEGER) AS bucket FROM customer) GROUP BY 1""",
)
def ntile_buckets(t: Tables):
    bucketed = windows.ntile_buckets(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], 7)
    return windows.bucket_bounds(bucketed, "bucket", "c_custkey")


LAGS, HORIZON = 26, 4
LAG_COLUMNS = ", ".join(
    f"CASE horizon {' '.join(f'WHEN {h} THEN p{n + h - 1}' for h in range(1, HORIZON + 1))} END AS lag{n}"
    for n in range(1, LAGS + 1)
)


@query(
    "lag_by_horizon",
    f"""WITH {SPINE}, filled AS (SELECT id1, id2, time, coalesce(value, avg(value) OVER (PARTITION BY id1, id2)) AS value FROM spine),
    past AS (SELECT *, {", ".join(f"lag(value, {n}) OVER w AS p{n}" for n in range(1, LAGS + HORIZON))} FROM filled
      WINDOW w AS (PARTITION BY id1, id2 ORDER BY time)),
    wide AS (SELECT id1, id2, time, value, horizon, {LAG_COLUMNS} FROM past, (SELECT unnest([1, 2, 3, 4]) AS horizon))
    SELECT id1, id2, horizon, count(*) AS n, """
    + ", ".join(f"round(sum(lag{n}), 2) AS lag{n}" for n in range(1, LAGS + 1))
    + f" FROM wide WHERE lag{LAGS} IS NOT NULL GROUP BY 1, 2, 3",
    "sales",
)
def lag_by_horizon(t: Tables):
    filled = fill_mean(stored(weekly(t), "weekly"), ["id1", "id2"], "value")
    out = windows.lag_by_horizon(filled, ["id1", "id2"], "pos", "value", LAGS, HORIZON)
    return out.groupBy("id1", "id2", "horizon").agg(
        F.count(F.lit(1)).alias("n"), *[r6(F.sum(f"lag{n}"), 2).alias(f"lag{n}") for n in range(1, LAGS + 1)]
    )


TEST_ROWS = 4
SPLIT = f"""{SPINE}, placed AS (SELECT *, row_number() OVER (PARTITION BY id1, id2 ORDER BY time) - 1 AS pos,
  count(*) OVER (PARTITION BY id1, id2) AS size FROM spine),
  train AS (SELECT * FROM placed WHERE pos < size - {TEST_ROWS}), test AS (SELECT * FROM placed WHERE pos >= size - {TEST_ROWS}),
  ends AS (SELECT id1, id2, max(pos) AS e, avg(value) AS m FROM train GROUP BY 1, 2)"""


def train_test(t: Tables):
    """Weekly grid cut into training rows and the last rows."""
    data = stored(weekly(t), "weekly")
    steps = data.agg(F.max("pos").alias("m")).scalar() - TEST_ROWS
    return data.filter(F.col("pos") <= steps), data.filter(F.col("pos") > steps)


@query(
    "test_lags",
    f"""WITH {SPLIT}, picked AS (SELECT id1, id2, max(e) AS e, """
    + ", ".join(f"max(CASE WHEN pos = e - {n - 1} THEN coalesce(value, m) END) AS lag{n}" for n in range(1, LAGS + 1))
    + """ FROM train JOIN ends USING (id1, id2) GROUP BY 1, 2)
    SELECT id1, id2, pos, CAST(pos - e AS INTEGER) AS horizon, """
    + ", ".join(f"lag{n}" for n in range(1, LAGS + 1))
    + """ FROM test JOIN picked USING (id1, id2)""",
    "sales",
)
def test_lags(t: Tables):
    train, test = train_test(t)
    out = windows.test_lags(train, test, ["id1", "id2"], "pos", "value", LAGS)
    return out.select("id1", "id2", "pos", "horizon", *[f"lag{n}" for n in range(1, LAGS + 1)])


@query(
    "centered_ma",
    f"""WITH {SPINE}, filled AS (SELECT id1, id2, time, coalesce(value, 0) AS value FROM spine)
    SELECT id1, id2, time, CASE WHEN count(*) OVER w = 52 THEN avg(value) OVER w END AS ma FROM filled
    WINDOW w AS (PARTITION BY id1, id2 ORDER BY time ROWS BETWEEN 25 PRECEDING AND 26 FOLLOWING)""",
    "sales",
)
def centered_ma(t: Tables):
    filled = weekly(t).fillna(0.0, subset=["value"])
    return windows.centered_ma(filled, ["id1", "id2"], "pos", "value").select("id1", "id2", "time", "ma")


OFFSETS = 20


@query(
    "best_index_lag",
    f"""WITH idx AS (SELECT date_diff('day', (SELECT min(time) FROM sales), time) // 7 AS p, value AS x FROM income),
    s AS (SELECT id2, date_diff('day', (SELECT min(time) FROM sales), time) // 7 AS p, sum(value) AS y FROM sales GROUP BY 1, 2),
    scores AS (SELECT id2, o AS "offset", corr(y, x) AS c FROM s, (SELECT unnest(range({OFFSETS})) AS o), idx WHERE idx.p = s.p + o GROUP BY 1, 2)
    SELECT id2, CAST(arg_max("offset", (abs(c), -"offset")) AS INTEGER) AS "offset", round(arg_max(c, (abs(c), -"offset")), 6) AS correlation
    FROM scores WHERE c IS NOT NULL GROUP BY 1""",
    "sales income",
)
def best_index_lag(t: Tables):
    start = t.sales.agg(F.min("time").alias("m")).scalar()
    def week(column):
        return F.floor(F.datediff(F.col(column).cast("date"), start.cast("date")) / F.lit(7))

    series = t.sales.groupBy("id2", week("time").alias("pos")).agg(F.sum("value").alias("value"))
    index = t.income.select(week("time").alias("index_pos"), F.col("value").alias("index_value"))
    out = windows.best_index_lag(series, index, ["id2"], "pos", "value", "index_pos", "index_value", OFFSETS)
    return out.withColumn("correlation", r6("correlation"))
