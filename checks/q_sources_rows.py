"""Sources, sinks, projections and row features."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Tables, cents, query, r6
from fieldmark.functions import calendar as cal
from fieldmark.functions import numbers as num
from fieldmark.operators import joins, ordered, rows
from fieldmark.session import work_folder
from fieldmark.sources import tables as src

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query("csv_source", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_source(t: Tables):
    path = work_folder(t.spark, "csv")
    t.customer.write.option("header", True).csv(path)
    return src.csv_source(t.spark, path, CUSTOMER)


@query(
    "table_source",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
)
def table_source(t: Tables):
    where = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return src.table_source(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_totalprice"], where)


@query("strip_quotes", """SELECT event_id, replace(props, '"', '') AS props FROM events""")
def strip_quotes(t: Tables):
    return src.strip_quotes(t.events.select("event_id", "props"))


@query("overwrite_sink", "SELECT s_suppkey, s_acctbal FROM supplier")
def overwrite_sink(t: Tables):
    path = work_folder(t.spark, "overwrite")
    src.overwrite_sink(t.customer.select("c_custkey"), path)
    return src.overwrite_sink(t.supplier.select("s_suppkey", "s_acctbal"), path)


@query(
    "append_sink",
    "SELECT c_custkey AS key, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_acctbal FROM supplier",
)
def append_sink(t: Tables):
    path = work_folder(t.spark, "append")
    src.append_sink(t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance")), path)
    return src.append_sink(
        t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance")), path
    )


@query(
    "write_layout",
    "SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderdate) AS last_date "
    "FROM orders GROUP BY 1",
)
def write_layout(t: Tables):
    path = work_folder(t.spark, "layout")
    stored = src.write_layout(t.orders, path, "zstd", ["o_orderkey"], ["o_orderstatus"], cluster=True)
    return (
        stored.groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderdate").alias("last_date"),
        )
    )


@query(
    "load_many",
    "SELECT 'customer' AS name, count(*) AS n, sum(c_nationkey)::BIGINT AS total FROM customer "
    "UNION ALL SELECT 'supplier', count(*), sum(s_nationkey)::BIGINT FROM supplier",
)
def load_many(t: Tables):
    base = work_folder(t.spark, "many")
    t.customer.write.option("header", True).csv(f"{base}/customer")
    t.supplier.write.option("header", True).csv(f"{base}/supplier")
    schemas = {
        "customer": CUSTOMER,
        "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    }
    loaded = src.load_many(t.spark, {n: f"{base}/{n}" for n in schemas}, schemas)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(f"{n[0]}_nationkey").alias("total")).select(
            F.lit(n).alias("name"), "n", "total"
        )
        for n, df in loaded.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "filter_range",
    "SELECT event_id, ts, value FROM events WHERE event_type = 'click' "
    "AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'",
)
def filter_range(t: Tables):
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05 00:00:00", "2024-01-20 12:00:00"))
    return rows.filter_range(t.events, "ts", start, end, {"event_type": "click"}).select("event_id", "ts", "value")


@query("select_features", "SELECT l_quantity, l_discount, l_tax FROM lineitem")
def select_features(t: Tables):
    names = rows.select_features(t.lineitem, exclude=["l_extendedprice"], pattern="^l_(quantity|ext|disc|tax)")
    return t.lineitem.select(*names)


@query(
    "threshold_flag",
    "SELECT Late, count(*) AS n FROM (SELECT CASE WHEN ArrDelay > 15 THEN 1 ELSE 0 END AS Late FROM flights) GROUP BY 1",
    "flights",
)
def threshold_flag(t: Tables):
    late = num.threshold_flag(F.col("ArrDelay"), 15).alias("Late")
    return t.flights.select(late).groupBy("Late").agg(F.count(F.lit(1)).alias("n"))


@query(
    "truncate_number",
    "SELECT CAST(trunc(CRSDepTime) AS INTEGER) AS CRSDepHour, CAST(trunc(ArrDelay / 4) AS INTEGER) AS quarter, "
    "count(*) AS n FROM flights GROUP BY 1, 2",
    "flights",
)
def truncate_number(t: Tables):
    return (
        t.flights.groupBy(
            num.truncate_number(F.col("CRSDepTime")).alias("CRSDepHour"),
            num.truncate_number(F.col("ArrDelay") / 4).alias("quarter"),
        ).agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "smoothed_ratios",
    "SELECT o_custkey, sum(round(o_totalprice * 100)) / (count(DISTINCT o_orderpriority) + 1) AS ratio "
    "FROM orders GROUP BY 1",
)
def smoothed_ratios(t: Tables):
    return (
        t.orders.groupBy("o_custkey")
        .agg(F.sum(cents("o_totalprice")).alias("total"), F.countDistinct("o_orderpriority").alias("places"))
        .select("o_custkey", num.smoothed_ratio(F.col("total"), F.col("places")).alias("ratio"))
    )


@query(
    "time_floor",
    "SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS quarter, date_trunc('hour', ts) AS hour FROM events",
)
def time_floor(t: Tables):
    return t.events.select(
        "event_id", cal.time_floor(F.col("ts"), 15).alias("quarter"), cal.time_floor(F.col("ts"), 60).alias("hour")
    )


@query(
    "calendar_features",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hourofday, CAST(dayofweek(ts) + 1 AS INTEGER) AS dayinweek,
    CAST(month(ts) AS INTEGER) AS monofyear,
    CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
    CASE WHEN hour(ts) BETWEEN 8 AND 18 THEN 1 ELSE 0 END AS businesstime,
    CASE WHEN hour(ts) BETWEEN 5 AND 8 THEN 1 ELSE 0 END AS ismorning FROM events""",
)
def calendar_features(t: Tables):
    return t.events.select("event_id", *[c.alias(n) for n, c in cal.day_hour_columns(F.col("ts")).items()])


@query(
    "week_features",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(ceil(day(o_orderdate) / 7.0) AS INTEGER) AS weekofmonth,
    CAST(strftime(o_orderdate + to_days(CAST((7 - dayofweek(o_orderdate)) % 7 AS INTEGER)), '%U') AS INTEGER) AS weekofyear
    FROM orders""",
)
def week_features(t: Tables):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in cal.week_columns(F.col("o_orderdate")).items()])


@query(
    "fourier_daily",
    """SELECT region, time, round(t / 365.25, 6) + 0.0 AS linear_trend,
    round(cos(t * 2 * pi() / 365.25) * weekend, 6) + 0.0 AS we_cos1, round(sin(t * 2 * pi() / 365.25) * weekend, 6) + 0.0 AS we_sin1,
    round(cos(t * 2 * pi() / 365.25) * (1 - weekend), 6) + 0.0 AS wd_cos1, round(sin(t * 2 * pi() / 365.25) * (1 - weekend), 6) + 0.0 AS wd_sin1,
    round(cos(t * 4 * pi() / 365.25) * weekend, 6) + 0.0 AS we_cos2, round(sin(t * 4 * pi() / 365.25) * weekend, 6) + 0.0 AS we_sin2,
    round(cos(t * 4 * pi() / 365.25) * (1 - weekend), 6) + 0.0 AS wd_cos2, round(sin(t * 4 * pi() / 365.25) * (1 - weekend), 6) + 0.0 AS wd_sin2
    FROM (SELECT *, floor((row_number() OVER (PARTITION BY region ORDER BY time) - 1) / 96) AS t,
          CASE WHEN dayofweek(time) IN (0, 6) THEN 1 ELSE 0 END AS weekend FROM demand)""",
    "demand",
)
def fourier_daily(t: Tables):
    placed = ordered.positions(t.demand, ["region"], ["time"], ordered.clock_cell("time", 7))
    weekend = cal.day_hour_columns(F.col("time"))["weekend"]
    waves = cal.daily_fourier(F.floor(F.col("pos") / F.lit(96)), weekend)
    return placed.select("region", "time", *[r6(c).alias(n) for n, c in waves.items()])


@query(
    "fourier_weekly",
    """SELECT id1, id2, time, """
    + ", ".join(
        f"round(cos(t * 2 * pi() * {s} / 52), 6) + 0.0 AS cos{s}, round(sin(t * 2 * pi() * {s} / 52), 6) + 0.0 AS sin{s}"
        for s in range(1, 5)
    )
    + " FROM (SELECT *, (row_number() OVER (PARTITION BY id1, id2 ORDER BY time) - 1) % 52 AS t FROM sales)",
    "sales",
)
def fourier_weekly(t: Tables):
    placed = ordered.positions(t.sales, ["id1", "id2"], ["time"], ordered.clock_cell("time", 3650))
    return placed.select("id1", "id2", "time", *[r6(c).alias(n) for n, c in cal.season_fourier(F.col("pos")).items()])


@query(
    "holiday_flags",
    """WITH years AS (SELECT range AS y FROM range(1980, 2040)),
    first_days AS (SELECT y, make_date(y, 11, 1) AS nov1, make_date(y, 9, 1) AS sep1 FROM years),
    holidays AS (
      SELECT 'us_new_year' AS name, make_date(y, 1, 1) AS d FROM years UNION ALL
      SELECT 'us_labor_day', sep1 + CAST((8 - isodow(sep1)) % 7 AS INTEGER) FROM first_days UNION ALL
      SELECT 'us_thanksgiving', nov1 + CAST((11 - isodow(nov1)) % 7 + 21 AS INTEGER) FROM first_days UNION ALL
      SELECT 'cyber_monday', nov1 + CAST((11 - isodow(nov1)) % 7 + 25 AS INTEGER) FROM first_days UNION ALL
      SELECT 'christmas', make_date(y, 12, 25) FROM years),
    days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
    hits AS (SELECT day, name FROM days JOIN holidays
             ON d <= day AND day < d + 7)
    SELECT o.o_orderkey,
      CAST(max(CASE WHEN name = 'us_new_year' THEN 1 ELSE 0 END) AS INTEGER) AS us_new_year, CAST(max(CASE WHEN name = 'us_labor_day' THEN 1 ELSE 0 END) AS INTEGER) AS us_labor_day,
      CAST(max(CASE WHEN name = 'us_thanksgiving' THEN 1 ELSE 0 END) AS INTEGER) AS us_thanksgiving, CAST(max(CASE WHEN name = 'cyber_monday' THEN 1 ELSE 0 END) AS INTEGER) AS cyber_monday,
      CAST(max(CASE WHEN name = 'christmas' THEN 1 ELSE 0 END) AS INTEGER) AS christmas
    FROM orders o LEFT JOIN hits h ON CAST(o.o_orderdate AS DATE) = h.day GROUP BY 1""",
)
def holiday_flags(t: Tables):
    # A holiday moves to the first day of the row's weekday at or after it.
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in cal.holiday_columns(F.col("o_orderdate")).items()])


@query(
    "log_transform",
    "SELECT id1, id2, time, round(ln(value), 6) AS logged, round(exp(ln(value)), 6) AS back FROM sales",
    "sales",
)
def log_transform(t: Tables):
    logged = num.log_value(F.col("value"))
    return t.sales.select("id1", "id2", "time", r6(logged).alias("logged"), r6(num.exp_value(logged)).alias("back"))


@query(
    "interaction_products",
    """SELECT PersonId, round(list_sum(products), 6) + 0.0 AS total, products[1] AS first_product,
    products[66] AS second_row_second, products[4096] AS last_product, CAST(len(products) AS INTEGER) AS n
    FROM (SELECT PersonId, flatten(list_transform(rt, lambda x: list_transform(pt, lambda y: x * y))) AS products
          FROM resumes JOIN projects ON label = ProjectId)""",
    "resumes projects",
)
def interaction_products(t: Tables):
    pairs = t.resumes.join(t.projects, F.col("label") == F.col("ProjectId"))
    products = rows.interaction_products(pairs, "rt", "pt")
    total = F.aggregate("products", F.lit(0.0), lambda a, x: a + x)
    return products.select(
        "PersonId",
        r6(total).alias("total"),
        F.element_at("products", 1).alias("first_product"),
        F.element_at("products", 66).alias("second_row_second"),
        F.element_at("products", -1).alias("last_product"),
        F.size("products").alias("n"),
    )


@query(
    "fill_constant",
    """SELECT c_custkey, coalesce(n, 0) AS n, coalesce(status, 'none') AS status FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n, max(o_orderstatus) AS status FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def fill_constant(t: Tables):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderstatus").alias("status")
    )
    joined = t.customer.select("c_custkey").join(counts, "c_custkey", "left")
    return rows.fill_constant(joined, {"n": 0, "status": "none"})


SPINE = """spine AS (
  SELECT k.id1, k.id2, g.time, s.value FROM (SELECT DISTINCT id1, id2 FROM sales) k,
    (SELECT unnest(generate_series((SELECT min(time) FROM sales), (SELECT max(time) FROM sales), INTERVAL 7 DAY)) AS time) g
    LEFT JOIN sales s ON s.id1 = k.id1 AND s.id2 = k.id2 AND s.time = g.time)"""


@query(
    "fill_mean",
    f"WITH {SPINE} SELECT id1, id2, time, coalesce(value, avg(value) OVER (PARTITION BY id1, id2)) AS value FROM spine",
    "sales",
)
def fill_mean(t: Tables):
    return rows.fill_mean(joins.series_spine(t.sales, ["id1", "id2"], "time"), ["id1", "id2"], "value")


@query("drop_incomplete", f"WITH {SPINE} SELECT * FROM spine WHERE value IS NOT NULL", "sales")
def drop_incomplete(t: Tables):
    return rows.drop_incomplete(joins.series_spine(t.sales, ["id1", "id2"], "time"))


@query(
    "minmax_normalize",
    "WITH b AS (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in ("cycle", "setting1", "s1", "s2", "s3", "s4"))
    + " FROM cycles) SELECT id, cycle AS cycle_orig, "
    + ", ".join(f"({c}::DOUBLE - lo_{c}) / (hi_{c} - lo_{c}) AS {c}" for c in ("cycle", "setting1", "s1", "s2", "s3", "s4"))
    + " FROM cycles, b",
    "cycles",
)
def minmax_normalize(t: Tables):
    # setting3 is constant, so it is dropped.
    columns = ["cycle", "setting1", "setting3", "s1", "s2", "s3", "s4"]
    data = t.cycles.select("id", *columns)
    fit = rows.minmax_fit(data, columns)
    return rows.minmax_apply(data, fit, {"cycle": "cycle_orig"})


@query(
    "factor_levels",
    """SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'MACHINERY' THEN 0 WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 END
    AS DOUBLE) AS c_mktsegment_index FROM customer""",
)
def factor_levels(t: Tables):
    levels = {"c_mktsegment": ["MACHINERY", "AUTOMOBILE", "BUILDING"]}
    return rows.factor_levels(t.customer, levels).select(
        "c_custkey", F.col("c_mktsegment_index").cast("double").alias("c_mktsegment_index")
    )


@query(
    "augment_rows",
    """SELECT page_id, url FROM pages UNION ALL SELECT page_id, regexp_replace(url, '^https?://', 'left://', 'g') FROM pages
    UNION ALL SELECT page_id, regexp_replace(url, '^https?://', 'right://', 'g') FROM pages""",
)
def augment_rows(t: Tables):
    return rows.augment_rows(t.pages.select("page_id", "url"), "url", "^https?://", ["left://", "right://"])


@query(
    "row_id",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_id FROM orders",
)
def row_id(t: Tables):
    return rows.row_id(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]).select(
        "o_orderkey", "row_id"
    )


@query(
    "redate_rows",
    """SELECT event_id, CAST(strftime(ts, '2023-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts FROM events
    WHERE date_trunc('second', ts) <= TIMESTAMP '2024-01-15 12:00:00'
    UNION ALL SELECT event_id, CAST(strftime(ts, '2022-%m-%d %H:%M:%S') AS TIMESTAMP) FROM events
    WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-15 12:00:00'""",
)
def redate_rows(t: Tables):
    seed = t.events.select("event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    return rows.redate_rows(seed, "ts", "2023-06-01 00:00:00", "2024-01-15 12:00:00")


DAYS = {1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday", 5: "Thursday", 6: "Friday", 7: "Saturday"}


@query(
    "relabel_dow",
    "SELECT CASE DayOfWeek "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in DAYS.items())
    + " END AS name, count(*) AS n FROM flights GROUP BY 1",
    "flights",
)
def relabel_dow(t: Tables):
    return t.flights.groupBy(num.relabel(F.col("DayOfWeek"), DAYS).alias("name")).agg(F.count(F.lit(1)).alias("n"))
