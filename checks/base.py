"""Check queries: one Spark query per operator, with SQL for the same result.

`Tables` gives the driver tables and the frames derived from them; `CTE` holds
the same derivations as SQL.  All of them read whole tables.  Money and event
values are taken in whole hundredths, so that sums do not depend on the order
in which an engine adds them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmark.functions.calendar import hour_start, time_floor, week_start
from fieldmark.operators.ordered import clock_cell, positions
from fieldmark.plans.maintenance import COMPONENTS, ERRORS
from fieldmark.session import measured, stored

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BRANDS = [f"Brand#{i}" for i in range(1, 26)]
CHURN_DAYS = 365


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100)


def r6(column: Column | str, digits: int = 6) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        raise AttributeError(name)

    @cached_property
    def activities(self) -> DataFrame:
        lines = self.lineitem.groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("ItemId"), F.sum("l_quantity").alias("Quantity")
        )
        o = self.orders
        return o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select(
            F.col("o_custkey").alias("UserId"),
            F.col("o_orderkey").alias("TransactionId"),
            F.col("o_orderdate").alias("TransactionTime"),
            "ItemId",
            "Quantity",
            cents("o_totalprice").alias("Val"),
            F.col("o_orderpriority").alias("Location"),
            F.col("o_orderstatus").alias("ProductCategory"),
        )

    @cached_property
    def users(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("UserId"),
            (F.col("c_nationkey") + 20).cast("string").alias("Age"),
            F.col("c_nationkey").cast("string").alias("Address"),
            F.when(F.col("c_acctbal") < 0, "F").otherwise("M").alias("Gender"),
            F.col("c_mktsegment").alias("UserType"),
        )

    @cached_property
    def telemetry(self) -> DataFrame:
        return self.events.groupBy(
            F.col("user_id").alias("machineID"), hour_start(F.col("ts")).alias("datetime")
        ).agg(
            F.sum(cents("value")).alias("volt"),
            F.max(cents("value")).alias("rotate"),
            F.min(cents("value")).alias("pressure"),
            F.count(F.lit(1)).cast("double").alias("vibration"),
        )

    @cached_property
    def placed_telemetry(self) -> DataFrame:
        return positions(self.telemetry, ["machineID"], ["datetime"], clock_cell("datetime"), "pos")

    def _kind(self, event: str, name: str, values: list[str]) -> DataFrame:
        code = F.col("event_id") % len(values)
        return self.events.filter(F.col("event_type") == event).select(
            hour_start(F.col("ts")).alias("datetime"),
            F.col("user_id").alias("machineID"),
            F.concat(F.lit(values[0][:-1]), (code + 1).cast("string")).alias(name),
        )

    @cached_property
    def errors(self) -> DataFrame:
        return self._kind("error", "errorID", ERRORS)

    @cached_property
    def maint(self) -> DataFrame:
        return self._kind("signup", "comp", COMPONENTS)

    @cached_property
    def failures(self) -> DataFrame:
        return self._kind("purchase", "failure", COMPONENTS)

    @cached_property
    def machines(self) -> DataFrame:
        return self.events.select(F.col("user_id").alias("machineID")).distinct().select(
            "machineID",
            F.concat(F.lit("model"), (F.col("machineID") % 4 + 1).cast("string")).alias("model"),
            (F.col("machineID") % 20).cast("double").alias("age"),
        )

    @cached_property
    def demand(self) -> DataFrame:
        return self.events.groupBy(
            (F.col("user_id") % 4 + 101).alias("region"), time_floor(F.col("ts"), 15).alias("time")
        ).agg(F.sum(cents("value")).alias("load"))

    @cached_property
    def temperature(self) -> DataFrame:
        return (
            self.events.filter(F.col("event_type") == "view")
            .groupBy((F.col("user_id") % 4 + 101).alias("region"), hour_start(F.col("ts")).alias("time"))
            .agg(F.avg(cents("value")).alias("temperature"))
        )

    @cached_property
    def cycles(self) -> DataFrame:
        daily = self.lineitem.groupBy((F.col("l_suppkey") + 1).alias("id"), "l_shipdate").agg(
            F.count(F.lit(1)).cast("double").alias("setting1"),
            F.max("l_quantity").alias("setting2"),
            F.lit(100.0).alias("setting3"),
            F.sum("l_quantity").alias("s1"),
            F.sum(cents("l_extendedprice")).alias("s2"),
            F.sum(cents("l_discount")).alias("s3"),
            F.sum(cents("l_tax")).alias("s4"),
        )
        # Read for the counts and for the rows.
        daily = stored(daily, "daily")
        placed = positions(daily, ["id"], ["l_shipdate"], clock_cell("l_shipdate", 3650), "pos")
        return placed.withColumn("cycle", F.col("pos") + 1).drop("l_shipdate")

    @cached_property
    def truth(self) -> DataFrame:
        return self.supplier.select("s_suppkey", (F.col("s_suppkey") % 40).alias("RUL"))

    @cached_property
    def sales(self) -> DataFrame:
        return self.lineitem.groupBy(
            F.col("l_suppkey").alias("id1"),
            F.col("l_returnflag").alias("id2"),
            week_start(F.col("l_shipdate")).alias("time"),
        ).agg(F.sum("l_quantity").alias("value"))

    @cached_property
    def income(self) -> DataFrame:
        return self.orders.groupBy(week_start(F.col("o_orderdate")).alias("time")).agg(
            F.avg(cents("o_totalprice")).alias("value")
        )

    @cached_property
    def bought(self) -> DataFrame:
        """(customer, brand) pairs that were bought at least once."""
        o, li, p = self.orders, self.lineitem, self.part
        return (
            li.join(p, li.l_partkey == p.p_partkey)
            .join(o, li.l_orderkey == o.o_orderkey)
            .select("o_custkey", "p_brand")
            .distinct()
        )

    @cached_property
    def purchases(self) -> DataFrame:
        flags = [F.max(F.when(F.col("p_brand") == b, 1).otherwise(0)).alias(f"b{i}") for i, b in enumerate(BRANDS, 1)]
        return self.bought.groupBy(F.col("o_custkey").alias("cust_id")).agg(*flags)

    @cached_property
    def campaign(self) -> DataFrame:
        history = self.orders.groupBy(F.col("o_custkey").alias("cust_id")).agg(
            F.avg(cents("o_totalprice")).alias("avg_purch"),
            F.max(cents("o_totalprice")).alias("max_purch"),
            F.count(F.lit(1)).cast("double").alias("num_purch"),
        )
        response = self.customer.select(
            F.col("c_custkey").alias("cust_id"), (F.col("c_acctbal") > 5000).cast("int").alias("response")
        )
        return history.join(response, "cust_id")

    @cached_property
    def flights(self) -> DataFrame:
        return self.lineitem.select(
            (F.col("l_quantity") - 15).alias("ArrDelay"),
            (cents("l_extendedprice") % 2400 / 100).alias("CRSDepTime"),
            F.dayofweek("l_shipdate").alias("DayOfWeek"),
            F.col("l_returnflag").alias("Origin"),
            F.col("l_linestatus").alias("Dest"),
        )

    @cached_property
    def resumes(self) -> DataFrame:
        return self.embeddings.select(
            F.col("vec_id").alias("PersonId"), F.col("embedding").cast("array<double>").alias("rt"), "label"
        )

    @cached_property
    def projects(self) -> DataFrame:
        """One project per label: the topics of its first vector."""
        first = F.min_by("embedding", "vec_id").cast("array<double>").alias("pt")
        return measured(self.embeddings.groupBy(F.col("label").alias("ProjectId")).agg(first))

    @cached_property
    def pairs(self) -> DataFrame:
        """Labelled fact: each person with each project there is; projects are as few as labels."""
        number = F.explode(self.embeddings.agg(F.collect_set("label").alias("all")).scalar()).alias("ProjectId")
        return self.resumes.select("PersonId", "label", number).select(
            "PersonId", "ProjectId", (F.col("label") == F.col("ProjectId")).cast("int").alias("match")
        )

    @cached_property
    def forecast_rows(self) -> DataFrame:
        """Week values with two simple forecasts, for the metrics."""
        sales = self.sales
        return sales.select(
            "id1",
            "id2",
            F.floor(F.unix_date(F.col("time").cast("date")) / F.lit(7)).alias("pos"),
            "value",
            (F.col("id1") % 50 + 10).cast("double").alias("f_flat"),
            (F.col("value") * 2 - F.dayofyear("time") % 30).alias("f_wave"),
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Labelled rows with a score between 0 and 1."""
        return self.orders.select(
            "o_orderkey",
            (F.col("o_orderstatus") == "F").cast("int").alias("label"),
            (cents("o_totalprice") % 1000 / 1000).alias("score"),
        )

    @cached_property
    def classified(self) -> DataFrame:
        """Observed and predicted class, 0..2."""
        return self.lineitem.select(
            (F.col("l_quantity") % 3).cast("int").alias("observed"),
            (cents("l_extendedprice") % 3).cast("int").alias("predicted"),
        )


CTE = {
    "activities": """activities AS (
  SELECT o.o_custkey AS UserId, o.o_orderkey AS TransactionId, o.o_orderdate AS TransactionTime,
         li.ItemId, li.Quantity, round(o.o_totalprice * 100) AS Val,
         o.o_orderpriority AS Location, o.o_orderstatus AS ProductCategory
  FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS ItemId, sum(l_quantity) AS Quantity
                           FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey)""",
    "users": """users AS (
  SELECT c_custkey AS UserId, CAST(c_nationkey + 20 AS VARCHAR) AS Age, CAST(c_nationkey AS VARCHAR) AS Address,
         CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'M' END AS Gender, c_mktsegment AS UserType FROM customer)""",
    "telemetry": """telemetry AS (
  SELECT user_id AS machineID, date_trunc('hour', ts) AS datetime, sum(round(value * 100)) AS volt,
         max(round(value * 100)) AS rotate, min(round(value * 100)) AS pressure,
         CAST(count(*) AS DOUBLE) AS vibration
  FROM events GROUP BY 1, 2)""",
    "errors": """errors AS (
  SELECT date_trunc('hour', ts) AS datetime, user_id AS machineID,
         'error' || CAST(event_id % 5 + 1 AS VARCHAR) AS errorID FROM events WHERE event_type = 'error')""",
    "maint": """maint AS (
  SELECT date_trunc('hour', ts) AS datetime, user_id AS machineID,
         'comp' || CAST(event_id % 4 + 1 AS VARCHAR) AS comp FROM events WHERE event_type = 'signup')""",
    "failures": """failures AS (
  SELECT date_trunc('hour', ts) AS datetime, user_id AS machineID,
         'comp' || CAST(event_id % 4 + 1 AS VARCHAR) AS failure FROM events WHERE event_type = 'purchase')""",
    "machines": """machines AS (
  SELECT DISTINCT user_id AS machineID, 'model' || CAST(user_id % 4 + 1 AS VARCHAR) AS model,
         CAST(user_id % 20 AS DOUBLE) AS age FROM events)""",
    "demand": """demand AS (
  SELECT user_id % 4 + 101 AS region, time_bucket(INTERVAL '15 minutes', ts) AS time,
         sum(round(value * 100)) AS load FROM events GROUP BY 1, 2)""",
    "temperature": """temperature AS (
  SELECT user_id % 4 + 101 AS region, date_trunc('hour', ts) AS time, avg(round(value * 100)) AS temperature
  FROM events WHERE event_type = 'view' GROUP BY 1, 2)""",
    "cycles": """cycles AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY l_shipdate) AS cycle FROM (
    SELECT l_suppkey + 1 AS id, l_shipdate, CAST(count(*) AS DOUBLE) AS setting1, max(l_quantity) AS setting2,
           100.0::DOUBLE AS setting3, sum(l_quantity) AS s1, sum(round(l_extendedprice * 100)) AS s2,
           sum(round(l_discount * 100)) AS s3, sum(round(l_tax * 100)) AS s4
    FROM lineitem GROUP BY 1, 2))""",
    "sales": """sales AS (
  SELECT l_suppkey AS id1, l_returnflag AS id2, CAST(date_trunc('week', l_shipdate) AS TIMESTAMP) AS time,
         sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3)""",
    "income": """income AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS time, avg(round(o_totalprice * 100)) AS value
  FROM orders GROUP BY 1)""",
    "bought": """bought AS (
  SELECT DISTINCT o_custkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey)""",
    "purchases": "purchases AS (SELECT o_custkey AS cust_id, "
    + ", ".join(f"max(CASE WHEN p_brand = '{b}' THEN 1 ELSE 0 END) AS b{i}" for i, b in enumerate(BRANDS, 1))
    + " FROM bought GROUP BY o_custkey)",
    "campaign": """campaign AS (
  SELECT h.*, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS response FROM (
    SELECT o_custkey AS cust_id, avg(round(o_totalprice * 100)) AS avg_purch, max(round(o_totalprice * 100)) AS max_purch,
           CAST(count(*) AS DOUBLE) AS num_purch FROM orders GROUP BY 1) h JOIN customer ON cust_id = c_custkey)""",
    "flights": """flights AS (
  SELECT l_quantity - 15 AS ArrDelay, round(l_extendedprice * 100) % 2400 / 100 AS CRSDepTime,
         CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS DayOfWeek, l_returnflag AS Origin, l_linestatus AS Dest
  FROM lineitem)""",
    "resumes": """resumes AS (
  SELECT vec_id AS PersonId, CAST(embedding AS DOUBLE[]) AS rt, label FROM embeddings)""",
    "projects": """projects AS (
  SELECT label AS ProjectId, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS pt FROM embeddings GROUP BY label)""",
    "forecast_rows": """forecast_rows AS (
  SELECT id1, id2, CAST(floor(date_diff('day', DATE '1970-01-01', CAST(time AS DATE)) / 7) AS BIGINT) AS pos, value,
         CAST(id1 % 50 + 10 AS DOUBLE) AS f_flat, value * 2 - dayofyear(time) % 30 AS f_wave FROM sales)""",
    "scored": """scored AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
         round(o_totalprice * 100) % 1000 / 1000 AS score FROM orders)""",
    "classified": """classified AS (
  SELECT CAST(l_quantity % 3 AS INTEGER) AS observed, CAST(round(l_extendedprice * 100) % 3 AS INTEGER) AS predicted
  FROM lineitem)""",
}


# Parts a derived frame is built from.
NEEDS = {"purchases": ["bought"], "forecast_rows": ["sales"]}


def sql_with(names: str, body: str) -> str:
    """SQL with the derived frames it uses in front."""
    wanted: list[str] = []
    for name in names.split():
        for part in [*NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    head = "WITH " + ",\n".join(CTE[name] for name in wanted)
    body = body.strip()
    return f"{head},\n{body[5:].strip()}" if body[:5].upper() == "WITH " else f"{head}\n{body}"


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register a query and, where SQL can say it, the SQL of the same result."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql:
            ORACLE[name] = sql_with(uses, sql) if uses else sql.strip()
        return function

    return register
