"""Cut-up windows give what plain windows give, also where one key is hot."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldmark.operators import ordered, windows
from fieldmark.operators.metrics import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one key, equal times, unknown values."""
    draw = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else draw.choice("abc")
        moment = start + timedelta(hours=draw.randrange(24 * 200) // 7 * 7)
        rows.append((key, moment, i, None if draw.random() < 0.3 else float(draw.randrange(100))))
    return spark.createDataFrame(rows, "k STRING, t TIMESTAMP_NTZ, i INT, v DOUBLE")


def plain():
    return Window.partitionBy("k").orderBy("t", "i")


def agree(df, *pairs):
    wrong = df.filter(" or ".join(f"not ({a} <=> {b})" for a, b in pairs)).count()
    assert wrong == 0


def test_positions(skewed):
    out = ordered.positions(skewed, ["k"], ["t", "i"], ordered.clock_cell("t", 3), "pos", "size")
    out = out.withColumn("p", F.row_number().over(plain()) - 1)
    out = out.withColumn("s", F.count(F.lit(1)).over(Window.partitionBy("k")))
    assert out.count() == 3000
    agree(out, ("pos", "p"), ("size", "s"))


def test_sorted_positions(skewed):
    out = ordered.sorted_positions(skewed, ["t", "i"], ["k"]).withColumn("p", F.row_number().over(plain()) - 1)
    assert out.count() == 3000
    agree(out, ("pos", "p"))


@pytest.mark.parametrize("rows", [1, 7, 64, 8192])
def test_over_blocks(skewed, rows):
    placed = ordered.positions(skewed, ["k"], ["t", "i"], ordered.clock_cell("t", 5))
    out = ordered.over_blocks(
        placed,
        ["k"],
        "pos",
        {
            "lag5": lambda w: F.lag("v", 5).over(w),
            "sum4": lambda w: F.sum("v").over(w.rowsBetween(-3, 0)),
            "mid": lambda w: F.count("v").over(w.rowsBetween(-2, 3)),
        },
        before=5,
        after=3,
        rows=rows,
    )
    out = out.withColumns(
        {
            "lag5_": F.lag("v", 5).over(plain()),
            "sum4_": F.sum("v").over(plain().rowsBetween(-3, 0)),
            "mid_": F.count("v").over(plain().rowsBetween(-2, 3)),
        }
    )
    assert out.count() == 3000
    agree(out, ("lag5", "lag5_"), ("sum4", "sum4_"), ("mid", "mid_"))


def test_running_sums_and_last_known(skewed):
    cell = ordered.clock_cell("t", 4)
    out = ordered.running_sums(skewed, ["k"], ["t", "i"], cell, {"run": F.col("v")})
    out = ordered.last_known(out, ["k"], ["t", "i"], cell, {"known": F.col("v")})
    out = out.withColumns(
        {
            "run_": F.coalesce(F.sum("v").over(plain().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)),
            "known_": F.last("v", ignorenulls=True).over(plain().rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    assert out.count() == 3000
    agree(out, ("run", "run_"), ("known", "known_"))


def test_quantiles_with_many_equal_values(skewed):
    got = exact_quantiles(skewed, ["k"], "v", {"q25": 0.25, "q50": 0.5})
    want = skewed.groupBy("k").agg(F.percentile("v", 0.25).alias("w25"), F.percentile("v", 0.5).alias("w50"))
    agree(got.join(want, "k"), ("round(q25, 9)", "round(w25, 9)"), ("q50", "w50"))


@pytest.mark.parametrize("buckets", [1, 4, 7, 5000])
def test_ntile(skewed, buckets):
    out = windows.ntile_buckets(skewed, ["i"], buckets)
    out = out.withColumn("want", F.ntile(buckets).over(Window.orderBy("i")))
    assert out.count() == 3000
    agree(out, ("bucket", "want"))


def test_rows_with_a_null_key_are_kept(spark):
    df = spark.createDataFrame([(None, datetime(2024, 1, 1), 1), ("a", datetime(2024, 1, 1), 2)], "k STRING, t TIMESTAMP_NTZ, i INT")
    out = ordered.positions(df, ["k"], ["t"], ordered.clock_cell("t"))
    assert out.count() == 2
    assert ordered.over_blocks(out, ["k"], "pos", {"b": lambda w: F.lag("i", 1).over(w)}, before=1).count() == 2
