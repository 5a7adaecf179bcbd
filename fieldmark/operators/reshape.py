"""Top rows, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.operators.aggregates import correlation_with_label


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows; Spark keeps n rows per task and never sorts the rest."""
    return df.orderBy(*order).limit(n)


def top_corr_features(df: DataFrame, features: Sequence[str], label: str, n: int = 35) -> DataFrame:
    """The n features with the highest absolute correlation with the label."""
    ranked = correlation_with_label(df, features, label).filter(F.col("correlation").isNotNull())
    return top_n(ranked, [F.desc("correlation"), F.col("feature")], n)


def latest_model(models: DataFrame, name: str, time: str, value: str) -> DataFrame:
    """Newest entry of each model name."""
    return models.groupBy(name).agg(
        F.max(F.struct(time, value)).alias("_last")
    ).select(name, F.col(f"_last.{time}").alias(time), F.col(f"_last.{value}").alias(value))


def best_by_rmse(metrics: DataFrame, metric: str, tie_break: str) -> DataFrame:
    """Row with the least error; the first by `tie_break` among equals."""
    return metrics.orderBy(metric, tie_break).limit(1)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def unpivot_scores(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "product", value: str = "score"
) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def pivot_ranked(
    df: DataFrame, key: str, rank: str, value: str, ranks: int, prefix: str = "Product"
) -> DataFrame:
    """One column per rank.  The ranks are given, so no pass looks for them."""
    picks = [F.max(F.when(F.col(rank) == r, F.col(value))).alias(f"{prefix}{r}") for r in range(1, ranks + 1)]
    return df.groupBy(key).agg(*picks)


def reshape_long(df: DataFrame, keys: Sequence[str], array: str, pos: str = "pos", value: str = "value") -> DataFrame:
    """Array per row to one row per entry, numbered from 0."""
    return df.select(*keys, F.posexplode(array).alias(pos, value))


def bind_metrics(parts: Mapping[str, DataFrame], name: str = "model") -> DataFrame:
    """Stack metric rows, each with the name of its model."""
    return union_all([frame.withColumn(name, F.lit(label)) for label, frame in parts.items()])
