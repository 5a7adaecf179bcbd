"""Grouped and whole-table summaries.  All combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.functions.numbers import smoothed_ratio


def whole_mean(total: Column, count: Column) -> Column:
    """Mean cut to a whole number, as an average of whole numbers is there."""
    return F.floor(total / count).cast("bigint")


def customer_features(
    activities: DataFrame, churn_days: int, user: str = "UserId", time: str = "TransactionTime"
) -> DataFrame:
    """Purchase history of each customer before the churn period.

    The mean gap between transactions needs no ordering: day gaps between
    neighbours add up to last day minus first day, so the customer is one
    aggregate group and no series is sorted.
    """
    last = activities.agg(F.max(time).alias("m"))
    cutoff = last.scalar() - F.make_dt_interval(days=F.lit(churn_days))
    day = F.col(time).cast("date")
    return (
        activities.filter(F.col(time) <= cutoff)
        .groupBy(user)
        .agg(
            F.count("TransactionId").alias("_n"),
            F.sum("Quantity").alias("TotalQuantity"),
            F.sum("Val").alias("TotalValue"),
            F.coalesce(F.stddev_samp("Quantity"), F.lit(0.0)).alias("StDevQuantity"),
            F.coalesce(F.stddev_samp("Val"), F.lit(0.0)).alias("StDevValue"),
            F.datediff(F.max(day), F.min(day)).alias("_span"),
            F.max(time).alias("_last"),
            F.countDistinct("TransactionId").alias("UniqueTransactionId"),
            F.countDistinct("ItemId").alias("UniqueItemId"),
            F.countDistinct("Location").alias("UniqueLocation"),
            F.countDistinct("ProductCategory").alias("UniqueProductCategory"),
        )
        .withColumn("AvgTimeDelta", whole_mean(F.col("_span"), F.col("_n")))
        .withColumn("Recency", F.datediff(last.scalar().cast("date"), F.col("_last").cast("date")) - churn_days)
        .drop("_n", "_span", "_last")
    )


def customer_ratios(features: DataFrame) -> DataFrame:
    """Quantity and value per distinct transaction, item, place and category."""
    parts = ("TransactionId", "ItemId", "Location", "ProductCategory")
    return features.withColumns(
        {
            f"Total{what}perUnique{part}": smoothed_ratio(F.col(f"Total{what}"), F.col(f"Unique{part}"))
            for what in ("Quantity", "Value")
            for part in parts
        }
    )


def count_distinct(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], relative_error: float | None = None
) -> DataFrame:
    """Distinct values per group; exact unless an error is allowed."""
    if relative_error is None:
        aggs = [F.countDistinct(c).alias(f"unique_{c}") for c in columns]
    else:
        aggs = [F.approx_count_distinct(c, relative_error).alias(f"unique_{c}") for c in columns]
    return df.groupBy(*keys).agg(*aggs)


def conditional_counts(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence, suffix: str = ""
) -> DataFrame:
    """One count column per declared value."""
    return df.groupBy(*keys).agg(
        *[F.count_if(F.col(column) == F.lit(v)).alias(f"{v}{suffix}") for v in values]
    )


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def global_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(f"avg_{c}") for c in columns])


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, missing, mean, sd, min and max, one row per column."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                (F.count(F.lit(1)) - F.count(c)).alias("missing"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("sd"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(F.inline(F.array(*stats.columns)))


def grouped_summary(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("sd"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def histogram(
    df: DataFrame, column: str, low: float, high: float, bins: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows per equal-width bin; bin 0 is below `low`, bin `bins`+1 from `high` on."""
    bin_of = F.width_bucket(F.col(column), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.groupBy(*keys, bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def correlation_with_label(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Absolute Pearson correlation of every feature, in one pass."""
    row = df.agg(
        *[
            F.struct(F.lit(c).alias("feature"), F.abs(F.corr(c, label)).alias("correlation")).alias(f"c{i}")
            for i, c in enumerate(features)
        ]
    )
    return row.select(F.inline(F.array(*row.columns)))


def cube_cells(df: DataFrame, factors: Sequence[str], value: str) -> DataFrame:
    """Mean and count in each cell of a factor cross."""
    return df.groupBy(*factors).agg(
        F.avg(value).alias(f"mean_{value}"), F.count(value).alias("n")
    )


def elapsed_by_group(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Seconds, counted in milliseconds, from the first start to the last end."""
    def micros(column: Column) -> Column:
        return F.unix_micros(column.cast("timestamp"))

    def millis(column: Column) -> Column:
        return F.floor(micros(column) / F.lit(1000))

    return df.groupBy(*keys).agg(
        ((millis(F.max(end)) - millis(F.min(start))) / F.lit(1000.0)).alias("duration")
    )


def group_members(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """One row per group and distinct member: the list of `string_agg_group` for groups of any size."""
    return df.select(*keys, member).distinct()


def string_agg_group(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Sorted comma list, minimum and maximum of the distinct members per group.

    Equal members are merged before the lists are built.  A list is one cell of
    the result, so this is for groups whose member list is meant to be read;
    `group_members` has the same members as rows.
    """
    members = group_members(df, keys, member)
    return members.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list(member)).cast("array<string>"), ",").alias("members"),
        F.min(member).alias("first_member"),
        F.max(member).alias("last_member"),
    )


def last_record_rate(
    history: DataFrame, current: DataFrame, key: str, time: str, rate: str
) -> DataFrame:
    """Rate of the last record next to the new one; `rebuild` if it went down."""
    last = history.groupBy(key).agg(F.max(F.struct(time, rate)).alias("_last"))
    joined = current.join(last, key, "left")
    last_rate = F.coalesce(F.col(f"_last.{rate}"), F.lit(0.0))
    return joined.select(
        key,
        last_rate.alias("last_rate"),
        F.col(rate).alias("new_rate"),
        (last_rate > F.col(rate)).cast("int").alias("rebuild"),
    )
