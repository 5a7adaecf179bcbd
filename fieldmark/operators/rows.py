"""Projections, filters and row-level features."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.functions.numbers import factor_index, outer_product
from fieldmark.operators.ordered import sorted_positions
from fieldmark.session import measured


def filter_range(df: DataFrame, time: str, start, end, equal: Mapping[str, object] | None = None) -> DataFrame:
    """Rows with time in [start, end] and the given column values."""
    condition = F.col(time).between(start, end)
    for name, value in (equal or {}).items():
        condition = condition & (F.col(name) == F.lit(value))
    return df.filter(condition)


def select_features(df: DataFrame, exclude: Sequence[str] = (), pattern: str | None = None) -> list[str]:
    """Names of the feature columns, by a list to leave out or a name pattern."""
    names = [c for c in df.columns if c not in set(exclude)]
    return [c for c in names if re.search(pattern, c)] if pattern else names


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fill_mean(df: DataFrame, keys: Sequence[str], value: str, known: Column | None = None) -> DataFrame:
    """NULL becomes the mean of the known (training) values of the series.

    The mean comes from a grouped aggregate, which combines on the map side,
    and not from a window over the whole series.
    """
    source = F.col(value) if known is None else F.when(known, F.col(value))
    means = measured(df.groupBy(*keys).agg(F.avg(source).alias("_mean")))
    return (
        df.join(means, list(keys), "left")
        .withColumn(value, F.coalesce(F.col(value).cast("double"), F.col("_mean")))
        .drop("_mean")
    )


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


@dataclass(frozen=True)
class MinMax:
    """Training bounds; columns that carry no information are in `dropped`."""

    bounds: dict[str, tuple[float, float]]
    dropped: tuple[str, ...]


def minmax_fit(train: DataFrame, columns: Sequence[str]) -> MinMax:
    """Min and max per column in one pass.  One row comes to the driver."""
    row = train.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
        *[F.count(c).alias(f"n_{c}") for c in columns],
    ).first()
    bounds, dropped = {}, []
    for c in columns:
        low, high = row[f"lo_{c}"], row[f"hi_{c}"]
        if low is None or low == high or row[f"n_{c}"] < row["_rows"]:
            dropped.append(c)
        else:
            bounds[c] = (low, high)
    return MinMax(bounds, tuple(dropped))


def minmax_apply(df: DataFrame, fit: MinMax, keep_original: Mapping[str, str] | None = None) -> DataFrame:
    """(x - min) / (max - min) with the training bounds; useless columns go."""
    out = df.withColumns({copy: F.col(c) for c, copy in (keep_original or {}).items()})
    out = out.withColumns(
        {
            c: (F.col(c).cast("double") - F.lit(low)) / F.lit(high - low)
            for c, (low, high) in fit.bounds.items()
        }
    )
    return out.drop(*fit.dropped)


def factor_levels(df: DataFrame, levels: Mapping[str, Sequence], suffix: str = "_index") -> DataFrame:
    """Add the place of each value in its declared level list."""
    return df.withColumns({c + suffix: factor_index(F.col(c), v) for c, v in levels.items()})


def augment_rows(df: DataFrame, column: str, pattern: str, replacements: Sequence[str]) -> DataFrame:
    """The rows, and a copy of them per replacement with the column rewritten.

    The copies are exploded from one scan rather than unioned from several.
    """
    variants = [F.col(column)]
    variants += [F.regexp_replace(F.col(column), pattern, r) for r in replacements]
    return df.withColumn(column, F.explode(F.array(*variants)))


def row_id(df: DataFrame, order: Sequence[str | Column], name: str = "row_id", start: int = 1) -> DataFrame:
    """Dense global row number along a total order, without one big task."""
    return sorted_positions(df, order, name=name).withColumn(name, F.col(name) + F.lit(start))


def redate_rows(
    df: DataFrame, time: str, as_of: str, cut: str, last_cut: str | None = None
) -> DataFrame:
    """Move seed rows to the year of `as_of` (up to `cut`) and the year before.

    Both cuts are timestamps of the seed year: rows up to `cut` get the current
    year, rows from `last_cut` (default: `cut`) on the last year, so a row in
    both ranges appears twice.  A day the target year lacks gives a NULL time.
    """
    year = F.year(F.lit(as_of).cast("timestamp_ntz"))
    upper = F.lit(cut).cast("timestamp_ntz")
    lower = F.lit(last_cut or cut).cast("timestamp_ntz")
    moved = F.array(F.when(F.col(time) <= upper, year), F.when(F.col(time) >= lower, year - 1))
    text = F.concat_ws("-", F.col("_year"), F.date_format(time, "MM-dd HH:mm:ss"))
    return (
        df.withColumn("_year", F.explode(F.array_compact(moved)))
        .withColumn(time, text.try_cast("timestamp_ntz"))
        .drop("_year")
    )


def interaction_products(df: DataFrame, left: str, right: str, name: str = "products") -> DataFrame:
    """All products of two feature arrays, kept as one array column."""
    return df.withColumn(name, outer_product(F.col(left), F.col(right)))
