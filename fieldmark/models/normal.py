"""Many linear fits in one shuffle.

A least-squares line needs only the means and covariances of its columns.  These are
aggregates that merge, so any number of groups (regions, folds, series) is fitted by one
grouped aggregation, whatever the size of a group; each group then is a small system of
equations of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldmark.session import measured


def linear_fits(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str) -> DataFrame:
    """keys, n, intercept, coefficients (in the order of `features`), rmse and r2 per group.

    Rows with an unknown value do not count.  Where features depend on each other the
    shortest solution is taken; without spread in the label r2 is NULL.
    """
    names = [*features, label]
    columns = {n: F.col(n).cast("double") for n in names}
    rows = df.select(*keys, *[c.alias(f"_{i}") for i, c in enumerate(columns.values())]).dropna(subset=[f"_{i}" for i in range(len(names))])
    places = range(len(names))
    means = F.array(*[F.avg(f"_{i}") for i in places]).alias("_means")
    spreads = F.array(*[F.covar_pop(f"_{i}", f"_{j}") for i in places for j in range(i + 1)]).alias("_spreads")
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), means, spreads).filter("n > 0")

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = len(names) - 1
        for frame in frames:
            found = []
            for mean, flat in zip(frame["_means"], frame["_spreads"]):
                full = np.zeros((p + 1, p + 1))
                full[np.tril_indices(p + 1)] = flat
                full = full + full.T - np.diag(full.diagonal())
                slopes = np.linalg.lstsq(full[:p, :p], full[:p, p], rcond=None)[0]
                left = max(float(full[p, p] - slopes @ full[:p, p]), 0.0)
                base = float(mean[p] - slopes @ np.asarray(mean[:p]))
                found.append((base, slopes.tolist(), left**0.5, 1 - left / full[p, p] if full[p, p] > 0 else None))
            out = frame.drop(columns=["_means", "_spreads"])
            for i, name in enumerate(("intercept", "coefficients", "rmse", "r2")):
                out[name] = [f[i] for f in found]
            yield out

    schema = T.StructType(
        [
            *[grouped.schema[k] for k in keys],
            T.StructField("n", T.LongType()),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("coefficients", T.ArrayType(T.DoubleType())),
            T.StructField("rmse", T.DoubleType()),
            T.StructField("r2", T.DoubleType()),
        ]
    )
    return grouped.mapInPandas(solve, schema)


def apply_fits(df: DataFrame, fits: DataFrame, keys: Sequence[str], features: Sequence[str], name: str = "score") -> DataFrame:
    """All rows of `df` with the value of their group's line; NULL for unknown features and groups."""
    wanted = measured(fits.select(*keys, F.col("intercept").alias("_base"), F.col("coefficients").alias("_by")))
    if keys:
        joined = df.join(wanted, list(keys), "left")
    else:
        joined = df.withColumns({c: wanted.select(c).scalar() for c in ("_base", "_by")})
    line = F.col("_base")
    for i, feature in enumerate(features):
        line = line + F.get("_by", F.lit(i)) * F.col(feature).cast("double")
    return joined.withColumn(name, line).drop("_base", "_by")
