"""Lags, rolling statistics, series positions and ranks.

Functions that take `pos` expect the dense position in the series (from
`positions` or from a grid) and run in blocks; see `ordered`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmark.operators.ordered import (
    BLOCK_ROWS,
    last_known,
    over_blocks,
    positions,
    sorted_positions,
)
from fieldmark.session import measured


def lag_interval(
    df: DataFrame, key: str, time: str, tie_break: str, name: str = "interval"
) -> DataFrame:
    """Days since the previous row of the key; 0 for the first one.

    Only the first row of a day can have a gap, so days are reduced to one row
    on the map side, the lag runs over days, and the gap goes to the row with
    the least tie-break among the earliest of its day.
    """
    day = F.col(time).cast("date")
    days = df.groupBy(key, day.alias("_day")).agg(F.min(F.struct(time, tie_break)).alias("_first"))
    # One row per key and calendar day.
    along = Window.partitionBy(key).orderBy("_day")
    days = days.withColumn("_gap", F.datediff(F.col("_day"), F.lag("_day").over(along)))
    joined = df.withColumn("_day", day).join(days, [key, "_day"], "left")
    is_first = F.struct(time, tie_break) == F.col("_first")
    return joined.select(
        *df.columns, F.coalesce(F.when(is_first, F.col("_gap")), F.lit(0)).alias(name)
    )


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    specs: Mapping[str, tuple[str, str, int]],
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Trailing statistics {name: (mean|sd|sum|n, column, preceding rows)}.

    All frames of one call share one exchange and one sort.
    """
    functions = {"mean": F.avg, "sd": F.stddev_samp, "sum": F.sum, "n": F.count}
    exprs = {
        name: lambda w, f=functions[kind], c=column, n=n: f(c).over(w.rowsBetween(-n, 0))
        for name, (kind, column, n) in specs.items()
    }
    return over_blocks(df, keys, pos, exprs, before=max(n for _, _, n in specs.values()), rows=rows)


def rolling_mean(df, keys, pos, columns: Mapping[str, str], preceding: int) -> DataFrame:
    return rolling(df, keys, pos, {n: ("mean", c, preceding) for n, c in columns.items()})


def rolling_stdev(df, keys, pos, columns: Mapping[str, str], preceding: int) -> DataFrame:
    """Rows whose first deviation is NULL (one known value) are left out."""
    out = rolling(df, keys, pos, {n: ("sd", c, preceding) for n, c in columns.items()})
    return out.filter(F.col(next(iter(columns))).isNotNull())


def rolling_counts(df, keys, pos, columns: Mapping[str, str], preceding: int = 23) -> DataFrame:
    return rolling(df, keys, pos, {n: ("sum", c, preceding) for n, c in columns.items()})


def rolling_partial(
    df: DataFrame, keys: Sequence[str], pos: str, sensors: Sequence[str], width: int = 5
) -> DataFrame:
    """Mean a* and deviation sd* of each sensor s*; a single row deviates by 0."""
    specs = {s.replace("s", "a", 1): ("mean", s, width - 1) for s in sensors}
    specs |= {s.replace("s", "sd", 1): ("sd", s, width - 1) for s in sensors}
    out = rolling(df, keys, pos, specs)
    return out.fillna(0.0, subset=[s.replace("s", "sd", 1) for s in sensors])


def every_nth_row(df: DataFrame, pos: str, n: int) -> DataFrame:
    """Rows number n, 2n, 3n, .. of each series."""
    return df.filter((F.col(pos) + 1) % n == 0)


def multi_lag(
    df: DataFrame, keys: Sequence[str], pos: str, column: str, lags: Sequence[int], prefix: str = "lag"
) -> DataFrame:
    """One column per lag, all in one pass."""
    exprs = {f"{prefix}{n}": lambda w, n=n: F.lag(column, n).over(w) for n in lags}
    return over_blocks(df, keys, pos, exprs, before=max(lags))


def fill_from_lag(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: Sequence[str],
    lag: int = 96,
) -> DataFrame:
    """NULL becomes the value `lag` rows back, else the mean of the series.

    A value filled in is not used for later rows.
    """
    exprs = {f"_lag_{c}": lambda w, c=c: F.lag(c, lag).over(w) for c in columns}
    means = measured(df.groupBy(*keys).agg(*[F.avg(c).alias(f"_mean_{c}") for c in columns]))
    lagged = over_blocks(df, keys, pos, exprs, before=lag).join(means, list(keys), "left")
    filled = {c: F.coalesce(c, f"_lag_{c}", f"_mean_{c}") for c in columns}
    return lagged.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def fill_from_lag_recursive(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: Sequence[str],
    lag: int = 24,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """NULL becomes the value `lag` rows back, which may have been filled too.

    Walking back in steps of `lag` until a value is known is the last known
    value among the rows with the same remainder of the position.
    """
    phased = df.withColumn("_phase", F.pmod(F.col(pos), F.lit(lag)))
    cell = F.floor(F.col(pos) / F.lit(lag * rows))
    out = last_known(
        phased, [*keys, "_phase"], [pos], cell, {f"_known_{c}": F.col(c) for c in columns}
    )
    return out.select(
        *[F.coalesce(c, f"_known_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def series_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cell: Column, name: str = "pos"
) -> DataFrame:
    return positions(df, keys, order, cell, name)


def rul_label(
    df: DataFrame,
    key: str,
    cycle: str,
    truth: DataFrame | None = None,
    truth_column: str = "RUL",
    near: int = 30,
    very_near: int = 15,
) -> DataFrame:
    """Remaining cycles, and the two- and three-class labels made of them.

    `truth` holds the cycles left after the last recorded one.
    """
    ends = df.groupBy(key).agg(F.max(cycle).alias("_end"))
    if truth is not None:
        ends = ends.join(truth.select(key, F.col(truth_column).alias("_left")), key, "left")
        ends = ends.withColumn("_end", F.col("_end") + F.col("_left")).drop("_left")
    out = df.join(measured(ends), key, "left").withColumn("RUL", F.col("_end") - F.col(cycle)).drop("_end")
    label1 = F.when(F.col("RUL") <= near, 1).otherwise(0)
    return out.withColumns({"label1": label1, "label2": F.when(F.col("RUL") <= very_near, 2).otherwise(label1)})


def last_cycle(df: DataFrame, key: str, cycle: str) -> DataFrame:
    """The row with the greatest cycle of each key (cycles are unique there)."""
    others = [c for c in df.columns if c not in (key, cycle)]
    last = df.groupBy(key).agg(F.max(F.struct(cycle, *others)).alias("_last"))
    return last.select(key, "_last.*").select(*df.columns)


def rank_products(
    df: DataFrame, customer: str, product: str, score: str, name: str = "rank"
) -> DataFrame:
    """Rank by falling score; equal scores by product.

    A customer has one row per product of the catalogue, so a group is bounded
    by the number of products.
    """
    along = Window.partitionBy(customer).orderBy(F.col(score).desc(), F.col(product))
    return df.withColumn(name, F.row_number().over(along))


def ntile_buckets(
    df: DataFrame, order: Sequence[str], buckets: int, name: str = "bucket"
) -> DataFrame:
    """Exact ntile over the whole table: the first n % buckets get one row more.

    The rank comes from a distributed sort; SQL's ntile without partitions
    would bring the table into one task.
    """
    ranked = sorted_positions(df, order, name="_pos", size="_n")
    small = F.floor(F.col("_n") / buckets)
    big_buckets = F.col("_n") % buckets
    in_big = big_buckets * (small + 1)
    bucket = F.when(
        F.col("_pos") < in_big, F.floor(F.col("_pos") / (small + 1))
    ).otherwise(big_buckets + F.floor(F.try_divide(F.col("_pos") - in_big, small)))
    return ranked.withColumn(name, (bucket + 1).cast("int")).drop("_pos", "_n")


def bucket_bounds(df: DataFrame, bucket: str, column: str) -> DataFrame:
    return df.groupBy(bucket).agg(
        F.min(column).alias(f"min_{column}"),
        F.max(column).alias(f"max_{column}"),
        F.count(F.lit(1)).alias("n"),
    )


def lag_by_horizon(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    lags: int,
    horizon: int,
    complete: bool = True,
) -> DataFrame:
    """For each horizon h the values lag+h-1 rows back: rows x horizon.

    A row carries one bounded array of its `lags+horizon-1` past values; the
    horizons are slices of it.
    """
    reach = lags + horizon - 1
    # Lags one by one keep unknown values in their place, newest first.
    past = {f"_p{n}": lambda w, n=n: F.lag(value, n).over(w) for n in range(1, reach + 1)}
    out = over_blocks(df, keys, pos, past, before=reach)
    out = out.withColumn("_past", F.array(*[f"_p{n}" for n in range(1, reach + 1)]))
    if complete:
        out = out.dropna(subset=df.columns)
    out = out.select(*df.columns, "_past", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))
    if complete:
        # One condition on the slice, instead of one per lag column.
        out = out.filter(F.forall(F.slice("_past", F.col("horizon"), lags), lambda x: x.isNotNull()))
    return out.select(
        *df.columns,
        "horizon",
        *[F.element_at("_past", F.col("horizon") + (n - 1)).alias(f"lag{n}") for n in range(1, lags + 1)],
    )


def test_lags(
    train: DataFrame, test: DataFrame, keys: Sequence[str], pos: str, value: str, lags: int
) -> DataFrame:
    """The last `lags` training values of the series on each of its test rows.

    Unknown training values are filled by the training mean first.  The last
    values are picked by position in one aggregate, so no series is sorted.
    """
    ends = measured(train.groupBy(*keys).agg(F.max(pos).alias("_end"), F.avg(value).alias("_mean")))
    placed = train.select(*keys, pos, value).join(ends, list(keys), "left")
    picked = placed.filter(F.col(pos) > F.col("_end") - lags).groupBy(*keys).agg(
        F.max("_end").alias("_end"),
        *[
            F.max(
                F.when(F.col(pos) == F.col("_end") - (n - 1), F.coalesce(F.col(value), F.col("_mean")))
            ).alias(f"lag{n}")
            for n in range(1, lags + 1)
        ],
    )
    out = test.join(picked, list(keys), "left")
    return out.withColumn("horizon", (F.col(pos) - F.col("_end")).cast("int")).drop("_end")


test_lags.__test__ = False  # a name pytest would take for a test


def centered_ma(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, width: int = 52, name: str = "ma"
) -> DataFrame:
    """Centered mean; NULL where the window leaves the series."""
    back, ahead = (width - 1) // 2, width // 2
    out = over_blocks(
        df,
        keys,
        pos,
        {
            name: lambda w: F.avg(value).over(w.rowsBetween(-back, ahead)),
            "_rows": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-back, ahead)),
        },
        before=back,
        after=ahead,
    )
    return out.withColumn(name, F.when(F.col("_rows") == width, F.col(name))).drop("_rows")


def best_index_lag(
    smoothed: DataFrame,
    index: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    index_pos: str,
    index_value: str,
    offsets: int,
) -> DataFrame:
    """Offset at which an outside index correlates best with each series.

    An index has one value per step, so the join matches each row with at most
    `offsets` index values, and the correlations are grouped aggregates that
    combine on the map side.
    """
    known = smoothed.filter(F.col(value).isNotNull()).select(
        *keys, pos, value, F.explode(F.sequence(F.lit(0), F.lit(offsets - 1))).alias("offset")
    )
    # Stored, so that an index of usual size is sent to the series and no week becomes a hot key.
    shifted = measured(index.select(F.col(index_pos).alias("_at"), F.col(index_value).alias("_index")))
    pairs = known.withColumn("_at", F.col(pos) + F.col("offset")).join(shifted, "_at", "inner")
    scores = pairs.groupBy(*keys, "offset").agg(F.corr(value, "_index").alias("correlation"))
    # Ties go to the smaller offset.
    best = F.max(
        F.struct(F.abs("correlation").alias("a"), (-F.col("offset")).alias("o"), F.col("correlation").alias("c"))
    ).alias("_best")
    return (
        scores.filter(F.col("correlation").isNotNull())
        .groupBy(*keys)
        .agg(best)
        .select(*keys, (-F.col("_best.o")).cast("int").alias("offset"), F.col("_best.c").alias("correlation"))
    )
