"""Ordered computations that do not need a whole series in one task.

A window over `partitionBy(series)` puts each series in one task.  When one
series holds a large part of the data that task never ends.  The functions here
cut a series along its order and stay exact:

* a *cell* is a piece of a series (say, a month of a clock, or a sort partition);
* what the rows of a cell need from earlier cells is a small carry (a count, a
  sum, the last known value), computed from one row per cell;
* fixed-reach frames (lags, rolling statistics) run in *blocks* of consecutive
  positions, where the rows at a block edge are copied to the neighbour block.

All orders given must be total, otherwise the result depends on chance.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fieldmark.session import stored

BLOCK_ROWS = 8192

Expr = Callable[[WindowSpec], Column]


def clock_cell(time: str | Column, days: int = 28) -> Column:
    """Number of the `days`-long stretch of the clock a timestamp lies in."""
    column = F.col(time) if isinstance(time, str) else time
    return F.floor(F.unix_date(column.cast("date")) / F.lit(days))


def hash_cell(key: Column, digits: int = 4) -> Column:
    """Leading hex digits of md5(key): even cells for an order by that hash."""
    return F.substring(F.md5(key.cast("string")), 1, digits)


def sort_cells(df: DataFrame, order: Sequence[Column | str], cell: str = "_cell") -> DataFrame:
    """Range-partition by `order` and note each row's partition as its cell.

    Spark samples the order columns, so cells are even whatever the skew, as
    long as the order is close to unique.  The rows are stored: the cell numbers
    must not change when a lost task is run again.
    """
    return stored(df.orderBy(*order).withColumn(cell, F.spark_partition_id()), "sorted")


def _cell_window(keys: Sequence[str], cell: str) -> WindowSpec:
    # One row per cell, so the frame is as long as the number of cells.
    return Window.partitionBy(*keys).orderBy(cell)


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    cell: Column,
    name: str = "pos",
    size: str | None = None,
) -> DataFrame:
    """0-based position of each row in its series, and the series length.

    `cell` must not decrease along `order`.  Counts per cell are summed on the
    map side; only they are ordered per series.  `df` is read twice, for the
    counts and for the rows, so store it first if it is costly to compute.
    """
    keys = list(keys)
    celled = df.withColumn("__cell", cell)
    along = _cell_window(keys, "__cell")
    starts = (
        celled.groupBy(*keys, "__cell")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn(
            "__start",
            F.coalesce(F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("__size", F.sum("__n").over(Window.partitionBy(*keys)))
        .drop("__n")
    )
    inside = Window.partitionBy(*keys, "__cell").orderBy(*order)
    out = (
        celled.withColumn("__in", F.row_number().over(inside) - 1)
        .join(starts, [*keys, "__cell"], "left")
        .withColumn(name, F.col("__start") + F.col("__in"))
    )
    if size:
        out = out.withColumn(size, F.col("__size"))
    return out.drop("__cell", "__in", "__start", "__size")


def sorted_positions(
    df: DataFrame,
    order: Sequence[Column | str],
    keys: Sequence[str] = (),
    name: str = "pos",
    size: str | None = None,
) -> DataFrame:
    """`positions` for orders without a natural cell (scores, free text, ids)."""
    full = [*keys, *order]
    ranked = sort_cells(df, full, "_sorted")
    return positions(ranked, keys, order, F.col("_sorted"), name, size).drop("_sorted")


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    cell: Column,
    sums: dict[str, Column],
) -> DataFrame:
    """Inclusive running sums per series, exact across cells."""
    keys = list(keys)
    celled = df.withColumns({"_cell": cell, **{f"_v_{n}": c for n, c in sums.items()}})
    before = _cell_window(keys, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    carry = celled.groupBy(*keys, "_cell").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    carry = carry.select(
        *keys,
        "_cell",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums],
    )
    inside = (
        Window.partitionBy(*keys, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    out = celled.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(inside) for n in sums})
    out = out.join(carry, [*keys, "_cell"], "left")
    return out.select(
        *df.columns,
        *[(F.coalesce(F.col(f"_r_{n}"), F.lit(0)) + F.col(f"_c_{n}")).alias(n) for n in sums],
    )


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cell: Column,
    values: dict[str, Column],
) -> DataFrame:
    """Last non-null value strictly before each row, per series."""
    keys, order = list(keys), list(order)
    celled = df.withColumns({"_cell": cell, **{f"_v_{n}": c for n, c in values.items()}})
    stamped = {
        n: F.when(F.col(f"_v_{n}").isNotNull(), F.struct(*order, F.col(f"_v_{n}").alias("_value")))
        for n in values
    }
    before = _cell_window(keys, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    carry = celled.groupBy(*keys, "_cell").agg(*[F.max(c).alias(f"_l_{n}") for n, c in stamped.items()])
    carry = carry.select(
        *keys, "_cell", *[F.max(f"_l_{n}").over(before).getField("_value").alias(f"_c_{n}") for n in values]
    )
    inside = (
        Window.partitionBy(*keys, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    out = celled.withColumns(
        {f"_r_{n}": F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in values}
    ).join(carry, [*keys, "_cell"], "left")
    return out.select(
        *df.columns, *[F.coalesce(f"_r_{n}", f"_c_{n}").alias(n) for n in values]
    )


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    exprs: dict[str, Expr],
    before: int = 0,
    after: int = 0,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Window expressions reaching `before` rows back and `after` rows ahead.

    `pos` is the dense position in the series.  Each block of `rows` positions
    is a window group of its own; the `before` rows at its end are copied to
    the next block and the `after` rows at its start to the previous one, and
    only the rows at home in a block are kept.
    """
    rows = max(rows, before, after, 1)
    home = F.call_function("div", F.col(pos), F.lit(rows))
    offset = F.pmod(F.col(pos), F.lit(rows))
    near_end, near_start = offset >= rows - before, offset < after
    stays = F.array(home)
    if before and after:
        stays = (
            F.when(near_end & near_start, F.array(home - 1, home, home + 1))
            .when(near_end, F.array(home, home + 1))
            .when(near_start, F.array(home - 1, home))
            .otherwise(stays)
        )
    elif before:
        stays = F.when(near_end, F.array(home, home + 1)).otherwise(stays)
    elif after:
        stays = F.when(near_start, F.array(home - 1, home)).otherwise(stays)
    copied = before or after
    spread = df.withColumn("_home", home).withColumn("_block", F.explode(stays) if copied else home)
    window = Window.partitionBy(*keys, "_block").orderBy(pos)
    out = spread.select("*", *[build(window).alias(name) for name, build in exprs.items()])
    if copied:
        out = out.filter(F.col("_block").eqNullSafe(F.col("_home")))
    return out.drop("_home", "_block")
