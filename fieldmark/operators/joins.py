"""Joins, as-of and interval lookups, grids and upserts.

No join here is forced to broadcast: Spark picks it from the measured size of
a side, and falls back to a shuffled join whose hot keys are split at run time.
Values of a one-row frame come in as scalar subqueries instead of cross joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmark.functions.calendar import hour_boundaries, hour_start
from fieldmark.operators.rows import row_id


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "inner")


def left_join_fill(
    left: DataFrame, right: DataFrame, on: Sequence[str], fill: Mapping[str, object]
) -> DataFrame:
    """Left join; the listed columns get a value where there is no match."""
    joined = left.join(right, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def feature_merge(
    spine: DataFrame, parts: Sequence[DataFrame], on: Sequence[str], static: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Chain of left joins on one key, so that the spine is shuffled once.

    `static` frames hang on a single column (e.g. machine data) and come last.
    """
    merged = reduce(lambda acc, part: acc.join(part, list(on), "left"), parts, spine)
    for column, frame in (static or {}).items():
        merged = merged.join(frame, column, "left")
    return merged


def right_join_hour(
    fine: DataFrame, hourly: DataFrame, keys: Sequence[str], time: str, value: str, hourly_value: str
) -> DataFrame:
    """Every hourly row with the finer rows of its hour (none: one row, NULL)."""
    left = fine.select(*keys, F.col(time), F.col(value), hour_start(F.col(time)).alias("_hour"))
    right = hourly.select(*keys, hour_start(F.col(time)).alias("_hour"), F.col(hourly_value))
    return left.join(right, [*keys, "_hour"], "right").withColumnRenamed("_hour", "hour")


def full_outer_update(
    left: DataFrame, right: DataFrame, on: Sequence[str], updates: Mapping[str, Column]
) -> DataFrame:
    """New columns of the left rows, computed with the matching right row.

    A full join whose unmatched right rows are not used is a left join.
    """
    return left.join(right, list(on), "left").select(
        *[left[c] for c in left.columns], *[c.alias(n) for n, c in updates.items()]
    )


def anti_join(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on), list(on), "left_anti")


def semi_join_keys(df: DataFrame, keys_frame: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose series is in the key list."""
    return df.join(keys_frame.select(*on), list(on), "left_semi")


def cross_join_score_input(
    people: DataFrame, project: DataFrame, columns: Mapping[str, str], where: Column | None = None
) -> DataFrame:
    """Every person next to one project.

    The project is a single row, so its columns become scalar subqueries: no
    join takes place, and a second project row is an error at run time.
    """
    chosen = people if where is None else people.filter(where)
    return chosen.withColumns({new: project.select(old).scalar() for old, new in columns.items()})


def days_since_last(
    rows: DataFrame,
    events: DataFrame,
    key: str,
    time: str,
    event_time: str,
    kind: str,
    kinds: Sequence[str],
    prefix: str = "sincelast",
    chained: bool = False,
    days_of: DataFrame | None = None,
) -> DataFrame:
    """Days since the last earlier event of each kind; NULL if there is none.

    Days are enough to decide it: an event earlier on the same day gives 0,
    otherwise the last day with an event counts.  So events are reduced to one
    row per key and day on the map side, the order runs over days, and the rows
    meet them in one equi-join.  `days_of` may name a table with the same keys
    and days that is cheaper to read than `rows`.  `chained` gives the values of a template that
    joined the kinds one after another: without a first kind all are lost, and
    the fourth is lost without the third.
    """
    firsts = [F.min(F.when(F.col(kind) == k, F.col(event_time))).alias(f"_first_{k}") for k in kinds]
    event_days = events.groupBy(F.col(key), F.col(event_time).cast("date").alias("_day")).agg(*firsts)
    dated = rows if days_of is None else days_of
    row_days = dated.select(key, F.col(time).cast("date").alias("_day")).distinct()
    days = (
        event_days.unionByName(row_days, allowMissingColumns=True)
        .groupBy(key, "_day")
        .agg(*[F.max(f"_first_{k}").alias(f"_first_{k}") for k in kinds])
    )
    # One row per key and calendar day: at most 36,525 in a century.
    before = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumns(
        {
            f"_last_{k}": F.max(F.when(F.col(f"_first_{k}").isNotNull(), F.col("_day"))).over(before)
            for k in kinds
        }
    )
    joined = rows.withColumn("_day", F.col(time).cast("date")).join(days, [key, "_day"], "left")
    since = {
        k: F.when(F.col(f"_first_{k}") < F.col(time), 0).otherwise(
            F.datediff(F.col("_day"), F.col(f"_last_{k}"))
        )
        for k in kinds
    }
    if chained and len(kinds) != 4:
        raise ValueError("chained values are defined for four kinds")
    if chained:
        one, two, three, four = kinds
        known = since[one].isNotNull()
        since = {
            one: since[one],
            two: F.when(known, since[two]),
            three: F.when(known, since[three]),
            four: F.when(known & since[three].isNotNull(), since[four]),
        }
    return joined.select(*rows.columns, *[since[k].alias(prefix + k) for k in kinds])


def horizon_label(
    rows: DataFrame,
    failures: DataFrame,
    key: str,
    time: str,
    failure_time: str,
    label: str,
    hours: int = 24,
    none: str = "none",
    nearest: bool = False,
) -> DataFrame:
    """Label a row with each failure 0..`hours` hour marks after it.

    Failures are filed under the days whose rows can see them, which turns the
    interval test into an equi-join on key and day with a residual condition.
    Several failures give several rows unless `nearest` is asked for.
    """
    reach = -(-hours // 24)
    days = F.transform(
        F.sequence(F.lit(0), F.lit(reach)),
        lambda back: F.date_sub(F.col(failure_time).cast("date"), back),
    )
    filed = failures.select(
        F.col(key).alias("_key"),
        F.col(failure_time).alias("_at"),
        F.col(label).alias("_label"),
        F.explode(days).alias("_day"),
    )
    ahead = hour_boundaries(F.col(time), F.col("_at"))
    match = (
        (F.col(key) == F.col("_key"))
        & (F.col(time).cast("date") == F.col("_day"))
        & ahead.between(0, hours)
    )
    if not nearest:
        joined = rows.join(filed, match, "left")
        return joined.select(*rows.columns, F.coalesce("_label", F.lit(none)).alias(label))
    # Reduce on the map side: one failure per row key, then one lookup.
    seen = rows.select(key, time).distinct().join(filed, match, "inner")
    first = seen.groupBy(key, time).agg(F.min(F.struct("_at", "_label")).alias("_first"))
    return rows.join(first, [key, time], "left").select(
        *rows.columns, F.coalesce(F.col("_first._label"), F.lit(none)).alias(label)
    )


def latest_row(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """Values at the greatest time per key; equal times take the greatest values."""
    last = F.max(F.struct(time, *values)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")


def scalar_subquery(df: DataFrame, values: Mapping[str, DataFrame]) -> DataFrame:
    """Add the single value of each one-row frame to every row."""
    return df.withColumns({name: frame.scalar() for name, frame in values.items()})


def update_from_join(
    target: DataFrame, source: DataFrame, on: Sequence[str], columns: Sequence[str], only_null: bool = True
) -> DataFrame:
    """Set columns from the source row of the same key, by default only NULLs."""
    renamed = source.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(renamed, list(on), "left")
    value = {
        c: F.coalesce(c, f"_new_{c}") if only_null else F.coalesce(f"_new_{c}", c) for c in columns
    }
    return joined.select(*[value[c].alias(c) if c in value else F.col(c) for c in target.columns])


def time_grid(
    keys_frame: DataFrame, start: Column, end: Column, step_seconds: int, time: str = "time", pos: str | None = None
) -> DataFrame:
    """Every key at every step from start to end, generated inside the tasks.

    `pos` names the step number, which is the position in the series: ordered
    work on a grid needs no ranking.
    """
    steps = F.sequence(start, end, F.make_dt_interval(secs=F.lit(step_seconds)))
    placed = keys_frame.select("*", F.posexplode(steps).alias("_step", time))
    if pos:
        placed = placed.withColumn(pos, F.col("_step").cast("bigint"))
    return placed.drop("_step")


def time_span(data: DataFrame, time: str) -> tuple[Column, Column]:
    """First and last time of a table, found by one aggregate."""
    span = data.agg(F.struct(F.min(time).alias("lo"), F.max(time).alias("hi")).alias("span")).scalar()
    return span.getField("lo"), span.getField("hi")


def spine_join(
    grid: DataFrame, data: DataFrame, keys: Sequence[str], time: str
) -> DataFrame:
    """Grid left join data: gaps of the data show as NULL."""
    return grid.join(data, [*keys, time], "left")


def series_spine(
    data: DataFrame, keys: Sequence[str], time: str, step_days: int = 7, pos: str | None = None
) -> DataFrame:
    """Every series at every step between the overall first and last time."""
    series = data.select(*keys).distinct()
    grid = time_grid(series, *time_span(data, time), step_days * 86_400, time, pos)
    return spine_join(grid, data, keys, time)


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Fact rows with the columns of each dimension (inner joins)."""
    return reduce(lambda acc, d: acc.join(d[0], list(d[1]), "inner"), dimensions, fact)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both; a source row replaces the target row of the same key.

    Two source rows with one key are an error at run time, as which of them
    wins would be chance.  The source is reduced by key on the map side, and
    that exchange also serves the join.
    """
    values = [c for c in target.columns if c not in set(keys)]
    given = [c for c in values if c in source.columns]
    once = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(f"_new_{c}") for c in given]
    )
    message = F.lit("merge_upsert: two source rows have one key")
    # In a filter, the test stays whatever columns are read later.
    once = once.filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    joined = target.withColumn("_old", F.lit(True)).join(once, list(keys), "full")
    hit = F.col("_n").isNotNull()
    return joined.select(
        *keys,
        *[
            (F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) if c in given else F.col(c)).alias(c)
            for c in values
        ],
    )


def positional_join(
    ids: DataFrame, truth: DataFrame, truth_order: Sequence[str], key: str, value: str
) -> DataFrame:
    """Attach truth row number n (by its order column) to the entity numbered n."""
    numbered = row_id(truth, truth_order, "_n").select(F.col("_n").alias(key), F.col(value))
    return ids.join(numbered, key, "left")


def join_forecasts(
    actual: DataFrame, forecasts: Mapping[str, DataFrame], on: Sequence[str], value: str = "forecast"
) -> DataFrame:
    """Forecasts of several methods side by side, next to the actual rows."""
    named = [
        frame.select(*on, F.col(value).alias(f"{value}_{method}")) for method, frame in forecasts.items()
    ]
    together = reduce(lambda a, b: a.join(b, list(on), "inner"), named)
    return actual.join(together, list(on), "left")
