"""Demand forecast per region on a 15-minute grid.

The region is a key of the rows, so one job serves all regions.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.functions.calendar import daily_fourier, day_hour_columns, hour_start
from fieldmark.models.train import apply_model, train_forest
from fieldmark.operators.joins import merge_upsert, spine_join, time_grid
from fieldmark.operators.ordered import over_blocks
from fieldmark.session import measured, stored

# The grid, the lags in grid rows, and the rows of a day.
STEP_SECONDS = 900
LOAD_LAGS = (24, 25, 26, 27, 28, 31, 36, 40, 48, 72, 96)
DAY_ROWS = 96


def _time(value: datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def forecast_times(as_of: datetime, hours: int = 6) -> tuple[datetime, datetime, datetime, datetime]:
    """Start of the history, its end, and the first and last time to forecast."""
    end = as_of.replace(minute=as_of.minute - as_of.minute % 15, second=0, microsecond=0)
    try:
        start = end.replace(year=end.year - 1)
    except ValueError:  # the 29th of February
        start = end.replace(year=end.year - 1, day=28)
    return start, end, end + timedelta(minutes=15), end + timedelta(hours=hours)


def load_and_temperature(
    demand: DataFrame, temperature: DataFrame, start: datetime, end: datetime, score_start: datetime, score_end: datetime
) -> tuple[DataFrame, DataFrame]:
    """Rows with load and temperature, and the regions.

    A row counts if its hour has a temperature and the row itself is a demand
    reading or a time to forecast.
    """
    history = demand.filter(F.col("time").between(_time(start), _time(end))).select("region", "time", "load")
    regions = measured(demand.select("region").distinct())
    future = time_grid(regions, _time(score_start), _time(score_end), STEP_SECONDS)
    readings = history.unionByName(future, allowMissingColumns=True)
    hourly = temperature.filter(F.col("time").between(_time(start), _time(score_end))).select(
        "region", hour_start(F.col("time")).alias("_hour"), "temperature"
    )
    known = readings.withColumn("_hour", hour_start(F.col("time"))).join(hourly, ["region", "_hour"], "inner")
    # Both are read again, for the grid and for its means; demand itself is read for these two only.
    return stored(known.drop("_hour"), "known"), regions


def energy_features(
    demand: DataFrame,
    temperature: DataFrame,
    start: datetime,
    end: datetime,
    score_start: datetime,
    score_end: datetime,
) -> DataFrame:
    """Filled load and temperature, load lags, calendar and wave columns.

    A lag of a filled value is the value that many rows back, else the one a
    day before that, else the mean; so filling and lagging share one exchange.
    """
    known, regions = load_and_temperature(demand, temperature, start, end, score_start, score_end)
    grid = spine_join(
        time_grid(regions, _time(start), _time(score_end), STEP_SECONDS, pos="pos"), known, ["region"], "time"
    )
    # The means of the grid, without building it twice: only rows on a step count.
    off = F.unix_micros(F.col("time").cast("timestamp")) - F.unix_micros(_time(start).cast("timestamp"))
    on_step = known.filter(off % (STEP_SECONDS * 1_000_000) == 0)
    means = measured(
        on_step.groupBy("region").agg(
            F.avg("load").alias("_mean_load"), F.avg("temperature").alias("_mean_temperature")
        )
    )
    reach = {f"_load_{n}": n for n in {*LOAD_LAGS, *(n + DAY_ROWS for n in LOAD_LAGS), DAY_ROWS}}
    exprs = {name: lambda w, n=n: F.lag("load", n).over(w) for name, n in reach.items()}
    exprs["_temperature_day"] = lambda w: F.lag("temperature", DAY_ROWS).over(w)
    lagged = over_blocks(grid, ["region"], "pos", exprs, before=max(reach.values())).join(means, "region", "left")
    lags = {
        f"lag{n}": F.when(
            F.col("pos") >= n, F.coalesce(f"_load_{n}", f"_load_{n + DAY_ROWS}", "_mean_load")
        )
        for n in LOAD_LAGS
    }
    calendar = day_hour_columns(F.col("time"))
    waves = daily_fourier(F.floor(F.col("pos") / F.lit(DAY_ROWS)), calendar["weekend"])
    return lagged.select(
        "time",
        "region",
        F.coalesce("load", f"_load_{DAY_ROWS}", "_mean_load").alias("load"),
        F.coalesce("temperature", "_temperature_day", "_mean_temperature").alias("temperature"),
        *[c.alias(n) for n, c in {**lags, **calendar, **waves}.items()],
    )


def feature_names(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in ("time", "region", "load")]


def train_demand(features: DataFrame, score_start: datetime, trees: int = 8, depth: int = 8) -> PipelineModel:
    """Regression forest on the rows before the forecast; the region is a feature."""
    history = features.filter(F.col("time") < _time(score_start))
    return train_forest(history, [*feature_names(features), "region"], "load", False, trees, depth)


def forecast_demand(model: PipelineModel, features: DataFrame, score_start: datetime) -> DataFrame:
    future = features.filter(F.col("time") >= _time(score_start))
    return apply_model(model, future).select("time", "region", F.col("prediction").alias("load"))


def rolling_retrain(
    demand: DataFrame,
    temperature: DataFrame,
    forecasts: DataFrame | None,
    as_of: datetime,
    hours: int = 6,
    trees: int = 8,
    depth: int = 8,
) -> DataFrame:
    """One tick: features of a year, train, forecast, merge into the forecasts.

    The same `as_of` gives the same rows, so a tick can be run again.
    """
    start, end, score_start, score_end = forecast_times(as_of, hours)
    # The fit and the forecast read the same features.
    features = stored(energy_features(demand, temperature, start, end, score_start, score_end), "features")
    model = train_demand(features, score_start, trees, depth)
    fresh = forecast_demand(model, features, score_start)
    return fresh if forecasts is None else merge_upsert(forecasts, fresh, ["time", "region"])
