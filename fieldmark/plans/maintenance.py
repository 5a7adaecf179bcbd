"""Machine maintenance: hourly telemetry, errors, repairs and failures to a
training set that says which component fails within the next day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.functions.numbers import factor_index
from fieldmark.operators.aggregates import conditional_counts
from fieldmark.operators.joins import days_since_last, horizon_label, left_join_fill
from fieldmark.operators.ordered import clock_cell, positions
from fieldmark.operators.splits import time_split_gap
from fieldmark.operators.windows import every_nth_row, rolling

KEY, TIME = "machineID", "datetime"
# The measured columns and the declared codes.
SENSORS = ("volt", "rotate", "pressure", "vibration")
ERRORS = ("error1", "error2", "error3", "error4", "error5")
COMPONENTS = ("comp1", "comp2", "comp3", "comp4")


def rolling_features(telemetry: DataFrame, errors: DataFrame, step: int = 3, short: int = 3, long: int = 24) -> DataFrame:
    """Means and deviations over the last rows and error counts, every third row.

    Error counts are joined to the telemetry first, so that all 21 windows run
    over one exchange and one sort.
    """
    placed = positions(telemetry, [KEY], [TIME], clock_cell(TIME), "_pos")
    counts = conditional_counts(errors, [TIME, KEY], "errorID", ERRORS)
    rows = left_join_fill(placed, counts, [KEY, TIME], {e: 0 for e in ERRORS})
    specs = {f"{s}mean": ("mean", s, short - 1) for s in SENSORS}
    specs |= {f"{s}sd": ("sd", s, short - 1) for s in SENSORS}
    specs |= {f"{s}mean_24hrs": ("mean", s, long - 1) for s in SENSORS}
    specs |= {f"{s}sd_24hrs": ("sd", s, long - 1) for s in SENSORS}
    specs |= {f"{e}count": ("sum", e, long - 1) for e in ERRORS}
    return every_nth_row(rolling(rows, [KEY], "_pos", specs), "_pos", step).select(KEY, TIME, *specs)


def machine_features(
    telemetry: DataFrame, errors: DataFrame, maint: DataFrame, machines: DataFrame, chained: bool = False
) -> DataFrame:
    """Rolling features, days since the last repair of each component, machine data."""
    rolled = rolling_features(telemetry, errors)
    repairs = maint.select(KEY, F.col(TIME).alias("_repaired"), "comp")
    aged = days_since_last(rolled, repairs, KEY, TIME, "_repaired", "comp", COMPONENTS, chained=chained, days_of=telemetry)
    filled = aged.withColumns({f"sincelast{c}": F.coalesce(f"sincelast{c}", F.lit(0)) for c in COMPONENTS})
    return filled.join(machines, KEY, "left")


def labelled_features(
    telemetry: DataFrame,
    errors: DataFrame,
    maint: DataFrame,
    machines: DataFrame,
    failures: DataFrame,
    hours: int = 24,
    chained: bool = False,
) -> DataFrame:
    features = machine_features(telemetry, errors, maint, machines, chained)
    failed = failures.select(KEY, F.col(TIME).alias("_failed"), "failure")
    return horizon_label(features, failed, KEY, TIME, "_failed", "failure", hours)


def feature_names(labelled: DataFrame) -> list[str]:
    """Number columns to train on."""
    return [c for c in labelled.columns if c not in (KEY, TIME, "model", "failure")]


def split(labelled: DataFrame, train_before, test_after) -> tuple[DataFrame, DataFrame]:
    return time_split_gap(labelled, TIME, train_before, test_after)


def with_label_index(labelled: DataFrame, levels: Sequence[str] = (*COMPONENTS, "none")) -> DataFrame:
    """Failure as the place in the declared levels, and the machine model as number."""
    return labelled.withColumns(
        {
            "label": factor_index(F.col("failure"), levels).cast("double"),
            "model_index": F.regexp_extract("model", "([0-9]+)$", 1).cast("double"),
        }
    )
