"""Late arrivals: derived columns, factor crosses and linear models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.functions.numbers import threshold_flag, truncate_number
from fieldmark.models.train import train_formula

# Fixed value: minutes from which an arrival counts as late.
LATE_MINUTES = 15


def with_late(flights: DataFrame) -> DataFrame:
    return flights.withColumns(
        {
            "Late": threshold_flag(F.col("ArrDelay"), LATE_MINUTES),
            "CRSDepHour": truncate_number(F.col("CRSDepTime")),
        }
    )


def delay_model(flights: DataFrame) -> PipelineModel:
    """ArrDelay by the cross of origin and weekday and the departure hour."""
    data = with_late(flights).select(
        "ArrDelay", "Origin", "CRSDepHour", F.col("DayOfWeek").cast("string").alias("DayOfWeek")
    )
    estimator = LinearRegression(labelCol="label", featuresCol="features")
    return train_formula(data, "ArrDelay ~ Origin:DayOfWeek + CRSDepHour", estimator)
