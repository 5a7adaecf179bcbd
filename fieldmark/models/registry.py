"""Model registry, usage and performance logs, and the run log.

Everything is a parquet table below one folder that all executors reach.  Rows
are only appended; the newest row of a name counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmark.operators.joins import inner_join

# Fixed layouts of the registry tables.
MODELS = "id STRING, version DOUBLE, created TIMESTAMP_NTZ, path STRING"
DETAILS = (
    "id STRING, language STRING, type STRING, version DOUBLE, owner STRING, performance DOUBLE, build_type STRING"
)
USAGE = "id STRING, campaign STRING, usage_date TIMESTAMP_NTZ, channel STRING, season STRING"
PERFORMANCE = "id STRING, campaign STRING, perf_date TIMESTAMP_NTZ, response_rate DOUBLE, total_revenue DOUBLE"
RUNS = "step INT, time TIMESTAMP_NTZ, region STRING, run_time TIMESTAMP_NTZ, success_flag INT, error STRING"


def _append(df: DataFrame, path: str, layout: str) -> DataFrame:
    """Append rows in the declared layout and return the stored table."""
    spark = df.sparkSession
    names = [part.strip().split(" ")[0] for part in layout.split(",")]
    kinds = [part.strip().split(" ")[1] for part in layout.split(",")]
    df.select(*[F.col(n).cast(k).alias(n) for n, k in zip(names, kinds)]).write.mode("append").parquet(path)
    return spark.read.schema(layout).parquet(path)


def save_model(
    model: PipelineModel, spark: SparkSession, folder: str, name: str, version: float, created: datetime
) -> str:
    """Store the model under its name and version, and note it in the registry."""
    path = f"{folder}/models/{name}/v{version:g}"
    model.write().overwrite().save(path)
    row = spark.createDataFrame([(name, float(version), created, path)], MODELS)
    _append(row, f"{folder}/registry", MODELS)
    return path


def models(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MODELS).parquet(f"{folder}/registry")


def load_model(
    spark: SparkSession, folder: str, name: str, as_of: datetime | None = None
) -> PipelineModel:
    """Newest model of the name, or the newest not after `as_of`."""
    known = models(spark, folder).filter(F.col("id") == name)
    if as_of is not None:
        known = known.filter(F.col("created") <= F.lit(as_of).cast("timestamp_ntz"))
    row = known.agg(F.max(F.struct("created", "version", "path")).alias("last")).first()
    if row is None or row["last"] is None:
        raise LookupError(f"no model named {name}")
    return PipelineModel.load(row["last"]["path"])


def register_details(details: DataFrame, folder: str) -> DataFrame:
    return _append(details, f"{folder}/details", DETAILS)


def log_usage(usage: DataFrame, folder: str) -> DataFrame:
    return _append(usage, f"{folder}/usage", USAGE)


def log_performance(performance: DataFrame, folder: str) -> DataFrame:
    return _append(performance, f"{folder}/performance", PERFORMANCE)


def declined(history: DataFrame, reported: DataFrame, details: DataFrame) -> DataFrame:
    """Models whose reported rate is below their last one, with the next version."""
    last = history.groupBy("id").agg(
        F.max(F.struct("perf_date", "response_rate")).getField("response_rate").alias("last_rate")
    )
    versions = details.groupBy("id").agg((F.max("version") + 1).alias("next_version"))
    return (
        reported.join(last, "id", "inner")
        .filter(F.col("last_rate") > F.col("response_rate"))
        .join(versions, "id", "left")
        .select("id", "last_rate", "response_rate", F.coalesce("next_version", F.lit(1.0)).alias("next_version"))
    )


def rebuild_on_decline(
    spark: SparkSession,
    folder: str,
    history: DataFrame,
    reported: DataFrame,
    details: DataFrame,
    build: Callable[[str], tuple[PipelineModel, float]],
    created: datetime,
    owner: str = "",
) -> DataFrame:
    """Build and register a new version of every model that did worse.

    A registry holds one row per model, so the list of models to build comes to
    the driver, which has to start their training anyway.  Returns the details
    of the new versions.
    """
    rows = []
    for row in declined(history, reported, details).orderBy("id").toLocalIterator():
        model, performance = build(row["id"])
        save_model(model, spark, folder, row["id"], row["next_version"], created)
        kind = type(model.stages[-1]).__name__
        rows.append((row["id"], "Spark ML", kind, row["next_version"], owner, float(performance), "Automatic"))
    fresh = spark.createDataFrame(rows, DETAILS)
    if rows:
        register_details(fresh, folder)
    return fresh


def model_view(details: DataFrame, stored: DataFrame) -> DataFrame:
    """Details next to the stored model of the same version."""
    return inner_join(details, stored, ["id", "version"])


def results_view(usage: DataFrame, performance: DataFrame) -> DataFrame:
    """Usage next to the results of the same campaign."""
    return inner_join(usage, performance, ["id", "campaign"])


@contextmanager
def run_log(
    spark: SparkSession, folder: str, step: int, time: datetime, region: str, run_time: datetime
) -> Iterator[None]:
    """Log success or the error text of a step; the error is raised again."""

    def note(flag: int, error: str) -> None:
        row = spark.createDataFrame([(step, time, region, run_time, flag, error)], RUNS)
        _append(row, f"{folder}/runs", RUNS)

    try:
        yield
    except Exception as error:
        note(-1, str(error))
        raise
    note(0, "")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(f"{folder}/runs")
