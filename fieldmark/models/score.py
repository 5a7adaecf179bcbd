"""Scoring.  Models are applied inside the tasks that read the rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldmark.models.train import apply_model
from fieldmark.session import measured, stored

# Rows of a group that a user function sees in one call.
PIECE_ROWS = 8192
# Rows of short groups that travel to a task together.
BUNDLE_ROWS = 65536


def known_vector(name: str) -> Column:
    """The vector column, with an empty vector for NULL, which conversions cannot take."""
    return F.coalesce(F.col(name), array_to_vector(F.array().cast("array<double>")))


def score_model(
    model: PipelineModel, df: DataFrame, ids: Sequence[str], name: str = "score", class_index: int | None = 1
) -> DataFrame:
    """Identity columns with the probability of a class, or the predicted number.

    Every row of `df` gets one: NULL where a feature is NULL or a level was not seen.
    """
    scored = apply_model(model, df)
    if class_index is not None and "probability" in scored.columns:
        value = F.when(F.col("probability").isNotNull(), vector_to_array(known_vector("probability"))[class_index])
    else:
        value = F.col("prediction")
    return scored.select(*ids, value.alias(name))


def score_classes(
    model: PipelineModel, df: DataFrame, ids: Sequence[str], classes: Sequence, name: str = "predicted"
) -> DataFrame:
    """Identity columns with the predicted class and, if known, each probability; NULL as in `score_model`."""
    scored = apply_model(model, df)
    labels = F.array(*[F.lit(c) for c in classes])
    # An unknown index would be read as some place of the array.
    chosen = F.when(F.col("prediction").isNotNull(), F.element_at(labels, F.coalesce(F.col("prediction").cast("int"), F.lit(0)) + 1))
    columns = [chosen.alias(name)]
    if "probability" in scored.columns:
        share, known = vector_to_array(known_vector("probability")), F.col("probability").isNotNull()
        columns += [F.when(known, share[i]).alias(f"probability_{c}") for i, c in enumerate(classes)]
    return scored.select(*ids, *columns)


def score_threshold(scored: DataFrame, name: str, threshold: float = 0.5, keep: bool = True) -> DataFrame:
    """Rows that reach the threshold, or all rows with a 0/1 label above it."""
    if keep:
        return scored.filter(F.col(name) >= threshold)
    return scored.withColumn(f"{name}_label", (F.col(name) > threshold).cast("int"))


STATS = "group_id STRING, rows BIGINT, matches BIGINT, started DOUBLE, ended DOUBLE, duration DOUBLE, rate DOUBLE"


def score_stats(
    scored: DataFrame,
    path: str,
    stats_path: str,
    group: str,
    match: Column | None = None,
    clock: Callable[[], float] = time.time,
) -> DataFrame:
    """Store the matches of a group, and append its counts, duration and rate.

    The group is a partition of the result, which a second run of it replaces.
    Counting the rows that went in reads no feature and scores nothing; the
    matches are counted in the stored partition.
    """
    spark = scored.sparkSession
    started = clock()
    matches = scored if match is None else scored.filter(match)
    (
        matches.withColumn("group_id", F.lit(group))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("group_id")
        .parquet(path)
    )
    ended = clock()
    stored = T.StructType([*matches.schema.fields, T.StructField("group_id", T.StringType())])
    kept = spark.read.schema(stored).parquet(path).filter(F.col("group_id") == group).count()
    rows, duration = scored.count(), ended - started
    rate = rows / duration if duration > 0 else None
    row = [(group, rows, kept, started, ended, duration, rate)]
    spark.createDataFrame(row, STATS).write.mode("append").parquet(stats_path)
    return spark.read.parquet(stats_path)


def batch_score(
    model: PipelineModel, df: DataFrame, ids: Sequence[str], path: str, name: str = "score"
) -> DataFrame:
    """Score a table and append the result; every partition is its own batch."""
    score_model(model, df, ids, name).write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def table_function(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Apply a script to chunks of rows; the result has a declared schema."""

    def chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield function(frame)

    return df.mapInPandas(chunks, schema)


def group_apply(
    df: DataFrame,
    keys: Sequence[str],
    deal: Column,
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    partial_schema: T.StructType | str,
    finish: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    rows: int = PIECE_ROWS,
) -> DataFrame:
    """A user function per group, in two steps so that no group is one task.

    `partial` sees one piece of a group and returns a summary of it; `finish` sees the
    summaries of a group.  Groups of up to `rows` rows are one piece, and travel many
    together, both steps in one task; a longer one is dealt out by the hash of `deal` into
    pieces of about so many rows.
    """
    keys = list(keys)
    df = stored(df, "groups")
    counts = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "counts")
    found = counts.agg(F.count_if(F.col("_n") > rows), F.coalesce(F.sum(F.when(F.col("_n") <= rows, F.col("_n"))), F.lit(0))).first()
    long, few = found[0], found[1]

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        groups = frame.drop(columns=["_bundle"]).groupby(keys, sort=False, dropna=False)
        return pd.concat([finish(partial(group)) for _, group in groups])

    bundle = F.pmod(F.xxhash64(*keys), F.lit(max(1, -(-few // BUNDLE_ROWS))))
    if not long:
        return df.withColumn("_bundle", bundle).groupBy("_bundle").applyInPandas(whole, schema)
    pieces = F.ceil(F.col("_n") / rows).alias("_pieces")
    of_long = counts.filter(F.col("_n") > rows).select(*[F.col(k).alias(f"_k_{k}") for k in keys], pieces)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    marked = df.withColumn("_deal", F.xxhash64(deal)).join(of_long, same, "left")
    one = marked.filter(F.col("_pieces").isNull()).select(*df.columns, bundle.alias("_bundle"))
    cut = marked.filter(F.col("_pieces").isNotNull()).select(*df.columns, F.pmod("_deal", "_pieces").alias("_chunk"))
    summaries = cut.groupBy(*keys, "_chunk").applyInPandas(lambda frame: partial(frame.drop(columns=["_chunk"])), partial_schema)
    short = one.groupBy("_bundle").applyInPandas(whole, schema)
    return short.unionByName(summaries.groupBy(*keys).applyInPandas(finish, schema))


def chunk_transform(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply row transforms one after another; Spark fuses them into one pass."""
    for step in steps:
        df = df.transform(step)
    return df


def parallel_apply(
    df: DataFrame, name: str, values: Sequence, function: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run one function for several parameter values as one job.

    The parameter becomes a key column of the rows, by which `function` groups.
    """
    return function(df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values]))))


def flag_pattern(flags: Sequence[str]) -> Column:
    """The values of the flags as one text, unknown ones included, so that equal rows are found by one key."""
    return F.concat_ws(",", *[F.coalesce(F.col(f).cast("string"), F.lit("?")) for f in flags])


def predictions_by_pattern(models: Mapping[str, PipelineModel], df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """_pattern and one probability column per target, for each distinct pattern of the flags.

    A flag that is NULL is unknown to every model that reads it, whose probability is NULL.
    """
    patterns = df.select(*flags, flag_pattern(flags).alias("_pattern")).groupBy("_pattern")
    out = patterns.agg(*[F.any_value(f).alias(f) for f in flags])
    for target, model in models.items():
        scored = apply_model(model, out)
        share = F.when(F.col("probability").isNotNull(), vector_to_array(known_vector("probability"))[1])
        out = scored.withColumn(f"_p_{target}", share).drop("features", "rawPrediction", "probability", "prediction")
    return out.select("_pattern", *[F.col(f"_p_{t}").alias(t) for t in models])


def used_flags(models: Mapping[str, PipelineModel]) -> list[str]:
    assembled = [c for m in models.values() for s in m.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    return list(dict.fromkeys(assembled))


def predictions_by_target(
    models: Mapping[str, PipelineModel], df: DataFrame, ids: Sequence[str]
) -> DataFrame:
    """One probability column per target for every row, NULL where a feature is NULL.

    All models score each distinct pattern of features once, and rows take the figures of
    their pattern: customers are many, patterns of flags are few.
    """
    flags = used_flags(models)
    figures = measured(predictions_by_pattern(models, df, flags))
    rows = df.select(*ids, flag_pattern(flags).alias("_pattern"))
    return rows.join(figures, "_pattern").select(*ids, *models)
