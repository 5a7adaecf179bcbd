"""Typed file and table sources, and the sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_source(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    header: bool = True,
    sep: str = ",",
    null_value: str = "",
    mode: str = "FAILFAST",
    **options: str,
) -> DataFrame:
    """Delimited text into a declared schema; a malformed line stops the load."""
    reader = spark.read.schema(schema).option("header", header).option("sep", sep)
    reader = reader.option("nullValue", null_value).option("mode", mode)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.csv(path if isinstance(path, str) else list(path))


def table_source(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Parquet table with a column list and row filter that reach the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def jdbc_source(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 1,
    fetch_rows: int = 50_000,
    **options: str,
) -> DataFrame:
    """Database table or query, read in parallel ranges of a number column."""
    reader = spark.read.format("jdbc").options(url=url, fetchsize=str(fetch_rows), **options)
    if partition_column and bounds:
        return reader.options(
            dbtable=f"({query}) source",
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(parts),
        ).load()
    return reader.option("query", query).load()


def load_many(
    spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, T.StructType | str], **options
) -> dict[str, DataFrame]:
    """One typed source per named file; nothing is read until it is used."""
    missing = set(paths) - set(schemas)
    if missing:
        raise KeyError(f"no schema for {sorted(missing)}")
    return {name: csv_source(spark, path, schemas[name], **options) for name, path in paths.items()}


def strip_quotes(df: DataFrame, columns: Sequence[str] | None = None, mark: str = '"') -> DataFrame:
    """Remove a quote mark from text columns (all of them by default)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.replace(F.col(c), F.lit(mark), F.lit("")) for c in columns})


def overwrite_sink(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table by the rows of `df` and return the stored table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_sink(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Add rows to the table and return the stored table."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_layout(
    df: DataFrame,
    path: str,
    compression: str = "zstd",
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    cluster: bool = False,
) -> DataFrame:
    """The same rows in another physical form.

    `sort_by` orders rows within files, so row groups can be skipped by their
    min and max; with `cluster` the rows are first range-partitioned on those
    columns, so whole files can be skipped too.
    """
    if cluster and sort_by:
        df = df.repartitionByRange(*[F.col(c) for c in [*partition_by, *sort_by]])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode("overwrite").option("compression", compression).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)
