"""Samples and splits.  All are functions of key hashes, so they repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmark.functions.numbers import hash_order, hash_percent
from fieldmark.operators.ordered import hash_cell, positions


def repeatable_split(df: DataFrame, key: str, percent: int = 70) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the hash of the key; no shuffle, no stored sample."""
    inside = hash_percent(F.col(key)) < percent
    return df.filter(inside), df.filter(~inside)


def with_hash_rank(
    df: DataFrame, key: str, keys: Sequence[str] = (), name: str = "_rank", size: str = "_size", digits: int = 4
) -> DataFrame:
    """Position of each row in its group along the hash of a unique key.

    Hash prefixes of `digits` hex digits cut even a single huge group into equal cells.
    """
    ordered = df.withColumn("_hash", hash_order(F.col(key)))
    return positions(ordered, keys, ["_hash", key], hash_cell(F.col(key), digits), name, size).drop("_hash")


def stratified_split(
    df: DataFrame, key: str, label: str, share: float = 0.75
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with ceil(share x n) rows of every class in train."""
    ranked = with_hash_rank(df, key, [label])
    inside = F.col("_rank") < F.ceil(F.col("_size") * F.lit(share))
    return (
        ranked.filter(inside).drop("_rank", "_size"),
        ranked.filter(~inside).drop("_rank", "_size"),
    )


def time_split_gap(df: DataFrame, time: str, train_before, test_after) -> tuple[DataFrame, DataFrame]:
    """Train strictly before the one, test strictly after the other time."""
    return df.filter(F.col(time) < train_before), df.filter(F.col(time) > test_after)


def series_tail_split(
    df: DataFrame, pos: str, size: str, test_rows: int
) -> tuple[DataFrame, DataFrame]:
    """The last rows of each series are the test set."""
    is_test = F.col(pos) >= F.col(size) - test_rows
    return df.filter(~is_test), df.filter(is_test)


def disjoint_folds(
    df: DataFrame, key: str, folds: int, exact: bool = False, name: str = "fold"
) -> DataFrame:
    """Fold number 0..folds-1 of each row.

    By default the hash decides and the sizes are nearly equal.  `exact` deals
    floor(n / folds) rows to every fold; the rows left over get NULL.
    """
    if not exact:
        head = F.conv(F.substring(hash_order(F.col(key)), 1, 8), 16, 10).cast("bigint")
        return df.withColumn(name, (head % folds).cast("int"))
    ranked = with_hash_rank(df, key)
    each = F.floor(F.col("_size") / folds)
    fold = F.floor(F.try_divide(F.col("_rank"), each)).cast("int")
    return ranked.withColumn(name, F.when(F.col("_rank") < each * folds, fold)).drop("_rank", "_size")


def downsample(df: DataFrame, keys: Sequence[str], key: str, ratio: float) -> DataFrame:
    """floor(ratio x n) rows of every series."""
    ranked = with_hash_rank(df, key, keys)
    return ranked.filter(F.col("_rank") < F.floor(F.col("_size") * F.lit(ratio))).drop("_rank", "_size")


def hash_cut(df: DataFrame, key: str, n: int, largest: int = 100_000) -> tuple[str, int]:
    """(prefix, need): the n rows with the smallest hashes are all rows whose hash lies below
    `prefix`, and the first `need` of those that start with it.

    Rows are counted by the leading digits of their hash; only the cell in which row n lies is
    counted again by further digits, until it has no more than `largest` rows.  The driver sees
    the counts of 4,096 cells at a time.
    """
    prefix, need = "", n
    while len(prefix) < 30:
        inside = df.filter(F.startswith(full_hash(key), F.lit(prefix))) if prefix else df
        cells = inside.groupBy(F.substring(full_hash(key), 1, len(prefix) + 3).alias("cell")).count().collect()
        for cell, size in sorted((r["cell"], r["count"]) for r in cells):
            if need <= size:
                prefix = cell
                break
            need -= size
        else:  # fewer rows than asked for
            return "g", 0
        if size <= largest or len(prefix) < 3:
            break
    return prefix, need


def full_hash(key: str) -> Column:
    """The hash that orders rows; a NULL key comes first."""
    return F.coalesce(hash_order(F.col(key)), F.lit(""))


def below_cut(df: DataFrame, key: str, cut: tuple[str, int]) -> DataFrame:
    """The rows of `hash_cut`, filtered where they lie; only one small cell is ordered."""
    prefix, need = cut
    lower = df.filter(full_hash(key) < prefix)
    if not need:
        return lower
    edge = df.filter(F.startswith(full_hash(key), F.lit(prefix)))
    return lower.unionByName(edge.orderBy(full_hash(key), key).limit(need))


def sample_n(df: DataFrame, key: str, train_rows: int, test_rows: int) -> tuple[DataFrame, DataFrame]:
    """n training rows and m other rows to test on: the first by hash rank.

    Rows are found by counts of hash cells, so nothing but the rows at the two cuts is
    ordered or moved, however large the table is.
    """
    first, last = (hash_cut(df, key, n) for n in (train_rows, train_rows + test_rows))
    learn = below_cut(df, key, first)
    # Between the cuts: whole cells, the rest of the first cut's cell, the start of the last one's.
    both = below_cut(df, key, last)
    if first[0] == "g":
        return learn, both.limit(0)
    rest = both.filter(full_hash(key) >= first[0])
    edge = F.startswith(full_hash(key), F.lit(first[0]))
    after = Window.orderBy(full_hash(key), key)
    held = rest.filter(edge).withColumn("_rank", F.row_number().over(after)).filter(F.col("_rank") > first[1]).drop("_rank")
    return learn, rest.filter(~edge).unionByName(held)
