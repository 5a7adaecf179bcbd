"""Training rows of trees as weighted cells.

Trees compare features with a few cut points only.  Rows on the same side of all of them
behave as one row, so they are merged into one with their number as its weight: what a fit
passes over again and again is bounded by the cells in use, not by the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bins of a feature, as many as Spark ML's trees have, and how exact the cuts between them are.
BINS = 32
ACCURACY = 10_000
# Bins are 5 bits of a number; so many features share one.
BITS, IN_ONE = 5, 12
# A task of a pass over training rows has so many rows at least and, beyond one task a core, at most.
LEAST_ROWS, MOST_ROWS = 25_000, 1_000_000


def in_few_tasks(kept: DataFrame) -> DataFrame:
    """Kept rows in as many partitions as the cores can use, more only for many rows.

    A fit is hundreds of short jobs, and trees send the sums of all their nodes from every
    partition: each has its price by partition, whatever the rows in it.
    """
    n, cores = kept.count(), kept.sparkSession.sparkContext.defaultParallelism
    return kept.coalesce(max(1, min(cores, -(-n // LEAST_ROWS)), -(-n // MOST_ROWS)))


def fit_bins(rows: DataFrame, features: Sequence[str]) -> Bucketizer | None:
    """Cuts of each feature: between all its values if they are few, else at quantiles of all rows."""
    number = [F.col(f"`{f}`").cast("double") for f in features]
    about = rows.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(number)]).first()
    shares = [i / BINS for i in range(1, BINS)]
    few = {i for i in range(len(number)) if about[i] <= 2 * BINS}
    found = rows.agg(
        *[
            (F.collect_set(c) if i in few else F.percentile_approx(c, shares, ACCURACY)).alias(f"v{i}")
            for i, c in enumerate(number)
        ]
    ).first()
    cuts = []
    for i in range(len(number)):
        values = sorted(set(found[i] or []))
        if i in few and len(values) > BINS:
            values = [values[len(values) * k // BINS] for k in range(1, BINS)]
        # A value is in the bin below its cut; a few values are parted half way.
        ends = [(a + b) / 2 for a, b in zip(values, values[1:])] if i in few and len(values) <= BINS else values
        inner = sorted({math.nextafter(x, math.inf) for x in ends if math.isfinite(x)})
        cuts.append([-math.inf, *(inner or [0.0]), math.inf])
    if not cuts:
        return None
    return Bucketizer(inputCols=list(features), outputCols=[f"_bin_{f}" for f in features], splitsArray=cuts, handleInvalid="keep")


def cells(rows: DataFrame, binner: Bucketizer, features: Sequence[str], label: str, mean: bool = False) -> DataFrame:
    """Bins, label and `_n`, the rows behind; with `mean` one row per cell with its mean label.

    The sums by which squared errors are cut are the same with the mean.
    """
    binned = binner.transform(rows)
    names = binner.getOutputCols()
    packs: list[Column] = []
    for start in range(0, len(names), IN_ONE):
        part = [F.shiftleft(F.col(f"`{n}`").cast("long"), BITS * k) for k, n in enumerate(names[start : start + IN_ONE])]
        packs.append(reduce(lambda a, b: a.bitwiseOR(b), part).alias(f"_p{start // IN_ONE}"))
    by = [f"_p{i}" for i in range(len(packs))]
    packed = binned.select(*packs, F.col(label))
    if mean:
        merged = packed.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("_n"), F.avg(label).alias(label))
    else:
        merged = packed.groupBy(*by, label).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    bins = [
        F.shiftright(f"_p{i // IN_ONE}", BITS * (i % IN_ONE)).bitwiseAND(F.lit(2**BITS - 1)).cast("double").alias(n)
        for i, n in enumerate(names)
    ]
    return merged.select(*bins, label, "_n")
