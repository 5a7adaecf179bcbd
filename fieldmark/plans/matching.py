"""Matching people to a project: pairs, boosted trees, scores above a threshold."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.models.boosting import weighted_trees
from fieldmark.models.histograms import boosted_blocks, spark_tree, wide_blocks, wide_cuts, wide_readers
from fieldmark.models.score import score_model, score_threshold
from fieldmark.models.train import SEED, checked_depth, fit_kept
from fieldmark.operators.joins import cross_join_score_input
from fieldmark.operators.rows import interaction_products


def pair_vectors(pairs: DataFrame, products: bool = False) -> DataFrame:
    """Feature vector of each pair: both topic arrays, and their products if asked.

    The thousands of products stay one array column, never columns of a table.
    """
    parts = [F.col("rt"), F.col("pt")]
    if products:
        pairs = interaction_products(pairs, "rt", "pt")
        parts.append(F.col("products"))
    return pairs.withColumn("features", array_to_vector(F.concat(*parts)))


def train_matcher(
    labelled: DataFrame,
    label: str = "label",
    trees: int = 50,
    depth: int = 5,
    rate: float = 0.2,
    leaf_rows: int = 10,
    products: bool = False,
) -> PipelineModel:
    """Boosted trees on pairs; a leaf has `leaf_rows` rows at least.

    Products are thousands of numbers a pair, so a fit with them keeps both arrays only, and makes
    the products anew in each pass.
    """
    if products:
        return train_on_products(labelled, label, trees, depth, rate, leaf_rows)
    vectors = pair_vectors(labelled, products).select("features", F.col(label).cast("double").alias(label))
    estimator = GBTClassifier(labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, minInstancesPerNode=leaf_rows, seed=SEED)
    return fit_kept(Pipeline(stages=[estimator]), vectors)


def train_on_products(labelled: DataFrame, label: str, trees: int, depth: int, rate: float, leaf_rows: int) -> PipelineModel:
    rows = labelled.select(*[F.col(c).cast("array<double>") for c in ("rt", "pt")], F.col(label).cast("double").alias(label))
    if rows.filter(F.col(label).isNull() | ~F.col(label).isin(0, 1)).limit(1).count():
        raise ValueError(f"labels of {label} are 0 and 1")
    if trees > 1:  # rows made again after a loss meet their margins
        rows = rows.sortWithinPartitions(F.xxhash64("rt", "pt", label))
    made, blocks = wide_blocks(rows)
    try:
        cuts = wide_cuts(blocks, True, SEED)
        (grown,) = boosted_blocks(blocks, len(cuts), "bernoulli", [0.0], trees, checked_depth(depth), rate, leaf_rows - 0.5, *wide_readers(cuts))
    finally:
        made.unpersist()
    found = [spark_tree(tree, cuts) for tree in grown]
    return PipelineModel([weighted_trees(found, [1.0] + [rate] * (trees - 1), features=len(cuts), classify=True)])


def match_project(
    model: PipelineModel, people: DataFrame, project: DataFrame, threshold: float, products: bool = False
) -> DataFrame:
    """People whose probability for the project reaches the threshold."""
    pairs = cross_join_score_input(people, project, {"ProjectId": "ProjectId", "pt": "pt"})
    scored = score_model(model, pair_vectors(pairs, products), ["PersonId", "ProjectId"], "Probability")
    return score_threshold(scored, "Probability", threshold)
