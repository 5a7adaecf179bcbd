"""Customer churn: purchase features before, and a tag for, the churn period."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.models.score import score_model
from fieldmark.models.train import train_boosted
from fieldmark.operators.aggregates import customer_features, customer_ratios
from fieldmark.operators.joins import anti_join
from fieldmark.operators.metrics import auc
from fieldmark.operators.splits import repeatable_split


def churn_tags(activities: DataFrame, churn_days: int, threshold: int = 0) -> DataFrame:
    """Tag of each customer active before the churn period.

    Overall and earlier purchases are counted in the same pass, so the join of
    the two counts is not needed.
    """
    cutoff = activities.agg(F.max("TransactionTime").alias("m")).scalar() - F.make_dt_interval(
        days=F.lit(churn_days)
    )
    early = F.col("TransactionTime") <= cutoff
    counts = activities.groupBy("UserId").agg(
        F.count("TransactionId").alias("_all"),
        F.count(F.when(early, F.col("TransactionId"))).alias("_early"),
        F.count_if(early).alias("_rows"),
    )
    churned = F.col("_all") - F.col("_early") <= threshold
    return counts.filter(F.col("_rows") > 0).select(
        "UserId",
        F.when(churned, "Churner").otherwise("Nonchurner").alias("Tag"),
        F.when(churned, "1").otherwise("0").alias("TagId"),
    )


def churn_features(activities: DataFrame, users: DataFrame, churn_days: int) -> DataFrame:
    """Features of each customer with the profile columns."""
    features = customer_ratios(customer_features(activities, churn_days))
    profile = users.select("UserId", "Age", "Address", "Gender", "UserType")
    return features.join(profile, "UserId", "left")


def churn_training_set(
    activities: DataFrame, users: DataFrame, churn_days: int, threshold: int = 0
) -> DataFrame:
    """Features and tags, one row per customer."""
    return churn_features(activities, users, churn_days).join(
        churn_tags(activities, churn_days, threshold), "UserId", "inner"
    )


def churn_scores(
    tagged: DataFrame,
    features: Sequence[str],
    percent: int = 70,
    train: Callable[[DataFrame, Sequence[str], str], PipelineModel] = train_boosted,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Model of a share of the customers, scores of the others, and the area under the curve.

    `tagged` has UserId, TagId and the features; a customer without some feature gets
    no score and does not count in the area.
    """
    labelled = tagged.withColumn("label", F.col("TagId").cast("int"))
    training, _ = repeatable_split(labelled, "UserId", percent)
    model = train(training, features, "label")
    scored = score_model(model, anti_join(labelled, training, ["UserId"]), ["UserId", "label"])
    return model, scored, auc(scored, "label", "score")
