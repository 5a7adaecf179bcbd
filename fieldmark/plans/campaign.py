"""Campaign response: a model that is measured, registered and rebuilt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.models.train import apply_model, train_linear
from fieldmark.operators.metrics import auc
from fieldmark.operators.splits import stratified_split


def response_model(
    data: DataFrame, key: str, features: Sequence[str], label: str = "response", share: float = 0.75, train=train_linear
) -> tuple[PipelineModel, float]:
    """Model trained on a stratified share and its area under the curve on the rest."""
    training, testing = stratified_split(data, key, label, share)
    model = train(training, features, label)
    scored = apply_model(model, testing)
    return model, auc(scored.select(label, F.col("prediction").alias("score")), label, "score").first()["auc"]
