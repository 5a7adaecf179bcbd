"""Cross-sell: a model per product, and products ranked for each customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fieldmark.models.score import flag_pattern, predictions_by_pattern, used_flags
from fieldmark.models.train import one_model_per_target
from fieldmark.operators.reshape import pivot_ranked, unpivot_scores
from fieldmark.operators.windows import rank_products
from fieldmark.session import measured


def ranked_list(scores: DataFrame, customer: str, products: Sequence[str]) -> DataFrame:
    """Product1..ProductN per customer from one score column per product."""
    long = unpivot_scores(scores, [customer], products)
    return pivot_ranked(rank_products(long, customer, "product", "score"), customer, "rank", "product", len(products))


def recommendations(purchases: DataFrame, customer: str, products: Sequence[str], **params) -> DataFrame:
    """Products in the order of their models' probabilities, for every customer.

    Lists are made once per pattern of flags.  A model whose flags are not all known has no
    probability, and its product comes last.
    """
    known = purchases.dropna(subset=list(products))
    models = one_model_per_target(known, products, **params)
    flags = used_flags(models)
    lists = measured(ranked_list(predictions_by_pattern(models, purchases, flags), "_pattern", products))
    rows = purchases.select(customer, flag_pattern(flags).alias("_pattern"))
    return rows.join(lists, "_pattern").drop("_pattern")
