"""Training functions.  Each returns a fitted pipeline that carries its features."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Bucketizer,
    OneHotEncoder,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.models.boosting import train_boosted_classes, weighted_trees
from fieldmark.models.cells import cells, fit_bins, in_few_tasks
from fieldmark.models.formula import formula_pipeline, unseen
from fieldmark.models.histograms import boosted, inner_cuts, spark_tree
from fieldmark.operators.metrics import regression_metrics
from fieldmark.operators.reshape import bind_metrics

SEED = 1234
# Spark ML trees are at most this deep.
DEEPEST = 30


def checked_depth(depth: int) -> int:
    if depth > DEEPEST:
        raise ValueError(f"trees are at most {DEEPEST} deep")
    return depth


def fit_kept(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """Fit while the rows are kept, as a fit passes over them several times."""
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(in_few_tasks(kept))
    finally:
        kept.unpersist()


def fit(df: DataFrame, features: Sequence[str], label: str, estimator: Estimator, *before: Estimator) -> PipelineModel:
    """Assemble the features and fit; rows with an unknown feature do not train.

    The fitted pipeline keeps such rows, and `apply_model` gives them no prediction.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    pipeline = Pipeline(stages=[assembler, *before, estimator])
    rows = df.select(*features, label).dropna()
    kept_already = df.storageLevel.useMemory or df.storageLevel.useDisk
    return pipeline.fit(in_few_tasks(rows)) if kept_already else fit_kept(pipeline, rows)


def apply_model(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All rows of `df` with the model's columns; NULL predictions where a feature is unknown
    or a level of a factor was not seen."""
    scored = model.transform(df)
    kinds = dict(scored.dtypes)
    assembled = [c for s in model.stages if isinstance(s, (VectorAssembler, Bucketizer)) for c in s.getInputCols()]
    missing = [
        F.col(f"`{c}`").isNull() | F.isnan(f"`{c}`") if kinds[c] in ("double", "float") else F.col(f"`{c}`").isNull()
        for c in assembled
        if c in kinds and c not in made_by(model)
    ]
    unknown = reduce(lambda found, c: found | c, missing + unseen(model, scored), F.lit(False))
    given = [c for c in ("prediction", "probability", "rawPrediction") if c in scored.columns and c not in df.columns]
    return scored.withColumns({c: F.when(~unknown, F.col(c)) for c in given})


def made_by(model: PipelineModel) -> set[str]:
    """Vectors and figures that stages after the first encoding make of known columns."""
    out: set[str] = set()
    for s in model.stages:
        for name in ("outputCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
            if s.hasParam(name) and s.isDefined(name):
                out.add(s.getOrDefault(name))
        if s.hasParam("outputCols") and s.isDefined("outputCols"):
            out |= set(s.getOrDefault("outputCols"))
    return out


def train_linear(df: DataFrame, features: Sequence[str], label: str, **params) -> PipelineModel:
    return fit(df, features, label, LinearRegression(labelCol=label, **params))


def train_logistic(df: DataFrame, features: Sequence[str], label: str, **params) -> PipelineModel:
    return fit(df, features, label, LogisticRegression(labelCol=label, family="binomial", **params))


def train_multinomial(df: DataFrame, features: Sequence[str], label: str, **params) -> PipelineModel:
    return fit(df, features, label, LogisticRegression(labelCol=label, family="multinomial", **params))


def train_poisson(df: DataFrame, features: Sequence[str], label: str, **params) -> PipelineModel:
    estimator = GeneralizedLinearRegression(labelCol=label, family="poisson", link="log", **params)
    return fit(df, features, label, estimator)


def train_tree(
    df: DataFrame, features: Sequence[str], label: str, classify: bool = True, depth: int = 5, **params
) -> PipelineModel:
    kind = DecisionTreeClassifier if classify else DecisionTreeRegressor
    return fit(df, features, label, kind(labelCol=label, maxDepth=checked_depth(depth), seed=SEED, **params))


def depth_sweep(
    df: DataFrame, features: Sequence[str], label: str, depths: Sequence[int] = (1, 2, 4, 8, 16), classify: bool = False
) -> dict[int, PipelineModel]:
    """One tree per depth on one stored copy of the rows."""
    kept = df.select(*features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {d: train_tree(kept, features, label, classify, d) for d in depths}
    finally:
        kept.unpersist()


def train_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    classify: bool = True,
    trees: int = 8,
    depth: int = 10,
    **params,
) -> PipelineModel:
    kind = RandomForestClassifier if classify else RandomForestRegressor
    estimator = kind(labelCol=label, numTrees=trees, maxDepth=checked_depth(depth), seed=SEED, **params)
    return fit(df, features, label, estimator)


def train_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    loss: str = "bernoulli",
    trees: int = 50,
    depth: int = 5,
    rate: float = 0.1,
    **params,
) -> PipelineModel:
    """Boosted trees: bernoulli (0/1 label), gaussian (number) or multinomial (0, 1, ..).

    Several classes are boosted jointly, see `boosting`.  Trees see features in bins only, so
    rows of equal bins are one weighted row, see `cells`.
    """
    if loss == "multinomial":
        return train_boosted_classes(df, features, label, trees, checked_depth(depth), rate, SEED, **params)
    kinds = {"gaussian": GBTRegressor, "bernoulli": GBTClassifier}
    if loss not in kinds:
        raise ValueError(f"unknown loss {loss}")
    estimator = kinds[loss](labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, seed=SEED, **params)
    if set(params) - {"minInstancesPerNode"}:
        return fit(df, features, label, estimator)
    kept = df.select(*features, label).dropna()
    if not (df.storageLevel.useMemory or df.storageLevel.useDisk):
        kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        binner = fit_bins(kept, features)
        least, total = params.get("minInstancesPerNode", 1), kept.count()
        if binner is None or 2 * least > total:
            return fit(kept, features, label, estimator)
        if loss == "bernoulli" and kept.filter(~F.col(label).isin(0, 1)).limit(1).count():
            raise ValueError(f"labels of {label} are 0 and 1")
        # The least number of rows of a node holds for the rows behind the cells.
        merged = cells(kept, binner, features, label, loss == "gaussian")
        rows = merged.select(*[f"`{c}`" for c in binner.getOutputCols()], F.col(label).cast("double"), "_n")
        (grown,) = boosted(rows, len(features), loss, [0.0], trees, checked_depth(depth), rate, least - 0.5)
    finally:
        kept.unpersist()
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    cuts = inner_cuts(binner.getSplitsArray())
    made = [spark_tree(tree, cuts) for tree in grown]
    model = weighted_trees(made, [1.0] + [rate] * (trees - 1), features=len(features), classify=loss == "bernoulli")
    return PipelineModel([assembler, model])


def train_mlp(
    df: DataFrame, features: Sequence[str], label: str, classes: int, hidden: int = 10, iterations: int = 100, **params
) -> PipelineModel:
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    net = MultilayerPerceptronClassifier(
        featuresCol="scaled",
        labelCol=label,
        layers=[len(features), hidden, classes],
        maxIter=iterations,
        seed=SEED,
        **params,
    )
    return fit(df, features, label, net, scaler)


def train_formula(df: DataFrame, formula: str, estimator: Estimator) -> PipelineModel:
    """Fit a formula with factor crosses such as `y ~ a + b:c`; the label is a number.

    Rows with an unknown value do not train.  See `formula` for the encoding.
    """
    pipeline, rows = formula_pipeline(df, formula, estimator)
    return fit_kept(pipeline, rows)


def declared_factor(spark, column: str, levels: Sequence[str]) -> list:
    """Index and one-hot stages for a factor with declared levels."""
    indexer = StringIndexerModel.from_labels(
        list(levels), inputCol=column, outputCol=f"{column}_at", handleInvalid="keep"
    )
    return [indexer, OneHotEncoder(inputCols=[f"{column}_at"], outputCols=[f"{column}_hot"])]


def one_model_per_target(
    df: DataFrame, flags: Sequence[str], at_once: int = 4, **params
) -> dict[str, PipelineModel]:
    """For each flag a logistic model of all the other flags.

    Customers with equal flags are merged into one weighted row first: the
    number of rows to train on is bounded by the number of flag patterns, not
    by the number of customers, and the fit is the same.
    """
    patterns = df.groupBy(*flags).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    patterns = patterns.persist(StorageLevel.MEMORY_AND_DISK)

    def train(target: str) -> PipelineModel:
        others = [f for f in flags if f != target]
        assembler = VectorAssembler(inputCols=others, outputCol="features", handleInvalid="keep")
        model = LogisticRegression(labelCol=target, weightCol="_weight", **params)
        return Pipeline(stages=[assembler, model]).fit(patterns)

    try:
        patterns.count()
        with ThreadPoolExecutor(at_once) as pool:
            return dict(zip(flags, pool.map(train, flags)))
    finally:
        patterns.unpersist()


def sweep_parameters(count: int, seed: int = 0) -> list[dict[str, float]]:
    """Random settings of a boosted model."""
    draw = random.Random(seed)
    return [
        {
            "rate": draw.uniform(0.0001, 0.4),
            "min_rows": draw.randint(1, 50),
            "trees": draw.randint(1, 100),
        }
        for _ in range(count)
    ]


def random_sweep(
    folded: DataFrame,
    fold: str,
    features: Sequence[str],
    label: str,
    settings: Sequence[Mapping[str, float]],
    train: Callable[[DataFrame, Mapping[str, float]], PipelineModel] | None = None,
    held_out: bool = False,
    at_once: int = 4,
) -> tuple[DataFrame, list[PipelineModel]]:
    """Setting i is trained on fold i and measured there, or on the next fold.

    `at_once` settings are fitted side by side.

    Returns the table of settings and errors, and the models.
    """
    if train is None:

        def train(df, s):
            return train_boosted(
                df,
                features,
                label,
                "gaussian",
                trees=int(s["trees"]),
                rate=s["rate"],
                minInstancesPerNode=int(s["min_rows"]),
            )

    count = len(settings)
    kept = folded.select(fold, *features, label).persist(StorageLevel.MEMORY_AND_DISK)

    def attempt(i: int) -> tuple[DataFrame, PipelineModel]:
        part = kept.filter(F.col(fold) == i)
        model = train(part, settings[i])
        tested = kept.filter(F.col(fold) == (i + 1) % count) if held_out else part
        found = regression_metrics(apply_model(model, tested), label, "prediction")
        # One row, computed here: the kept rows are freed at the end.
        row = df_of_one(found).withColumns({k: F.lit(v) for k, v in settings[i].items()})
        return row, model

    try:
        with ThreadPoolExecutor(at_once) as pool:
            done = list(pool.map(attempt, range(count)))
    finally:
        kept.unpersist()
    return bind_metrics({str(i): row for i, (row, _) in enumerate(done)}, "setting"), [m for _, m in done]


def df_of_one(found: DataFrame) -> DataFrame:
    """A table of figures as a table of its values; it has a row or a few."""
    return found.sparkSession.createDataFrame(found.collect(), found.schema)
