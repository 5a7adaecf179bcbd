"""Formulas such as `y ~ a + b:c` as expressions with declared levels.

The levels of all factors come from one pass over the rows.  Encoding is then part of the
row: an index from the level dictionary, a one-hot vector, products with numbers.  A level
that was not seen gets no prediction, and no row is lost, so nothing has to be joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    Interaction,
    OneHotEncoder,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts the levels of a cell; not used in text.
SEPARATOR = "\u001f"


@dataclass(frozen=True)
class Term:
    """Columns that are multiplied: numbers, and factors whose levels make one cell."""

    numbers: tuple[str, ...]
    factors: tuple[str, ...]

    @property
    def name(self) -> str:
        return "_".join(("_f", *self.numbers, *self.factors))

    @property
    def cell(self) -> str:
        """SQL of the cell of a row; NULL if a factor is unknown."""
        known = " AND ".join(f"`{c}` IS NOT NULL" for c in self.factors)
        parts = ", ".join(f"CAST(`{c}` AS STRING)" for c in self.factors)
        return f"CASE WHEN {known} THEN concat_ws('{SEPARATOR}', {parts}) END"

    @property
    def product(self) -> str:
        return " * ".join(f"CAST(`{c}` AS DOUBLE)" for c in self.numbers)


def terms_of(formula: str, schema: T.StructType) -> tuple[str, list[Term], bool]:
    """Label, terms, and whether there is a constant.  `a*b` is `a + b + a:b`; `- 1` drops the constant."""
    label, _, right = formula.partition("~")
    constant = True
    names: list[tuple[str, ...]] = []
    for part in right.replace("-", "+ -").split("+"):
        part = part.strip()
        if part in ("- 1", "-1", "0"):
            constant = False
        elif part.startswith("-"):
            raise ValueError(f"a formula can only leave out the constant, not {part}")
        elif "*" in part:
            columns = tuple(c.strip() for c in part.split("*"))
            for mask in range(1, 1 << len(columns)):
                names.append(tuple(c for i, c in enumerate(columns) if mask >> i & 1))
        elif part and part != "1":
            names.append(tuple(c.strip() for c in part.split(":")))
    known = {f.name: f.dataType for f in schema.fields}
    missing = {c for n in names for c in n if c not in known} | ({label.strip()} - set(known))
    if missing:
        raise ValueError(f"the formula names unknown columns: {sorted(missing)}")
    is_text = lambda c: isinstance(known[c], (T.StringType, T.BooleanType))
    if isinstance(known[label.strip()], T.StringType):
        raise ValueError("the label of a formula is a number")
    terms = [Term(tuple(c for c in n if not is_text(c)), tuple(c for c in n if is_text(c))) for n in dict.fromkeys(names)]
    return label.strip(), terms, constant


def levels_of(df: DataFrame, terms: Sequence[Term]) -> dict[str, list[str]]:
    """The cells of each term with factors, most frequent first, all from one pass.

    They are as many as the model has coefficients, which it holds in any case.
    """
    factored = [t for t in terms if t.factors]
    if not factored:
        return {}
    cells = F.explode(F.array(*[F.struct(F.lit(t.name).alias("term"), F.expr(t.cell).alias("level")) for t in factored]))
    counted = df.select(cells.alias("c")).filter("c.level IS NOT NULL").groupBy("c.term", "c.level").count()
    found: dict[str, list[str]] = {t.name: [] for t in factored}
    for term, level, _ in sorted(counted.collect(), key=lambda r: (-r["count"], r["level"])):
        found[term].append(level)
    return found


def encoding(terms: Sequence[Term], levels: dict[str, list[str]], constant: bool) -> list:
    """Stages that add `features`.

    With a constant, a factor by itself leaves out its rarest level, which is the one the others
    are measured against; without one the first factor keeps all.
    """
    made = [f"{t.cell} AS `{t.name}_cell`" for t in terms if t.factors]
    made += [f"{t.product} AS `{t.name}_value`" for t in terms if len(t.numbers) > 1 or (t.numbers and t.factors)]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")] if made else []
    inputs, whole = [], not constant
    for t in terms:
        if not t.factors:
            inputs.append(f"{t.name}_value" if len(t.numbers) > 1 else t.numbers[0])
            continue
        hot = f"{t.name}_hot"
        stages.append(StringIndexerModel.from_labels(levels[t.name], inputCol=f"{t.name}_cell", outputCol=f"{t.name}_at", handleInvalid="keep"))
        # The index of unknown cells is the last one, and it is the one that is dropped.
        stages.append(OneHotEncoder(inputCols=[f"{t.name}_at"], outputCols=[hot], dropLast=True))
        if len(t.factors) == 1 and not t.numbers:
            if not whole and len(levels[t.name]) > 1:
                stages.append(VectorSlicer(inputCol=hot, outputCol=f"{hot}_less", indices=list(range(len(levels[t.name]) - 1))))
                hot = f"{hot}_less"
            whole = False
        if t.numbers:
            if Term(t.numbers, ()) in terms and len(levels[t.name]) > 1:  # the slope of the last level is that of the number itself
                stages.append(VectorSlicer(inputCol=hot, outputCol=f"{hot}_less", indices=list(range(len(levels[t.name]) - 1))))
                hot = f"{hot}_less"
            stages.append(Interaction(inputCols=[f"{t.name}_value", hot], outputCol=f"{t.name}_product"))
            hot = f"{t.name}_product"
        inputs.append(hot)
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]


def formula_pipeline(df: DataFrame, formula: str, estimator: Estimator) -> tuple[Pipeline, DataFrame]:
    """The pipeline of a formula, and the rows it is fitted on: those without an unknown value."""
    label, terms, constant = terms_of(formula, df.schema)
    used = list(dict.fromkeys([label, *[c for t in terms for c in (*t.numbers, *t.factors)]]))
    rows = df.select(*used).dropna()
    levels = levels_of(rows, terms)
    empty = [n for n, found in levels.items() if not found]
    if empty:
        raise ValueError(f"no level of {empty} is known")
    stages = encoding(terms, levels, constant)
    return Pipeline(stages=[*stages, estimator]), rows.withColumn("label", F.col(label).cast("double"))


def unseen(model: PipelineModel, scored: DataFrame) -> list:
    """Conditions under which a row of `scored` has a level that the model does not know."""
    return [F.col(s.getOutputCol()) >= len(s.labels) for s in model.stages if isinstance(s, StringIndexerModel) and s.getOutputCol() in scored.columns]
