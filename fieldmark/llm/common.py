"""Column helpers shared by the text operators.  All of them are plain expressions."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_KEY = "__text_key"


def ship_package(spark: SparkSession) -> None:
    """Give this package's source to the Python workers, as `--py-files` would.

    For operators with Python functions, where the package is not installed on the
    executors.  Done once per application.
    """
    context = spark.sparkContext
    if getattr(context, "_fieldmark_shipped", False):
        return
    top = pathlib.Path(__file__).resolve().parent.parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="fieldmark-")) / "fieldmark.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(str(target))
    context._fieldmark_shipped = True


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body uses it.

    An expression used inside a higher-order function would be computed again
    for each element otherwise.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """Tells rows with one id and different texts apart; equal rows share it."""
    return F.xxhash64(whole_text(column))


def same_row(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the named columns, where NULL equals NULL."""
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


def running_starts(lengths: Column, chunk: int = 256) -> Column:
    """Sums of all earlier elements of an integer array, in chunks, so that the
    work stays near-linear for long arrays."""

    def prefix(array: Column, first: Column) -> Column:
        return F.aggregate(
            array,
            F.struct(F.array().cast("array<long>").alias("out"), first.cast("long").alias("sum")),
            lambda acc, x: F.struct(
                F.concat(acc["out"], F.array(acc["sum"])).alias("out"), (acc["sum"] + x).alias("sum")
            ),
            lambda acc: acc["out"],
        )

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def cut(array: Column) -> Column:
        last = F.call_function("div", F.size(array) - 1, F.lit(chunk))
        return F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.slice(array, (i * chunk + 1).cast("int"), chunk))

    def chunked(array: Column) -> Column:
        return let(
            cut(array),
            lambda parts: F.flatten(
                F.zip_with(parts, prefix(F.transform(parts, total), F.lit(0)), prefix)
            ),
        )

    return let(
        lengths,
        lambda a: F.when(F.size(a) == 0, F.array().cast("array<long>"))
        .when(F.size(a) <= chunk, prefix(a, F.lit(0)))
        .otherwise(chunked(a)),
    )


def match_spans(text: Column, pattern: str, guard: Column, context: int = 40) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,end,match,before>>.

    Places are in code points, end exclusive.  Places follow from the lengths of
    the matches and of what lies between them, so a text is read twice whatever
    the number of matches.  `before` holds the last `context` code points between
    the previous match and this one.  `guard` says cheaply whether there can be a match.
    """
    kind = "array<struct<start:long,end:long,match:string,before:string>>"

    def spans(matches: Column) -> Column:
        between = F.split(text, pattern, -1)
        return let(
            between,
            lambda parts: let(
                running_starts(
                    F.transform(matches, lambda m, i: (F.length(F.get(parts, i)) + F.length(m)).cast("long"))
                ),
                lambda starts: F.transform(
                    matches,
                    lambda m, i: F.struct(
                        (F.get(starts, i) + F.length(F.get(parts, i))).cast("long").alias("start"),
                        (F.get(starts, i) + F.length(F.get(parts, i)) + F.length(m)).cast("long").alias("end"),
                        m.alias("match"),
                        F.right(F.get(parts, i), F.lit(context)).alias("before"),
                    ),
                ),
            ),
        ).cast(kind)

    found = F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return let(
        found,
        lambda matches: F.when(F.coalesce(F.size(matches), F.lit(0)) > 0, spans(matches)).otherwise(
            F.array().cast(kind)
        ),
    )


def span_string(spans: Column, names: list[str]) -> Column:
    """`kind:start:end` of array<struct<start,order,end>>, comma-joined in array order."""
    kinds = F.array(*[F.lit(n) for n in names])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat(F.get(kinds, s["order"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ),
        ",",
    )
