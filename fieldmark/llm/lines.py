"""Line dedup: a line that stands in several documents stays in the first of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.common import TEXT_KEY, let, text_key, whole_text

# The blanks [\x20\x09-\x0D] and the letters of the line key.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def bare_line(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased.

    `lower` does this for lines in ASCII, and is several times faster.
    """
    bare = bare_line(line)
    return F.when(F.octet_length(line) == F.length(line), F.lower(bare)).otherwise(
        F.translate(bare, UPPER, UPPER.lower())
    )


def without_positions(lines: Column, dropped: Column) -> Column:
    """The lines left when those at the sorted positions `dropped` go, joined by newlines.

    What lies between two dropped lines is taken as a slice, so the work is linear.
    """

    def piece(lines: Column, gone: Column, i: Column) -> Column:
        start = F.coalesce(F.when(i > 0, F.get(gone, i - 1) + 1), F.lit(0))
        end = F.coalesce(F.get(gone, i), F.size(lines))
        return F.slice(lines, start + 1, end - start)

    return let(
        F.struct(lines.alias("lines"), dropped.alias("gone")),
        lambda x: F.array_join(
            F.flatten(
                F.transform(F.sequence(F.lit(0), F.size(x["gone"])), lambda i: piece(x["lines"], x["gone"], i))
            ),
            "\n",
        ),
    )


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Drop lines whose key stands in `min_docs` documents or more, except in the smallest id.

    Adds n_lines, n_dropped and kept_text to the rows of `docs`.  Lines move as two
    64-bit hashes; a document's text moves once, to meet the positions it loses.
    Counting and the minimum id are pre-aggregated, and a key that holds a large
    part of all lines is split in the join at run time.

    A NULL or empty text is one empty line.  A row without an id keeps all lines
    and counts for no key.  Rows of one id are one document: equal rows get equal
    results, and a key needs another id to be repeated.  Extra columns stay.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    columns = docs.columns
    base = docs.withColumn(TEXT_KEY, text_key(text))
    key = line_key(F.col("__line"))
    lines = (
        base.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
        .select(F.col(doc_id).alias("__id"), F.col(TEXT_KEY).alias("__of"), F.posexplode(text_lines(F.col(text))).alias("__pos", "__line"))
        .filter(F.length(bare_line(F.col("__line"))) >= min_chars)
        .withColumn("__key", key)
        .select("__id", "__of", "__pos", F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(17), "__key").alias("__h2"))
    )
    held = lines.groupBy("__h1", "__h2")
    if min_docs == 2:
        repeated = held.agg(F.min("__id").alias("__first"), F.max("__id").alias("__last")).filter("__first < __last").drop("__last")
    else:
        repeated = held.agg(F.min("__id").alias("__first"), F.count_distinct("__id").alias("__n")).filter(F.col("__n") >= min_docs).drop("__n")
    gone = (
        lines.join(repeated, ["__h1", "__h2"])
        .filter(F.col("__id") > F.col("__first"))
        .groupBy("__id", "__of")
        .agg(F.array_sort(F.collect_set("__pos")).alias("__gone"))
    )
    joined = base.join(gone, (base[doc_id] == gone["__id"]) & (base[TEXT_KEY] == gone["__of"]), "left")
    body = whole_text(text)
    return joined.select(
        *[base[c] for c in columns],
        F.size(text_lines(body)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("__gone").isNull(), body).otherwise(without_positions(text_lines(body), F.col("__gone"))).alias("kept_text"),
    )
