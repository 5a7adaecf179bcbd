"""How filters on texts interact: which documents each removes, in every order of filters.

Filters that look at one text are expressions.  Copies are found by an existential
self-join: a left-semi join on hash, exact text and a smaller id.  The ids of both kinds of
failures are united, and bits are combined per document; orders are then arithmetic on the
few combinations of bits that occur.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.common import let, text_key, whole_text
from fieldmark.session import measured

# Fixed values of the five filters: the blanks between words, capital letters, signs.
BLANKS = r"[\x20\x09-\x0D]+"
CAPITALS = "[A-Z]"
SIGNS = "[#$%&*|]"
MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
COPIES = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters A to D on a text that is not NULL."""
    words = F.array_remove(F.split(text, BLANKS), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, CAPITALS, ""))
    few = let(words, lambda w: F.struct((F.size(w) < MIN_WORDS).alias("A"), (F.size(F.array_distinct(w)) * 100 < F.size(w) * MIN_DISTINCT).alias("B")))
    return {
        "A": few["A"],
        "B": few["B"],
        "C": capitals * 100 > F.length(text) * MAX_CAPITALS,
        "D": text.rlike(SIGNS),
    }


def copies_of_smaller(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows whose whole text stands under a smaller id: the id, the text's hash, and `keep`.

    Hashes that one id alone has drop out first, by a join of hash and id only.  Of what is
    left one row per distinct text, with its smallest id, is the right side of the semi-join,
    so a group of copies meets a single row, whatever its size, and a large group can be
    split.  A NULL text is an empty one; rows without an id are no copies and make none.
    """
    rows = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("__id"), text_key(text).alias("__hash"), whole_text(text).alias("__text"), *keep
    )
    held = rows.groupBy("__hash").agg(F.min("__id").alias("__first"), F.max("__id").alias("__last"))
    shared = measured(held.filter("__first < __last").select("__hash"))
    likely = rows.join(shared, "__hash", "left_semi")
    firsts = likely.groupBy("__hash", "__text").agg(F.min("__id").alias("__first"))
    left, right = likely.alias("l"), firsts.alias("r")
    same = (F.col("l.__hash") == F.col("r.__hash")) & (F.col("l.__text") == F.col("r.__text")) & (F.col("r.__first") < F.col("l.__id"))
    return left.join(right, same, "left_semi").drop("__text")


def failure_bits(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang", filters: Mapping[str, Column] | None = None) -> DataFrame:
    """(__id, __part, __bits, __n): how many rows of an id and part have which failures.

    `filters` names conditions on one text in the order of their bits; copies are the last bit.
    Rows are told apart by id, text and part, so several texts of one id are judged each by
    itself, and equal rows count as often as they stand there.
    """
    filters = filters or text_filters(whole_text(text))
    # A NULL is a part like an empty string.
    part_of = F.coalesce(F.col(part).cast("string"), F.lit("")).alias("__part")
    bits = F.lit(0)
    for i, fails in enumerate(filters.values()):
        bits = bits + F.when(fails, 1 << i).otherwise(0)
    key = ["__id", "__hash", "__part"]
    seen = docs.select(F.col(doc_id).alias("__id"), text_key(text).alias("__hash"), part_of, bits.cast("int").alias("__bits"), F.lit(1).cast("long").alias("__one"))
    copied = copies_of_smaller(docs.withColumn("__part", part_of), text, doc_id, ("__part",))
    found = seen.unionByName(copied.select(*key, F.lit(1 << len(filters)).alias("__bits"), F.lit(0).cast("long").alias("__one")))
    return found.groupBy(*key).agg(F.bit_or("__bits").alias("__bits"), F.sum("__one").alias("__n")).drop("__hash")


def filter_interactions(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    part: str = "lang",
    filters: Mapping[str, Column] | None = None,
    copies: str = COPIES,
) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    part, filter_order, step, kept (after the step), removed (at it), redundant (failing
    its filter, removed before), unique_fails (failing no other filter), good_lost and
    toxic_lost (removed, with a label `quality` or `toxic` of 1), and shapley: what its
    filter removes, summed over all orders.  A document failing k filters is removed first
    by each of them in 1 / k of the orders, so that sum needs no walk through them.

    Several label rows of one id count as one with the larger values; NULL labels as 0.
    A table without rows has no parts.
    """
    filters = filters or text_filters(whole_text(text))
    names = [*filters, copies]
    if any(len(n) != 1 for n in names) or len(set(names)) < len(names):
        raise ValueError("filters are named by different single letters")
    documents = failure_bits(docs, text, doc_id, part, filters)
    marks = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__of")).agg(F.max("quality").alias("__good"), F.max("toxic").alias("__toxic"))
    marked = documents.join(marks, documents["__id"] == marks["__of"], "left")
    flags = [F.coalesce(F.col(c) == 1, F.lit(False)).alias(c) for c in ("__good", "__toxic")]
    cells = marked.groupBy("__part", "__bits", *flags).agg(F.sum("__n").alias("__n"))

    orders = ["".join(p) for p in permutations(names)]
    steps = [
        (order, i + 1, 1 << names.index(name), sum(1 << names.index(n) for n in order[:i]))
        for order in orders
        for i, name in enumerate(order)
    ]
    fields = "array<struct<filter_order:string,step:int,own:int,before:int>>"
    constant = F.from_json(F.lit("[" + ",".join(f'{{"filter_order":"{o}","step":{s},"own":{w},"before":{b}}}' for o, s, w, b in steps) + "]"), fields)
    spread = cells.select("*", F.explode(constant).alias("__s"))
    own, n = F.col("__s.own"), F.col("__n")
    fails = F.col("__bits").bitwiseAND(own) != 0
    earlier = F.col("__bits").bitwiseAND(F.col("__s.before")) != 0

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    share = n * F.call_function("div", F.lit(len(orders)), F.bit_count("__bits"))
    return spread.groupBy(F.col("__part").alias("part"), F.col("__s.filter_order").alias("filter_order"), F.col("__s.step").alias("step")).agg(
        rows_where(~fails & ~earlier).alias("kept"),
        rows_where(fails & ~earlier).alias("removed"),
        rows_where(fails & earlier).alias("redundant"),
        rows_where(F.col("__bits") == own).alias("unique_fails"),
        rows_where(fails & ~earlier & F.col("__good")).alias("good_lost"),
        rows_where(fails & ~earlier & F.col("__toxic")).alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).alias("shapley"),
    )
