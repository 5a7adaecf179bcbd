"""I-Match fingerprints: hashes of the mid-frequency terms of a document.

Terms within a band of inverse document frequency are kept, sorted and hashed, not once but
for many randomised subsets of the lexicon, so that an edit changes some hashes and not all.
The subsets get thinner as documents get longer: at level L one term in 2 to the L is in
the lexicon, which is dealt out to SUBSETS subsets, and a document is hashed at the level
at which a subset holds about one of its terms, and at the next.  Those serve for likeness.
For equality a fingerprint also has hashes of SUBSETS random subsets that hold three
quarters of the lexicon at any length, so that all terms of the band count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.common import let, text_key, whole_text
from fieldmark.operators.ordered import sorted_positions
from fieldmark.session import stored

SUBSETS = 32
MIN_DOCS = 2
MAX_SHARE = 0.25
EMPTY = ".."
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"

KEY = ["__id", "__no_id", "__of"]


def with_key(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Columns that tell documents apart: the id, whether there is none, the text's hash."""
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0).cast("long")).alias("__id"),
        F.col(doc_id).isNull().alias("__no_id"),
        text_key(text).alias("__of"),
        whole_text(text).alias("__text"),
    )


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct lower-case words."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def sampled(h: Column, level: Column) -> Column:
    """Whether a term belongs to the lexicon of a level; levels are nested."""
    return F.call_function("mod", F.shiftrightunsigned(h, 20), F.call_function("shiftleft", F.lit(1).cast("long"), level)) == 0


def level_of(terms: Column) -> Column:
    return F.greatest(F.floor(F.log2(F.greatest(F.size(terms), F.lit(1)) / (SUBSETS / 2))), F.lit(0)).cast("int")


def code(part: Column) -> Column:
    """Two characters for an array of terms."""
    letters = F.lit(ALPHABET)
    return let(
        F.pmod(F.xxhash64(part), F.lit(4096)).cast("int"),
        lambda v: F.concat(F.substring(letters, F.call_function("div", v, F.lit(64)).cast("int") + 1, F.lit(1)), F.substring(letters, v % 64 + 1, F.lit(1))),
    )


def whole_hashes(terms: Column) -> Column:
    """Two characters for each of SUBSETS seeded subsets that hold three quarters of the lexicon, whatever the length."""
    marked = F.transform(terms, lambda h: F.struct(h.alias("h"), F.xxhash64(h, F.lit(71)).bitwiseOR(F.xxhash64(h, F.lit(72))).alias("in")))
    return let(
        marked,
        lambda t: F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.lit(SUBSETS - 1)),
                lambda k: code(F.transform(F.filter(t, lambda x: F.getbit(x["in"], k) == 1), lambda x: x["h"])),
            ),
            "",
        ),
    )


def subset_hashes(terms: Column, level: Column) -> Column:
    """Two characters for each subset: hash of its terms in the document, sorted; EMPTY without any."""

    return let(
        F.filter(terms, lambda h: sampled(h, level)),
        lambda there: F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.lit(SUBSETS - 1)),
                lambda k: let(
                    F.filter(there, lambda h: F.pmod(h, F.lit(SUBSETS)) == k),
                    lambda part: F.when(F.size(part) == 0, F.lit(EMPTY)).otherwise(code(part)),
                ),
            ),
            "",
        ),
    )


def fingerprint_text(terms: Column, level: Column, sha: Column) -> Column:
    """`level:hashes of the level:hashes of the next:hashes of the large subsets`; without terms a hash of the whole text."""
    return F.when(F.coalesce(F.size(terms), F.lit(0)) == 0, F.concat(F.lit("text:"), F.substring(sha, 1, 32))).otherwise(
        let(
            F.array_sort(terms),
            lambda t: F.concat_ws(":", level.cast("string"), subset_hashes(t, level), subset_hashes(t, level + 1), whole_hashes(t)),
        )
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes among those that are not empty in both, at a common level.

    Without a common level the documents differ in length by a factor of two or more, which counts as 0.
    """

    def share(x: Column, y: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.lit(SUBSETS - 1)),
            lambda k: F.struct(F.substring(x, k * 2 + 1, F.lit(2)).alias("x"), F.substring(y, k * 2 + 1, F.lit(2)).alias("y")),
        )
        return let(
            F.filter(pairs, lambda p: (p["x"] != EMPTY) | (p["y"] != EMPTY)),
            lambda used: F.when(F.size(used) == 0, F.lit(0.0)).otherwise(F.size(F.filter(used, lambda p: p["x"] == p["y"])) / F.size(used)),
        )

    def compared(parts: Column) -> Column:
        x, y = parts["x"], parts["y"]
        gap = F.get(x, F.lit(0)).try_cast("int") - F.get(y, F.lit(0)).try_cast("int")
        return (
            F.when(gap == 0, share(F.get(x, F.lit(1)), F.get(y, F.lit(1))))
            .when(gap == -1, share(F.get(x, F.lit(2)), F.get(y, F.lit(1))))
            .when(gap == 1, share(F.get(x, F.lit(1)), F.get(y, F.lit(2))))
            .otherwise(F.lit(0.0))
        )

    return F.when(a == b, F.lit(1.0)).otherwise(let(F.struct(F.split(a, ":").alias("x"), F.split(b, ":").alias("y")), compared))


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """Each text once, however many rows hold it."""
    return docs.groupBy(F.sha2(whole_text(text), 256).alias("__sha")).agg(F.first(whole_text(text)).alias("__text")).select("__text")


def lexicon(texts: DataFrame, min_docs: int) -> DataFrame:
    """Hashes of the terms in `min_docs` distinct texts at least, and in how many."""
    held = texts.select(F.explode(term_hashes(F.col("__text"))).alias("__h")).groupBy("__h").agg(F.count(F.lit(1)).alias("__df"))
    return held.filter(F.col("__df") >= min_docs)


def with_mark(terms: Column, mark: int) -> Column:
    return F.transform(terms, lambda h: F.struct(h.alias("h"), F.lit(mark).alias("m")))


def in_band(terms: Column, most: float) -> Column:
    """Terms in `most` texts at most, and the rarer half in any case, of array<struct<df,h>> with a NULL df below the band.

    Where a group of near copies holds a large share of all texts, its terms are above the
    band; the rarer half of each document's terms is nearly the same in all of the group.
    A text with no term in enough texts keeps all its terms.
    """
    return let(
        F.array_sort(F.filter(terms, lambda t: t["df"].isNotNull())),
        lambda known: F.transform(
            F.when(F.size(known) == 0, terms).otherwise(F.filter(known, lambda t, i: (t["df"] <= most) | (i * 2 < F.size(known)))),
            lambda t: t["h"],
        ),
    )


def ring(docs: DataFrame) -> DataFrame:
    """Documents in a ring by descending id: place, length, and what the one before needs of each.

    Only ids, text hashes and lengths move.
    """
    one = docs.groupBy(*KEY).agg(F.max(F.length("__text")).alias("__n"))
    placed = stored(
        sorted_positions(one, [F.col("__no_id"), F.col("__id").desc(), F.col("__of")], name="__pos", size="__around"), "ring"
    )
    before = placed.select(
        F.pmod(F.col("__pos") + 1, F.col("__around")).alias("__pos"),
        *[F.col(k).alias(f"__before{k}") for k in KEY],
        F.floor(F.col("__n") / 3).cast("int").alias("__need"),
    )
    return placed.join(before, "__pos")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Fingerprint of each document and of its edited text, and how alike they are.

    The edited text has the last third (rounded down) replaced by as many first code
    points of the next document by descending id; after the last comes the first.
    Gives doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, one row per row.

    A text moves once, to its place in the ring, and of the next document only the part
    that is needed.  Of the terms only hashes move, with one row for a term of both texts.

    A NULL text is empty.  A row without an id comes after all others.  Rows of one id
    and different texts are neighbours by hash of the text; equal rows are one document
    and get equal results.  Document frequencies count distinct texts.  A text without a
    word has a hash of itself.
    """
    keyed = with_key(docs, text, doc_id)
    around = ring(keyed)
    placed = keyed.join(around, KEY)
    heads = (
        placed.select(*[F.col(f"__before{k}").alias(k) for k in KEY], F.substring(F.col("__text"), F.lit(1), F.col("__need")).alias("__head"))
        .groupBy(*KEY)
        .agg(F.min("__head").alias("__head"))
    )
    kept = F.substring(F.col("__text"), F.lit(1), (F.col("__n") - F.floor(F.col("__n") / 3)).cast("int"))
    both = (
        placed.join(heads, KEY)
        .withColumn("__edited", F.concat(kept, F.col("__head")))
        .withColumn("__a", term_hashes(F.col("__text")))
        .withColumn("__e", term_hashes(F.col("__edited")))
    )
    rows = both.select(
        *KEY,
        "__pos",
        "__around",
        "__n",
        F.sha2("__text", 256).alias("__sha"),
        F.sha2("__edited", 256).alias("edited_sha256"),
        "__a",
        "__e",
    )
    rows = stored(rows, "terms")
    shared = F.array_intersect("__a", "__e")
    parts = ((shared, 3), (F.array_except("__a", "__e"), 1), (F.array_except("__e", "__a"), 2))
    flagged = F.concat(*[with_mark(t, m) for t, m in parts])
    terms = rows.select("__pos", F.explode(flagged).alias("x")).select("__pos", F.col("x.h").alias("__h"), F.col("x.m").alias("__m"))
    texts = distinct_texts(docs, text)
    most = max_share * texts.count()
    known = terms.join(lexicon(texts, min_docs), "__h", "left")
    inside = known.groupBy("__pos").agg(F.collect_set(F.struct(F.col("__df").alias("df"), F.col("__h").alias("h"), F.col("__m").alias("m"))).alias("__terms"))

    def of(bit: int) -> Column:
        return in_band(F.filter("__terms", lambda t: t["m"].bitwiseAND(bit) != 0), most)

    described = rows.drop("__a", "__e").join(inside, "__pos", "left").withColumn("__ba", of(1)).withColumn("__be", of(2))
    prints = stored(
        described.select(
            *KEY,
            "__pos",
            "__around",
            F.col("__n").cast("long").alias("n_chars"),
            "edited_sha256",
            fingerprint_text(F.col("__ba"), level_of(F.col("__ba")), F.col("__sha")).alias("fingerprint"),
            fingerprint_text(F.col("__be"), level_of(F.col("__be")), F.col("edited_sha256")).alias("edited_fingerprint"),
        ),
        "prints",
    )
    after = prints.groupBy(F.pmod(F.col("__pos") - 1, F.col("__around")).alias("__pos")).agg(F.min("fingerprint").alias("__next"))
    return prints.join(after, "__pos").select(
        F.when(~F.col("__no_id"), F.col("__id")).alias(doc_id),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("__next")).alias("near_next"),
    )
