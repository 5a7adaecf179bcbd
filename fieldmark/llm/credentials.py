"""Secrets: patterns for credentials, and linking of parts that mean something only together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.common import TEXT_KEY, match_spans, text_key, whole_text
from fieldmark.session import stored

KINDS = ["assign", "access", "hex", "user", "weak", "key40", "endpoint"]
BASE = ("assign", "access", "hex")

# What a part is for.  Parts of BASE stand alone; the others are weak.
IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"
ROLE = {"assign": SECRET, "access": IDENTIFIER, "hex": SECRET, "user": IDENTIFIER, "weak": SECRET, "key40": SECRET, "endpoint": ENDPOINT}

NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""(?i)({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
WEAK = rf"""(?i)(?:{NAMES}|pwd|pass)["']?\x20*[:=]\x20*["']?[^\s"',;]{{4,}}+"""
USER = r"""(?i)(?<![A-Za-z])(?:user(?:_?name|_?id)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{2,}+"""
URL = r"""(?i)(?:https?|ftp|jdbc:[a-z]{2,12}|postgres|mysql|mongodb|redis|amqp)://[^\s"'<>]{4,}+|(?<![A-Za-z])(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:-]{4,}+"""
KEY40 = r"(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]{0,39}[a-z])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
SCOPE = 400

PART = "array<struct<start:long,order:int,end:long>>"


def parts_of(text: Column) -> Column:
    """All parts of a text, by start and kind."""
    assigned = text.rlike(rf"(?i)(?:{NAMES}|pwd|pass)[\"']?\x20*[:=]")
    named = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    spans = {
        "assign": F.filter(
            match_spans(text, ASSIGN, assigned), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 12
        ),
        "access": match_spans(text, "AKIA[A-Z0-9]{14,}+", F.contains(text, F.lit("AKIA"))),
        "hex": match_spans(text, "[0-9a-f]{16,}+", text.rlike("[0-9a-f]{16}")),
        "user": match_spans(text, USER, named & text.rlike(r"(?i)(?:user|login|account|client)[a-z_]{0,5}[\"']?\x20*[:=]")),
        "weak": match_spans(text, WEAK, assigned),
        "key40": match_spans(text, KEY40, text.rlike("[A-Za-z0-9+/]{40}")),
        "endpoint": match_spans(text, URL, named & (F.contains(text, F.lit("://")) | text.rlike(r"(?i)(?:host|endpoint|server)[\"']?\x20*[:=]"))),
    }

    def placed(found: Column, order: int) -> Column:
        return F.transform(
            found, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"))
        ).cast(PART)

    return F.concat(*[placed(found, KINDS.index(kind)) for kind, found in spans.items()])


def role_of(order: Column) -> Column:
    return F.get(F.array(*[F.lit(ROLE[k]) for k in KINDS]), order)


def linked_weak(parts: DataFrame, keys: list[str], scope: int) -> DataFrame:
    """Weak parts whose complements stand within `scope` code points.

    `parts` has one row per part: `keys`, start, order, end.  A secret needs an
    identifier or an endpoint, an identifier a secret, an endpoint a secret and an
    identifier.  A weak part over which a strong one lies, no further than `scope` from
    its start, is the same thing twice and goes.  Parts meet by stretches of `scope` code points, each also with its two
    neighbours, so that a text of any length falls into many small groups; semi joins
    keep a part once, however many complements it has.
    """
    placed = parts.withColumn("__role", role_of(F.col("order"))).withColumn("__cell", F.call_function("div", F.col("start"), F.lit(scope)))
    around = F.explode(F.array(F.col("__cell") - 1, F.col("__cell"), F.col("__cell") + 1))
    near = placed.filter(F.col("end").isNotNull()).select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        around.alias("__r_cell"),
        F.col("__role").alias("__r_role"),
        F.col("start").alias("__r_start"),
        F.col("end").alias("__r_end"),
        F.col("order").alias("__r_order"),
    )

    def meets(left: DataFrame, condition: Column, how: str) -> DataFrame:
        on = (left["__cell"] == F.col("__r_cell")) & condition
        for k in keys:
            on = on & left[k].eqNullSafe(F.col(f"__r_{k}"))
        return left.join(near, on, how)

    close = (F.col("__r_start") - F.col("start")).between(-scope, scope)
    other = {
        SECRET: F.col("__r_role").isin(IDENTIFIER, ENDPOINT),
        IDENTIFIER: F.col("__r_role") == SECRET,
        ENDPOINT: F.col("__r_role") == SECRET,
    }
    inside = (F.col("__r_order") < len(BASE)) & (F.col("__r_start") < F.col("end")) & (F.col("start") < F.col("__r_end"))
    weak = meets(placed.filter(F.col("order") >= len(BASE)), inside, "left_anti")
    complement = F.lit(False)
    for role, condition in other.items():
        complement = complement | ((F.col("__role") == role) & condition)
    linked = meets(weak, close & complement, "left_semi")
    both = (F.col("__role") != ENDPOINT) | (F.col("__r_role") == IDENTIFIER)
    return meets(linked, close & both, "left_semi").select(*keys, "start", "order", "end")


def find_credentials(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """Add `spans`, array<struct<start,order,end>> by start and kind, to the rows.

    Parts of BASE are always reported.  Weak candidates (user names, short passwords,
    keys of 40 characters, endpoints) are reported only with their complements
    (`linked_weak`).  The texts are read once: ids and parts are written to the shared
    folder, and only weak candidates of documents with parts of two roles move again.

    Places are code points of the whole text, end exclusive.  A NULL or empty text has
    no parts.  Rows of one id and different texts are apart, equal rows get equal spans.
    Returns the columns of `docs` without `text`, which nothing after needs.
    """
    kept = [c for c in docs.columns if c not in (text, "spans")]
    found = stored(
        docs.select(*kept, text_key(text).alias(TEXT_KEY), parts_of(whole_text(text)).alias("__parts")), "parts"
    )
    roles = F.array_distinct(F.transform("__parts", lambda p: role_of(p["order"])))
    open_ = found.filter(F.exists("__parts", lambda p: p["order"] >= len(BASE)) & (F.size(roles) > 1))
    keys = [doc_id, TEXT_KEY]
    parts = open_.select(*keys, F.explode("__parts").alias("p")).select(*keys, "p.start", "p.order", "p.end").distinct()
    weak = (
        linked_weak(parts, keys, scope)
        .groupBy(*keys)
        .agg(F.collect_set(F.struct("start", "order", "end")).alias("__weak"))
        .select(F.col(doc_id).alias("__id"), F.col(TEXT_KEY).alias("__of"), "__weak")
    )
    joined = found.join(weak, found[doc_id].eqNullSafe(weak["__id"]) & (found[TEXT_KEY] == weak["__of"]), "left")
    strong = F.filter("__parts", lambda p: p["order"] < len(BASE))
    return joined.select(
        *[found[c] for c in kept],
        F.array_sort(F.concat(strong, F.coalesce(F.col("__weak"), F.array().cast(PART)))).alias("spans"),
    )
