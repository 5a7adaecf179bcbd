"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust a score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.common import let, match_spans, span_string, whole_text

KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "account"]
BASE = ("email", "ip", "card", "phone")

# Marks for single separators, put in place of them so that patterns stay plain runs of
# characters: nested repeats overflow the stack on long runs.  They replace one code
# point by one.  Should a text hold a mark itself, it is read as another private code point.
MARK, OTHER = "", ""

PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.6, "phone": 0.6, "iban": 0.5, "ssn": 0.35, "account": 0.3}
CHECKSUM_BONUS = 0.3
CONTEXT_BONUS = 0.3
CONTEXT_WORDS = {
    "email": "e-?mail|contact|write to|address",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|master|amex|credit|debit|pay|karte|carte|tarjeta",
    "phone": "phone|call|mobile|fax|tel|contact|telefon",
    "iban": "iban|bank|account|konto|compte|cuenta|transfer",
    "ssn": "ssn|social security|taxpayer|sozialversicherung|securite sociale|seguridad social",
    "account": "account|acct|konto|compte|cuenta|passport|licen[cs]e|member|customer|patient",
}
THRESHOLD = 0.5


def marked(text: Column, separators: str, around: str) -> Column:
    """`text` with each single separator between two characters of `around` put as MARK."""
    clean = F.translate(text, MARK, OTHER)
    return F.regexp_replace(clean, f"(?<=[{around}])[{separators}](?=[{around}])", MARK)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Checksum of card numbers: every second digit from the right counts twice."""

    def value(i: Column) -> Column:
        twice = F.substring(digits, -i, F.lit(1)).cast("int") * (F.when(i % 2 == 0, 2).otherwise(1))
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def mod97(compact: Column) -> Column:
    """Checksum of bank accounts: first four characters last, letters as 10 to 35, rest 1 modulo 97."""
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def small_parts(match: Column) -> Column:
    """No dotted part is above 255."""
    return F.forall(F.split(match, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))))


def proposals(text: Column) -> dict[str, tuple[Column, dict[str, Column | None]]]:
    """Per kind: spans, and how a span is confirmed (`must`) or strengthened (`check`)."""
    digit = text.rlike("[0-9]")
    at_sign = F.contains(text, F.lit("@"))
    email_text = marked(text, ".", "A-Za-z0-9-")
    local = f"[A-Za-z0-9._%+\\-{MARK}]"
    card_text = marked(text, r"\x20\-", "0-9")
    many = digit & text.rlike(r"(?:[0-9][\x20-]?){13}[0-9]")
    return {
        # The local part is a run up to "@": only its first place can start a match, or the end of the match before.
        "email": (
            match_spans(email_text, f"(?:\\G|(?<!{local})){local}++@[A-Za-z0-9-]++{MARK}[A-Za-z0-9\\-{MARK}]++", at_sign),
            {},
        ),
        "ip": (
            match_spans(text, r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)", digit & text.rlike(r"[0-9]\.[0-9]++\.[0-9]")),
            {"must": small_parts},
        ),
        "card": (
            match_spans(card_text, f"[0-9][0-9{MARK}]++", many),
            {"must": lambda m: let(digits_of(m), lambda d: F.length(d).between(14, 19) & luhn(d))},
        ),
        "phone": (
            match_spans(text, r"\+[0-9][\x20().0-9-]+[0-9]", F.contains(text, F.lit("+"))),
            {"must": lambda m: F.length(digits_of(m)).between(10, 15)},
        ),
        "iban": (
            match_spans(
                text,
                r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
                digit & text.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
            ),
            {"must": lambda m: let(F.regexp_replace(m, r"\x20", ""), mod97), "check": lambda m: F.lit(True)},
        ),
        "ssn": (
            match_spans(text, r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", digit & text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}")),
            {},
        ),
        "account": (
            match_spans(text, r"(?<![0-9A-Za-z+.-])[0-9]{8,12}(?![0-9A-Za-z-])", digit & text.rlike("[0-9]{8}")),
            {},
        ),
    }


def find_private(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add `spans`, array<struct<start,order,end,kind,score>> by start and kind, to the rows.

    Kinds of BASE are reported whenever their pattern and checksum hold.  The others need a
    score of `threshold`: a prior by kind, more for a checksum, more for a word of the kind
    in the 40 code points before, up to 1.  `order` is the place of the kind in KINDS.

    Places are code points of the whole text, end exclusive.  A NULL or empty text has no
    spans.  Rows are treated one by one; all columns stay.
    """
    body = whole_text(text)
    kind_type = "array<struct<start:long,order:int,end:long,kind:string,score:double>>"

    def scored(kind: str, spans: Column, rules: dict) -> Column:
        must, check = rules.get("must"), rules.get("check")
        if must:
            spans = F.filter(spans, lambda s: must(s["match"]))

        def one(s: Column) -> Column:
            near = F.lower(s["before"]).rlike(f"(?:^|[^a-z])(?:{CONTEXT_WORDS[kind]})")
            score = F.lit(PRIOR[kind]) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
            if kind == "card" or check:
                score = score + CHECKSUM_BONUS
            return F.struct(
                s["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("order"),
                s["end"].alias("end"),
                F.lit(kind).alias("kind"),
                F.least(F.round(score, 2), F.lit(1.0)).alias("score"),
            )

        found = F.transform(spans, one)
        if kind not in BASE:
            found = F.filter(found, lambda s: s["score"] >= threshold)
        return found.cast(kind_type)

    columns = {kind: scored(kind, spans, rules) for kind, (spans, rules) in proposals(body).items()}
    kept = docs.drop("spans") if "spans" in docs.columns else docs
    return kept.withColumn("spans", F.array_sort(F.concat(*columns.values())))


def base_spans(spans: Column, base: tuple[str, ...] | list[str]) -> Column:
    return F.filter(spans, lambda s: s["order"] < len(base))


def counted(spans: Column, order: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["order"] == order)).cast("long")


def span_digest(found: DataFrame, kinds: list[str], base: tuple[str, ...]) -> DataFrame:
    """doc_id, a count per base kind, base_sha256 and all spans as text."""
    return found.select(
        "doc_id",
        *[counted(F.col("spans"), i).alias(f"n_{k}") for i, k in enumerate(base)],
        F.sha2(span_string(base_spans(F.col("spans"), base), kinds), 256).alias("base_sha256"),
        span_string(F.col("spans"), kinds).alias("spans"),
    )
