"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders, so that a question asked anew with
other values keeps its template.  Windows of template words are matched by hash, and the
values behind the placeholders must be exchanged consistently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.llm.common import TEXT_KEY, let, text_key, whole_text
from fieldmark.session import measured, stored

WINDOW = 5
COVERED = 0.5
# The benchmark's window hashes go to where documents are read if they, 16 bytes each, are no more than this.
SENT_BYTES = 64 << 20
HASH_BYTES = 16

# Units that stand after a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t oz lb ml cl l s sec min h hr day days week weeks month months year years "
    "hour hours minute minutes second seconds meter meters metre metres mile miles foot feet inch inches gram grams "
    "liter liters litre litres kilometer kilometers kilometre kilometres dollar dollars euro euros cent cents pound pounds "
    "percent degrees mph kmh usd eur gbp"
).split()
NUMBER, NAME, UNIT, START = "<n>", "<p>", "<u>", "<s>"


def template_words(text: Column) -> Column:
    """Words of a text, placeholders glued to what they stand for: `<n>12`, `<u>km`, `<p>ada`.

    A capitalised word after a lower-case word is a name.  Elsewhere, as at the start of a
    sentence, it may be one: it is marked `<s>`, and `in_form` takes it for a word or for a
    name.  Case is folded and signs part words.
    """
    signs = F.contains(text, F.lit("<")) | F.contains(text, F.lit(">"))
    plain = F.when(signs, F.translate(text, "<>", "  ")).otherwise(text)
    capitals = F.regexp_replace(plain, r"(\p{Lu}(?<![\p{L}0-9]\p{Lu})\p{Ll}++)(?!\p{L})", f" {START}$1")
    names = F.regexp_replace(capitals, rf"\x20{START}(?<=\p{{Ll}},?\x20\x20{START})", f" {NAME}")
    units = rf"(?<=[0-9])\x20?({'|'.join(sorted(UNITS, key=len, reverse=True))}|[%$€£])(?![\p{{L}}0-9])"
    with_units = F.regexp_replace(names, units, f" {UNIT}$1")
    numbers = F.regexp_replace(with_units, r"(?<![\p{L}0-9])([0-9]++(?:[.,][0-9]++)*+)(?![\p{L}0-9])", f"{NUMBER}$1")
    # Points and commas stay within numbers.
    apart = F.when(
        names.rlike("[0-9]"), F.regexp_replace(numbers, r"[^\p{L}\p{N}<>.,]+|[.,]+(?![0-9.,])|(?<![0-9])[.,]+", " ")
    ).otherwise(F.regexp_replace(names, r"[^\p{L}\p{N}<>]+", " "))
    return F.array_remove(F.split(F.lower(apart), " "), "")


def is_start(word: Column) -> Column:
    return F.startswith(word, F.lit(START))


def in_form(words: Column, starts: Column) -> Column:
    """The words where marked ones are names (`starts`) or words."""
    return F.transform(words, lambda w: F.when(is_start(w), F.when(starts, F.concat(F.lit(NAME), F.substr(w, F.lit(4)))).otherwise(F.substr(w, F.lit(4)))).otherwise(w))


def is_slot(word: Column) -> Column:
    return F.startswith(word, F.lit("<"))


def bare(word: Column) -> Column:
    """A template word: a placeholder without its value."""
    return F.when(is_slot(word), F.substring(word, 1, 3)).otherwise(word)


def template(part: Column, window: int) -> Column:
    """Template words of a window; where half or more are placeholders these keep their values,
    and so do all of a window shorter than `window`, which is an item as a whole."""
    open_slots = (F.size(F.filter(part, is_slot)) * 2 < F.size(part)) & (F.size(part) >= window)
    return F.when(open_slots, F.transform(part, bare)).otherwise(part)


def word_hashes(words: Column) -> Column:
    """array<struct<free,held,slot,start>>: hashes without and with the value of a placeholder.

    Each word is hashed once; windows are made of the numbers.  A word that may be a name
    counts as a word in `free` and `held`, see `named_hashes`.
    """
    name = F.xxhash64(F.lit(NAME))

    def parts(free: Column, held: Column, slot: bool, start: Column, as_name: Column) -> Column:
        return F.struct(free.alias("free"), held.alias("held"), F.lit(slot).alias("slot"), start.alias("start"), as_name.alias("as_name"))

    def one(w: Column) -> Column:
        word = F.xxhash64(F.substr(w, F.lit(4)))
        return (
            F.when(~is_slot(w), parts(F.xxhash64(w), F.xxhash64(w), False, F.lit(False), F.lit(0).cast("long")))
            .when(is_start(w), parts(word, word, False, F.lit(True), F.xxhash64(F.concat(F.lit(NAME), F.substr(w, F.lit(4))))))
            .otherwise(parts(F.xxhash64(F.substring(w, 1, 3)), F.xxhash64(w), True, F.lit(False), name))
        )

    return F.transform(words, one)


def window_places(words: Column, size: int, window: int) -> Column:
    """array<struct<place,size,starts,hash>> of all windows of `size` words, in both forms.

    A window has a second form only where a word in it may be a name.
    """
    kind = "array<struct<place:int,size:int,starts:boolean,hash:bigint>>"
    name = F.xxhash64(F.lit(NAME))

    def at(h: Column, i: Column) -> list[Column]:
        return [F.get(h, i + k) for k in range(size)]

    def total(flags: list[Column]) -> Column:
        out = F.lit(0)
        for f in flags:
            out = out + F.when(f, 1).otherwise(0)
        return out

    def as_words(h: Column, i: Column) -> Column:
        x = at(h, i)
        held = F.xxhash64(*[e["held"] for e in x])
        if size < window:
            return held
        return F.when(total([e["slot"] for e in x]) * 2 < size, F.xxhash64(*[e["free"] for e in x])).otherwise(held)

    def as_names(h: Column, i: Column) -> Column:
        x = at(h, i)
        held = F.xxhash64(*[F.when(e["start"], e["as_name"]).otherwise(e["held"]) for e in x])
        if size < window:
            return held
        free = F.xxhash64(*[F.when(e["start"], name).otherwise(e["free"]) for e in x])
        return F.when(total([e["slot"] | e["start"] for e in x]) * 2 < size, free).otherwise(held)

    def plain(h: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(h, i + k) for k in range(size)])

    def found(i: Column, starts: bool, value: Column) -> Column:
        return F.struct(i.cast("int").alias("place"), F.lit(size).alias("size"), F.lit(starts).alias("starts"), value.alias("hash"))

    def marked(places: Column) -> Column:
        def with_start(h: Column, i: Column) -> Column:
            out = F.get(h, i)["start"]
            for k in range(1, size):
                out = out | F.get(h, i + k)["start"]
            return out

        return let(
            word_hashes(words),
            lambda h: F.concat(
                F.transform(places, lambda i: found(i, False, as_words(h, i))),
                F.transform(F.filter(places, lambda i: with_start(h, i)), lambda i: found(i, True, as_names(h, i))),
            ),
        )

    def only_starts(places: Column) -> Column:
        """No placeholder but words that may be names: those are few, and all else is a word."""
        start = F.transform(words, is_start)
        word = F.transform(words, lambda w: F.when(is_start(w), F.xxhash64(F.substr(w, F.lit(4)))).otherwise(F.xxhash64(w)))
        as_name = F.transform(words, lambda w: F.when(is_start(w), F.xxhash64(F.concat(F.lit(NAME), F.substr(w, F.lit(4))))))

        def any_start(x: Column, i: Column) -> Column:
            out = F.get(x["s"], i)
            for k in range(1, size):
                out = out | F.get(x["s"], i + k)
            return out

        def named(x: Column, i: Column) -> Column:
            flags = [F.get(x["s"], i + k) for k in range(size)]
            held = F.xxhash64(*[F.when(f, F.get(x["n"], i + k)).otherwise(F.get(x["h"], i + k)) for k, f in enumerate(flags)])
            if size < window:
                return held
            free = F.xxhash64(*[F.when(f, name).otherwise(F.get(x["h"], i + k)) for k, f in enumerate(flags)])
            return F.when(total(flags) * 2 < size, free).otherwise(held)

        return let(
            F.struct(start.alias("s"), word.alias("h"), as_name.alias("n")),
            lambda x: F.concat(
                F.transform(places, lambda i: found(i, False, plain(x["h"], i))),
                F.transform(F.filter(places, lambda i: any_start(x, i)), lambda i: found(i, True, named(x, i))),
            ),
        )

    unmarked = lambda places: let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(places, lambda i: found(i, False, plain(h, i))))
    all_places = F.sequence(F.lit(0), F.size(words) - size)
    return (
        F.when(F.size(words) < size, F.array().cast(kind))
        .when(F.exists(words, lambda w: is_slot(w) & ~is_start(w)), let(all_places, marked).cast(kind))
        .when(F.exists(words, is_start), let(all_places, only_starts).cast(kind))
        .otherwise(let(all_places, unmarked).cast(kind))
    )


def window_at(words: Column, place: Column, size: Column, window: int) -> tuple[Column, Column]:
    """Template and slot values of one window of words in one form."""
    part = F.slice(words, place + 1, size)
    return let(part, lambda w: F.array_join(template(w, window), " ")), F.filter(part, is_slot)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    covered: float = COVERED,
) -> DataFrame:
    """(doc_id, item_id, n_windows, share, exact) for each document and benchmark item in it.

    `share` is the part of the item's words that lie in template windows found in the
    document, `covered` or more, so that a changed word costs few others.  `exact` tells whether all values there are the item's own.
    Otherwise the item was asked with other values: in one alignment each value must
    have been replaced by one value wherever it stands, and different values by
    different ones; an alignment that fails is chance and does not count.

    First only the places of windows whose hash is one of the benchmark's are noted.  The
    hashes, numbers of a known size, are sent to where the documents are read up to SENT_BYTES;
    more of them are joined by shuffle.  Then the documents with such places are read again
    and the templates themselves are compared.

    Windows of which half or more are placeholders say too little and count only with the
    same values.  Items shorter than a window, of one word or more, are found as wholes, with
    their own values.  NULL and empty texts and items and rows without an id match nothing.
    Rows of one id are one document, found if one of its texts is.
    """
    # An item also stands for its form in lower case, in which no word passes for a name.
    forms = F.explode(F.array(whole_text(item_text), F.lower(whole_text(item_text)))).alias("__it")
    items = benchmark.filter(F.col(item_id).isNotNull()).select(F.col(item_id).alias("__item"), forms)
    # Items and documents have a second form, in which words that may be names are names.
    items = items.select("__item", template_words(F.col("__it")).alias("__m")).select("__item", "__m", F.explode(F.array(F.lit(False), F.lit(True))).alias("__starts"))
    items = items.select("__item", in_form(F.col("__m"), F.col("__starts")).alias("__iw"))
    items = items.filter(F.size("__iw") > 0).distinct().withColumn("__size", F.least(F.size("__iw"), F.lit(window)))
    words, values = window_at(F.col("__iw"), F.col("__at"), F.col("__size"), window)
    cut = (
        items.withColumn("__form", F.xxhash64("__iw"))
        .select("*", F.explode(F.sequence(F.lit(0), F.size("__iw") - F.col("__size"))).alias("__at"))
        .select("__item", "__form", "__size", F.size("__iw").alias("__all"), "__at", words.alias("__template"), values.alias("__values"))
    )
    cut = stored(cut, "windows")
    sizes = sorted(r[0] for r in cut.select("__size").distinct().collect())  # 1 to `window`: a few numbers
    hash_of = F.lit(None).cast("long")
    for n in sizes:
        parts = F.split("__template", " ")
        hash_of = F.when(F.col("__size") == n, F.xxhash64(*[F.xxhash64(F.get(parts, F.lit(k))) for k in range(n)])).otherwise(hash_of)
    keys = measured(cut.select(hash_of.alias("__h"), F.col("__size").alias("__s")).distinct())
    if keys.count() * HASH_BYTES <= SENT_BYTES:
        keys = F.broadcast(keys)
    base = docs.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("__id"), text_key(text).alias(TEXT_KEY), template_words(F.col(text)).alias("__dw")
    )
    # One explode for all window lengths that items have.
    hashed = F.concat(F.array().cast("array<struct<place:int,size:int,starts:boolean,hash:bigint>>"), *[window_places(F.col("__dw"), n, window) for n in sizes])
    seen = (
        base.select("__id", TEXT_KEY, F.explode(hashed).alias("w"))
        .select("__id", TEXT_KEY, F.col("w.starts").alias("__starts"), F.col("w.place").alias("__place"), F.col("w.size").alias("__s"), F.col("w.hash").alias("__h"))
        .join(keys, ["__h", "__s"], "left_semi")
        .groupBy("__id", TEXT_KEY)
        .agg(F.collect_set(F.struct("__place", "__s", "__starts")).alias("__places"))
    )
    seen = stored(seen, "places")
    # By shuffle at any size, and as texts, which are smaller than their words.
    texts = docs.select(F.col(doc_id).alias("__id"), text_key(text).alias(TEXT_KEY), F.col(text).alias("__text"))
    again = texts.join(seen.hint("merge"), ["__id", TEXT_KEY]).dropDuplicates(["__id", TEXT_KEY])
    again = again.select("__id", TEXT_KEY, "__places", template_words(F.col("__text")).alias("__m"))
    again = again.select("__id", TEXT_KEY, "__places", "__m", F.explode(F.array_distinct(F.transform("__places", lambda p: p["__starts"]))).alias("__starts"))
    again = again.withColumn("__dw", in_form(F.col("__m"), F.col("__starts")))
    # A window without a word that may be a name is noted once and belongs to both forms.
    unmarked = lambda p: ~F.exists(F.slice("__m", p["__place"] + 1, p["__s"]), is_start)
    there = F.filter("__places", lambda p: (p["__starts"] == F.col("__starts")) | (F.col("__starts") & unmarked(p)))
    again = again.select("__id", TEXT_KEY, "__starts", F.explode(F.transform(there, lambda p: windowed(F.col("__dw"), p, window))).alias("w"))
    hits = again.select("__id", TEXT_KEY, "__starts", F.col("w.place").alias("__place"), F.col("w.template").alias("__template"), F.col("w.values").alias("__found")).join(cut, "__template")
    where = ["__id", TEXT_KEY, "__starts", "__item", "__form"]
    exchanged = F.array_distinct(
        F.flatten(F.collect_list(F.zip_with("__values", "__found", lambda a, b: F.struct(a.alias("item"), b.alias("doc")))))
    )
    aligned = hits.groupBy(*where, (F.col("__place") - F.col("__at")).alias("__shift")).agg(
        F.collect_set("__at").alias("__ats"), F.min("__size").alias("__size"), F.min("__all").alias("__all"), exchanged.alias("__pairs")
    )
    exact = F.forall("__pairs", lambda p: p["item"] == p["doc"])
    one_to_one = (F.size(F.array_distinct(F.transform("__pairs", lambda p: p["item"]))) == F.size("__pairs")) & (
        F.size(F.array_distinct(F.transform("__pairs", lambda p: p["doc"]))) == F.size("__pairs")
    )
    # All windows of an item have one size.
    places = F.flatten(F.transform("__ats", lambda at: F.sequence(at, at + F.col("__size") - 1)))
    found = (
        aligned.filter(exact | one_to_one)
        .withColumn("__exact", exact)
        .groupBy(*where)
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("__ats")))).alias("__n"),
            F.size(F.array_distinct(F.flatten(F.collect_list(places)))).alias("__words"),
            F.min("__all").alias("__all"),
            F.max("__exact").alias("__exact"),
        )
        .withColumn("__share", F.col("__words") / F.col("__all"))
        .filter(F.col("__share") >= covered)
    )
    return found.groupBy(F.col("__id").alias(doc_id), F.col("__item").alias(item_id)).agg(
        F.max("__n").cast("long").alias("n_windows"), F.max("__share").alias("share"), F.max("__exact").alias("exact")
    )


def windowed(words: Column, p: Column, window: int) -> Column:
    found, values = window_at(words, p["__place"], p["__s"], window)
    return F.struct(p["__place"].alias("place"), found.alias("template"), values.alias("values"))
