"""Queries and SQL of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmark.llm.common import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, python: bool = False):
    """Register a query; one with Python functions gives its workers this package."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            if python:
                ship_package(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
repeated AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, pos, line, coalesce(doc_id > first, false) AS gone FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op1_line_dedup", LINE_SQL)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.lines import line_dedup

    kept = line_dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_best_fit_packing", python=True)
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.packing import pack_documents
    from fieldmark.llm.tokenizing import default_path

    packed = pack_documents(table(spark, folder, "documents"), default_path("word_bpe_49k.json"), end_id=1, max_tokens=4096)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op6_token_files", python=True)
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.token_files import read_tokens, token_digest, write_tokens
    from fieldmark.llm.tokenizing import default_path
    from fieldmark.session import work_folder

    path = work_folder(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), path, default_path("byte_bpe_50k.json"), end_id=2)
    return token_digest(read_tokens(spark, path))


@query("op5_language_id", python=True)
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.language import held_out, predict_language, train_language

    docs = table(spark, folder, "documents")
    model = train_language(docs)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict_language(rows, model).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


@query("op7_toxicity", python=True)
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.language import held_out
    from fieldmark.llm.toxicity import score_toxicity, train_toxicity

    docs = table(spark, folder, "documents")
    machine = train_toxicity(docs, table(spark, folder, "labels"))
    scored = score_toxicity(docs.select("doc_id", held_out().alias("held_out"), "text"), machine)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.private import BASE, KINDS, find_private, span_digest

    found = find_private(table(spark, folder, "documents").select("doc_id", "text"))
    return span_digest(found, KINDS, BASE)


@query("op10_credentials")
def op10_credentials(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.credentials import BASE, KINDS, find_credentials
    from fieldmark.llm.private import span_digest

    found = find_credentials(table(spark, folder, "documents").select("doc_id", "text"))
    return span_digest(found, KINDS, BASE)


@query("op8_near_duplicates", python=True)
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.decontaminate import contaminated

    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.fingerprints import fingerprints

    return fingerprints(table(spark, folder, "documents"))


RULE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
grams AS (
  SELECT doc_id, i, (words[i], words[i + 1], words[i + 2]) AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(3)) AS k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words) AS n_words, CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS n_digits,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipses
  FROM w LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > n_words OR 100 * n_upper > 30 * coalesce(word_chars, 0)
           OR (n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines)
           OR coalesce(word_chars, 0) < 3 * n_words OR coalesce(word_chars, 0) > 12 * n_words
           OR 100 * n_digits > 20 * coalesce(word_chars, 0) OR 100 * n_ellipses > 30 * n_lines AS rejected,
         CAST(50 * n_symbols > n_words AS INT) + CAST(100 * n_repeat_words > 30 * n_words AS INT)
           + CAST(n_dup_lines > 2 AND 100 * n_dup_lines > 15 * n_lines AS INT) > 1 AS doubtful
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR rejected OR doubtful) AS kept
FROM f
"""


@query("op11_rule_ledger", RULE_SQL, python=True)
def op11_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.rules import BASE, PROSE, quality_ledger, with_verdicts

    judged = with_verdicts(quality_ledger(table(spark, folder, "documents").select("doc_id", "text")), [BASE, PROSE])
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *measures, (~F.col(BASE.label)).alias("base_failed"), F.col(PROSE.label).alias("kept"))


INTERACTION_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
b AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
         CAST(len(w) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INT)
         + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS INT)
         + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
         + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS bits
  FROM d LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, bits, good, bad, count(*) AS n, bit_count(bits) AS k FROM b GROUP BY ALL),
f(l, m) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.m, b.m, c.m, d.m, e.m] AS ms
  FROM f a, f b, f c, f d, f e WHERE a.m + b.m + c.m + d.m + e.m = 31 AND a.m | b.m | c.m | d.m | e.m = 31),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, ms[step] AS own, coalesce(CAST(list_sum(ms[:step - 1]) AS INT), 0) AS before
  FROM (SELECT filter_order, ms, unnest(range(1, 6)) AS step FROM o)),
x AS (SELECT *, bits & own <> 0 AS fails, bits & before <> 0 AS earlier FROM cells, s)
SELECT part, filter_order, step,
       CAST(sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN fails AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN bits = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN fails AND NOT earlier AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN fails AND NOT earlier AND bad THEN n ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN fails THEN n * (120 // k) ELSE 0 END) AS BIGINT) AS shapley
FROM x GROUP BY part, filter_order, step
"""


@query("op12_filter_interactions", INTERACTION_SQL)
def op12_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.interactions import filter_interactions

    return filter_interactions(table(spark, folder, "documents"), table(spark, folder, "labels"))


def vector_sql(rounds: int = 2) -> str:
    """The codes by comparing every part with every entry, a step per round."""
    steps = """
a{r} AS (
  SELECT vec_id, j, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (
    SELECT p.vec_id, p.j, c.e, (p.v[1] - c.v[1]) ** 2 + (p.v[2] - c.v[2]) ** 2
           + (p.v[3] - c.v[3]) ** 2 + (p.v[4] - c.v[4]) ** 2 AS d FROM p JOIN c{r} c USING (j)) GROUP BY vec_id, j),"""
    means = """
m{r} AS (
  SELECT j, e, i, sum(p.v[i]) AS s, count(*) AS n FROM a{r} JOIN p USING (vec_id, j), (SELECT unnest(range(1, 5)) AS i)
  GROUP BY j, e, i),
c{n} AS (
  SELECT c.j, c.e, list(coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), c.v[g.i]) ORDER BY g.i) AS v
  FROM c{r} c CROSS JOIN (SELECT unnest(range(1, 5)) AS i) g LEFT JOIN m{r} m ON m.j = c.j AND m.e = c.e AND m.i = g.i
  GROUP BY c.j, c.e),"""
    body = "".join(steps.format(r=r) + means.format(r=r, n=r + 1) for r in range(rounds)) + steps.format(r=rounds)
    return f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT vec_id, j, x[4 * j + 1:4 * j + 4] AS v FROM (SELECT vec_id, x, unnest(range(16)) AS j FROM k)),
c0 AS (
  SELECT j, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS e, v FROM p
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)),{body}
t AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY j) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT t.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY j, e)) FROM c{rounds}) AS codebooks_sha256
FROM t JOIN k USING (vec_id)
"""


@query("op13_vector_codes", vector_sql(), python=True)
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    from fieldmark.llm.vector_codes import digest, vector_codes

    codes, codebooks = vector_codes(table(spark, folder, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
