"""Pipeline from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps, with the columns
of `documents`; the last one gives the packed pieces.  `run` writes each stage's result
to the shared folder and reads it as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmark.llm.common import ship_package
from fieldmark.llm.decontaminate import contaminated
from fieldmark.llm.language import UNKNOWN, predict_language, train_language
from fieldmark.llm.lines import line_dedup
from fieldmark.llm.near_duplicates import near_duplicates
from fieldmark.llm.packing import pack_documents
from fieldmark.llm.tokenizing import default_path
from fieldmark.session import stored

# A text that no learned language codes in fewer bits a byte than a uniform code is not in one.
UNIFORM_BITS = 8.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; a missing `lang` is filled with the prediction.

    Texts that are NULL, without a letter, or no shorter in any language's code are rejected.
    """
    ship_package(spark)
    found = predict_language(docs, train_language(docs))
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") < UNIFORM_BITS))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand in a document of a smaller id."""
    kept = line_dedup(docs).withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of near-duplicates; rows without an id stay."""
    ship_package(spark)
    copies = near_duplicates(docs).filter("class_id < doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in its own words or asked with other values."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their place in sequences of 4096 tokens."""
    ship_package(spark)
    return pack_documents(docs, default_path("word_bpe_49k.json"), end_id=1, max_tokens=4096)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Trained code lengths and edit distances are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
