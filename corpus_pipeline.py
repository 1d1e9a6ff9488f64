"""From raw documents to training tokens: five stages over ``documents``.

Each stage takes the documents its predecessor kept, returns the columns of documents (the last one
tokens), and is written as Parquet before the next one reads it. Null and empty texts have no language
and leave at the first stage; an empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import bpe, language_id, mixing, secret_scan, simhash
from shelfmark.llm.common import fold, fresh, prepare
from shelfmark.session import new_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the labelled ones teach; those without letters, or with no n-gram of any language, go.

    The score falls with the length of a text, so no text is rejected for a low one: only for none at all.
    """
    prepare(spark)
    model = language_id.train(docs.where(fold("doc_id", 3) != 1))
    (found,) = fresh(docs, "_language")
    scored = docs.withColumn(found, language_id.identify(spark, "text", model))
    sure = (F.col(f"{found}.lang") != language_id.NO_LANGUAGE) & (F.col(f"{found}.score") > 0)
    return scored.where(sure).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the smallest id."""
    prepare(spark)
    return simhash.one_of_each_group(docs, simhash.simhash_groups(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; the documents stay."""
    prepare(spark)
    return secret_scan.without_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and in the order the target weights of their sources ask for."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, source, n_tokens, ids, round_trip)``: packed token ids, and whether they decode to the text.

    A null or empty text has no tokens and decodes to the empty text; every row comes back.
    """
    prepare(spark)
    vocabulary = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    both = docs.select("doc_id", "source", "text", bpe.round_trip("text", *vocabulary).alias("both"))
    return both.select(
        "doc_id", "source", (F.octet_length("both.ids") / 4).cast("long").alias("n_tokens"), F.col("both.ids").alias("ids"),
        (F.col("both.decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("tokens", tokens),
]

# SQL cannot express the classifier, XXH64 or the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
