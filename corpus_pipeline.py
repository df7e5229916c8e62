"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read again before the next; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import jaccard_join, language_id, line_dedup, packing, quality_rules
from weftline.session import staged

# SQL knows neither the language model nor the tokenizer.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SURE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Predict each document's language, learned from the labelled ones.

    Documents without a letter, or whose language is less than half sure, go;
    ``lang`` becomes the prediction. If no document is labelled, nothing can be
    told and every document stays as it is.
    """
    fold = language_id.held_out(F.col("doc_id"))
    model = language_id.learn(docs.where(~fold))
    if not model.languages:
        return docs.select(*COLUMNS)
    found = language_id.identify(docs, COLUMNS, model)
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SURE)
    return found.where(sure).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted, without their host's common lines."""
    others = ["doc_id", "lang", "source"]
    judged = quality_rules.judge_documents(docs, others, cleaned=True).where("kept")
    text = F.col("cleaned")
    return judged.withColumns({"text": text, "n_chars": F.length(text).cast("bigint")}).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that another one keeps."""
    others = ("lang", "source")
    return line_dedup.dedup_lines(docs, keep=others).select(
        "doc_id", F.col("kept").alias("text"), *others, F.length("kept").cast("bigint").alias("n_chars")
    )


def keep_one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id.

    Rows without an id stay, and so do all rows that share a kept id.
    """
    grouped = jaccard_join.jaccard_components(docs)
    gone = grouped.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4,096 tokens with their places in sequences."""
    return packing.pack_documents(docs, "doc_id", public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_language),
    ("quality_rules", keep_good_documents),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_a_group),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
