"""The corpus pipeline: documents in a language, one of each group of near-duplicates, free of benchmark passages and of
personal data, packed into sequences.

Null doc_ids take part in every stage, repeated rows as their stage says. A null or empty text ends at the first stage; a
table without rows gives one without rows. Stages pass texts to Python in small batches, a setting of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiforge.llm import decontam, langid, ngram_join, packing, pii
from kpiforge.llm.queries import tokenizer_path
from kpiforge.llm.store import modest, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and those without a letter. Repeated rows stay."""
    modest(spark)
    return langid.known_language(docs, langid.fit(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of near-duplicates; equal rows are one, and of null doc_ids alone one stays."""
    modest(spark)
    return ngram_join.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage, whatever their doc_id."""
    modest(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts its kind in place of every piece of personal data and every secret; all rows stay."""
    modest(spark)
    return pii.without_personal_data(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed: doc_id, piece, start, length, ids, sequence_id, offset."""
    modest(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language),
    ("ngram_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]

#: Trained classifiers and tokenizers are not SQL; a test holds the whole against brute force on a small fixture with near copies.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over the documents of sf_dir, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = table(docs, name)
    return docs
