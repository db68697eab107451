"""From raw documents to packed training sequences, as stages that each take and return a DataFrame.

Every stage reads what its predecessor kept. All but the last return the columns of ``documents``;
the last returns one row per packed piece of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from funnelwright.llm import language, leaks, packing, secrets, simhash
from funnelwright.llm.registered import CODE_VOCABULARY, tokenizer_path
from funnelwright.session import prepare, staged


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is accepted as a language learnt from the labelled ones; the others go."""
    prepare(spark)
    return language.keep_known(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group of near-duplicates."""
    prepare(spark)
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return leaks.decontaminate(docs, benchmark)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in them masked and n_chars kept true."""
    prepare(spark)
    return secrets.redact_secrets(docs, vocabulary=tokenizer_path(CODE_VOCABULARY))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 token ids."""
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language identification", known_languages),
    ("SimHash near-duplicates", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("packing", packed),
]

# Spans found by compression, fingerprints and token ids are beyond SQL: the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
