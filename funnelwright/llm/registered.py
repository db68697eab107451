"""The subpackage's queries of (spark, folder), with SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import chat, language, leaks, nearest, negatives, packing, pieces, pii, ppm, secrets, simhash, warc, whitening

# The vocabulary files of the packing and of the encoding query, by name or by path.
TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
# The vocabulary whose words prime the secret scan.
CODE_VOCABULARY = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A vocabulary file by its path, or by its name among the installed public ones."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_report(_table(spark, folder, "documents"))


def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_report(_table(spark, folder, "documents"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.warc_report(_table(spark, folder, "pages"))


def op5_ppm(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.language_model_report(_table(spark, folder, "documents"))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_texts(_table(spark, folder, "conversations"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_report(_table(spark, folder, "documents"), tokenizer_path(CODE_VOCABULARY))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_report(_table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leak_report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), tokenizer_path())


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, label=negatives.moved_label())


def op13_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_report(_table(spark, folder, "documents"), tokenizer_path(PIECE_MODEL))


def queries() -> dict[str, Query]:
    found = [op1_simhash, op2_nearest, op3_language, op4_warc, op5_ppm, op6_chat, op7_secret_scan, op8_pii]
    found += [op9_decontamination, op10_packing, op11_whitening, op12_hard_negatives, op13_pieces]
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return {
        "op2_nearest": nearest.NEAREST_SQL,
        "op4_warc": warc.WARC_SQL,
        "op6_chat": chat.CHAT_SQL,
        "op9_decontamination": leaks.LEAK_SQL,
        "op12_hard_negatives": negatives.NEGATIVES_SQL,
    }
