"""The corpus pipeline: language, near-duplicates, benchmark passages, secrets, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``.
:func:`run` writes each stage's rows as Parquet and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablelab.llm import decontaminate, language, neardup, packing, secrets
from tablelab.llm.common import pick, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return pick(docs, **{c: c for c in COLUMNS})


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letters, or no language with half of the posterior."""
    found = language.identify_documents(_documents(docs))
    return found.where("lang_id IS NOT NULL").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of near-duplicates: five words, a similarity of 0.8 or more."""
    return neardup.drop_near_duplicates(_documents(docs), share=neardup.SHARE_80, agree=neardup.AGREE_80, levels=neardup.LEVELS_80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a test item."""
    return decontaminate.drop_contaminated(_documents(docs), table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the text; n_chars follows. No document goes."""
    return secrets.redact_secrets(_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(_documents(docs), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Shingle overlap and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
