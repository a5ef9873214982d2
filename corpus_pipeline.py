"""The training-data pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nearfold.llm.common import read_table
from nearfold.llm.decontam import drop_contaminated
from nearfold.llm.langid import drop_unidentified
from nearfold.llm.packing import pack_documents
from nearfold.llm.secrets import redact_secrets
from nearfold.llm.simhash import drop_near_copies
from nearfold.sources.scratch import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; learned from a sample of their own labels."""
    return drop_unidentified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies (fingerprints within four bits)."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live credentials replaced by a mark."""
    return redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence."""
    return pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", deduplicate),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", hide_secrets),
    ("best_fit_packing", pack),
]

#: Compression by dictionaries and XXH64 fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
