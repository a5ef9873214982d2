"""Shingle sets of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.functions import char_shingles
from nearfold.functions.shingles import in_slices, list_array, shingle_batch_rows


def shingle_sets(docs: DataFrame, k: int = 5, text_col: str = "text") -> DataFrame:
    """Packed form ``(doc_id, shingles, n_shingles)``. Row-wise, no shuffle.

    The text is shingled as it is; normalise it first for word-like content.
    """
    packed = docs.select("doc_id", char_shingles(text_col, k).alias("shingles"))
    return packed.select("doc_id", "shingles", F.size("shingles").alias("n_shingles"))


def shingle_table(docs: DataFrame, k: int = 5, text_col: str = "text") -> DataFrame:
    """Long form ``(doc_id, shingle)``, distinct within a document by construction."""
    if k < 1:
        raise ValueError(f"shingle size must be at least 1, got {k}")
    texts = docs.select("doc_id", F.coalesce(text_col, F.lit("")).alias("text"))
    cut = in_slices(lambda part: list_array(*shingle_batch_rows(part, k)), "shingles")
    packed = texts.mapInArrow(cut, f"doc_id {dict(texts.dtypes)['doc_id']}, shingles array<int>")
    sets = packed.select("doc_id", F.explode("shingles").alias("shingle"))
    return sets.select("doc_id", F.col("shingle").cast("bigint").alias("shingle"))
