"""Small tables with every awkward case, and fixtures of the driver's data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))

#: Nulls, empty and blank texts, a very long text, ties, repeated rows, repeated and null ids.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (2, None, "en", "a"), (3, "", None, None), (4, " \t\n ", "de", "b"),
    (5, LONG, "en", "b"), (6, "one", "en", None), (6, "one", "en", None),
    (7, "repeated row with some words", "en", "c"), (7, "repeated row with some words", "en", "c"),
    (7, "another text under the same id", "en", "c"), (None, "a text without an id", "en", "d"),
    (None, None, None, None), (8, "1234 5678 !!! ???", "fr", "d"), (9, "ÄÖÜ ñandú été 漢字 🙂", "de", "e"),
]
#: Columns with the names that operators use inside.
CLASHING = [
    "id", "row", "block", "g", "fp", "key", "start", "_row", "_live", "_doc", "_text", "_id", "_at", "_part",
    "piece", "bin", "h", "label", "seed", "found", "pii", "_replaced", "value", "chunk", "tokens", "shard",
]


def awkward(spark: SparkSession) -> DataFrame:
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string")
    docs = docs.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as bigint) n_chars")
    return docs.selectExpr("*", *[f"'clash' AS `{name}`" for name in CLASHING])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
