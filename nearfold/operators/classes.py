"""Collapse of equal documents to one representative, and its reversal.

Documents with equal sets have equal signatures, share every band and are
equally similar to everything else, so pairs are sought among representatives
only. A third of the corpus may be copies of one text: it is then one row per
band. Pair tables in class form are ``(rep_a, rep_b, docs_a, docs_b, ...)``; a
row stands for all pairs between the two classes, and ``rep_a = rep_b`` for the
pairs inside one class. Counts and averages follow from that form directly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.operators.tiling import BROADCAST_BYTES, TILE_ROWS, pairs_of_sized, tile_count, tile_of
from nearfold.sources.scratch import stage

# Memory of one member in a broadcast table.
MEMBER_BYTES = 96


def digest128(value: Column | str) -> list[Column]:
    """Two 64-bit hashes of different seeding, as the columns ``h1`` and ``h2``."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("second"), value).alias("h2")]


def collapse(docs: DataFrame, key: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """One row per distinct ``key``: least id ``rep``, ``docs`` count and carried columns.

    The carried columns are determined by the key, so any row's value will do.
    """
    return docs.groupBy(*key).agg(
        F.min("doc_id").alias("rep"),
        F.count(F.lit(1)).alias("docs"),
        *[F.first(name).alias(name) for name in carry],
    )


def class_members(docs: DataFrame, classes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``(rep, docs, doc_id)`` for the classes of two or more documents, staged.

    Each document meets one row; AQE splits the partition of a large class.
    """
    several = classes.where("docs >= 2").select(*key, "rep", "docs")
    members = docs.select("doc_id", *key).join(several, list(key))
    return stage(members.select("rep", "docs", "doc_id"), "members")


def member_chunks(members: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Members with the chunk of their class they belong to."""
    return members.withColumn("chunk", tile_of("doc_id", tile_count(F.col("docs"), tile_rows)))


def every_chunk(docs: str, tile_rows: int = TILE_ROWS) -> Column:
    """Explodes a class of ``docs`` documents into its chunk numbers."""
    return F.explode(F.sequence(F.lit(0), tile_count(F.col(docs), tile_rows) - 1))


def inner_pairs(classes: DataFrame) -> DataFrame:
    """Class-form rows for the pairs inside each class."""
    several = classes.where("docs >= 2")
    return several.select(
        F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b"),
        F.col("docs").alias("docs_a"), F.col("docs").alias("docs_b"),
    )


def pair_weight() -> Column:
    """Number of document pairs behind a class-form row."""
    inside = F.expr("docs_a * (docs_a - 1) div 2")
    across = F.col("docs_a") * F.col("docs_b")
    return F.when(F.col("rep_a") == F.col("rep_b"), inside).otherwise(across)


def expand_pairs(
    class_pairs: DataFrame,
    members: DataFrame,
    carry: Sequence[str] = (),
    inside: Mapping[str, float] | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Document pairs ``(doc_a, doc_b, carry...)`` with ``doc_a < doc_b``.

    ``class_pairs`` are between different classes. If ``inside`` is given, the
    pairs inside each class follow, with these values as their carry columns.
    Members of a large class are dealt into chunks and each chunk is a join key
    of its own, so no task gets a class whole. Members are broadcast if their
    counted rows are few; beyond, pairs and members sort and merge.
    """
    chunked = member_chunks(members, tile_rows)
    few = members.count() * MEMBER_BYTES <= BROADCAST_BYTES
    pairs = class_pairs
    for side in ("a", "b"):
        rep, docs, doc = f"rep_{side}", f"docs_{side}", f"doc_{side}"
        listed = chunked.select(F.col("rep").alias(rep), "chunk", F.col("doc_id").alias(doc))
        listed = F.broadcast(listed) if few else listed
        pairs = (
            pairs.withColumn("chunk", every_chunk(docs, tile_rows))
            .join(listed, [rep, "chunk"], "left")
            .where((F.col(docs) == 1) | F.col(doc).isNotNull())
            .withColumn(doc, F.coalesce(doc, rep))
            .drop("chunk")
        )
    out = pairs.select(
        F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"), *carry
    )
    if inside is None:
        return out
    within = pairs_of_sized(members, ["rep"], "docs", tile_rows=tile_rows)
    fixed = [F.lit(inside[c]).alias(c) for c in carry]
    return out.unionByName(
        within.select(F.col("a.id").alias("doc_a"), F.col("b.id").alias("doc_b"), *fixed)
    )
