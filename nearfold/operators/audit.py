"""Duplication statistics of a corpus.

Every function takes document pairs ``(doc_a, doc_b, jaccard)`` or class-form
pairs ``(rep_a, rep_b, docs_a, docs_b, jaccard)``; the latter need no expansion,
so copies cost nothing however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.functions import python_round
from nearfold.operators.classes import every_chunk, member_chunks, pair_weight

# Histogram bins and labels. The last label says 1.0, yet the bin
# takes 1.0 in.
HISTOGRAM_BINS = (
    ("[0.5, 0.6)", 0.5, 0.6),
    ("[0.6, 0.7)", 0.6, 0.7),
    ("[0.7, 0.8)", 0.7, 0.8),
    ("[0.8, 0.9)", 0.8, 0.9),
    ("[0.9, 1.0)", 0.9, 1.01),
)


def class_form(pairs: DataFrame) -> DataFrame:
    """Document pairs as classes of one document each; class form passes through."""
    if "rep_a" in pairs.columns:
        return pairs
    renamed = pairs.withColumnsRenamed({"doc_a": "rep_a", "doc_b": "rep_b"})
    one = F.lit(1).cast("bigint")
    return renamed.withColumns({"docs_a": one, "docs_b": one})


def class_degrees(pairs: DataFrame) -> DataFrame:
    """``(rep, docs, pairs)``: pairs each document of a class takes part in."""
    a, b = F.col("rep_a"), F.col("rep_b")

    def end(own: str, other: str) -> Column:
        return F.struct(
            F.col(f"rep_{own}").alias("rep"), F.col(f"docs_{own}").alias("docs"),
            F.col(f"docs_{other}").alias("pairs"),
        )

    inside = F.struct(a.alias("rep"), F.col("docs_a").alias("docs"),
                      (F.col("docs_a") - 1).alias("pairs"))
    ends = F.when(a == b, F.array(inside)).otherwise(F.array(end("a", "b"), end("b", "a")))
    rows = class_form(pairs).select(F.inline(ends))
    return rows.groupBy("rep").agg(F.max("docs").alias("docs"), F.sum("pairs").alias("pairs"))


def doc_degrees(pairs: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """``(doc_id, pairs)`` for every document in at least one pair.

    For class-form pairs ``members`` lists the documents of the larger classes.
    """
    degrees = class_degrees(pairs)
    if members is None:
        return degrees.select(F.col("rep").alias("doc_id"), "pairs")
    single = degrees.where("docs = 1").select(F.col("rep").alias("doc_id"), "pairs")
    several = degrees.where("docs > 1").select("rep", "pairs", every_chunk("docs").alias("chunk"))
    listed = member_chunks(members).select("rep", "chunk", "doc_id")
    return single.unionByName(several.join(listed, ["rep", "chunk"]).select("doc_id", "pairs"))


def dedup_audit(pairs: DataFrame, total_docs: int) -> DataFrame:
    """One row with pair count, documents having a duplicate, their share, mean similarity."""
    pairs = class_form(pairs)
    weight = pair_weight()
    totals = pairs.agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("total_confirmed_pairs"),
        (F.sum(F.col("jaccard") * weight) / F.sum(weight)).alias("mean"),
    )
    having = class_degrees(pairs).agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("having"))
    share = F.col("having") * 100.0 / total_docs if total_docs > 0 else F.lit(0.0)
    # Both sides are single rows.
    return totals.join(having, F.lit(True)).select(
        F.lit(total_docs).cast("bigint").alias("total_docs"),
        "total_confirmed_pairs",
        F.col("having").alias("docs_with_at_least_one_duplicate"),
        python_round(share, 2).alias("pct_docs_with_duplicate"),
        python_round(F.coalesce("mean", F.lit(0.0)), 4).alias("mean_jaccard_among_pairs"),
    )


def jaccard_histogram(pairs: DataFrame) -> DataFrame:
    """``(bin, lo, hi, pairs, pct)``: pairs per similarity bin, empty bins included.

    ``pct`` is of all pairs, also of those below the first bin.
    """
    weight = pair_weight()
    score = F.col("jaccard")
    held = [F.when((score >= lo) & (score < hi), weight) for _, lo, hi in HISTOGRAM_BINS]
    counts = class_form(pairs).agg(
        F.sum(weight).alias("total"),
        F.array(*[F.coalesce(F.sum(part), F.lit(0)) for part in held]).alias("held"),
    )
    bins = F.array(
        *[
            F.struct(
                F.lit(label).alias("bin"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"),
                F.get("held", F.lit(i)).alias("pairs"),
            )
            for i, (label, lo, hi) in enumerate(HISTOGRAM_BINS)
        ]
    )
    pct = F.when(F.col("total") > 0, F.col("pairs") * 100.0 / F.col("total")).otherwise(0.0)
    return counts.select("total", F.inline(bins)).select("bin", "lo", "hi", "pairs", pct.alias("pct"))
