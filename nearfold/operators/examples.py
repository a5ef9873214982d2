"""The most similar pairs with excerpts of their texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearfold.functions import excerpt, python_fixed
from nearfold.sources.scratch import stage

# Fixed value: stands in for the text of an id the corpus lacks.
TEXT_MISSING = "[text not found]"


def top_class_pairs(pairs: DataFrame, members: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` document pairs ``(doc_a, doc_b, jaccard)`` of class-form ``pairs``.

    Class rows are ranked by the least document pair each stands for, and only
    the first ``n`` of them can hold one of the first ``n`` pairs; of their
    documents only the ``n + 1`` least can. So copies cost nothing here, however
    many there are. ``members`` lists the documents of the larger classes.
    """
    second = members.where("doc_id <> rep").groupBy("rep").agg(F.min("doc_id").alias("second"))
    inside = pairs.where("rep_a = rep_b").join(
        second.withColumnRenamed("rep", "rep_a").hint("merge"), "rep_a"
    )
    columns = ["rep_a", "rep_b", "docs_a", "docs_b", "jaccard"]
    ranked = pairs.where("rep_a <> rep_b").select(*columns, F.col("rep_b").alias("second"))
    ranked = ranked.unionByName(inside.select(*columns, "second"))
    kept = ranked.orderBy(F.desc("jaccard"), "rep_a", "second").limit(n)
    kept = stage(kept, "top-classes")
    reps = kept.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).distinct()
    # At most 2n classes; the limit for each is taken before their rows are shuffled.
    least = Window.partitionBy("rep").orderBy("doc_id")
    own = members.select("rep", "doc_id").join(F.broadcast(reps), "rep")
    own = own.withColumn("place", F.row_number().over(least)).where(F.col("place") <= n + 1)
    listed = own.groupBy("rep").agg(F.collect_list("doc_id").alias("ids"))
    for side in ("a", "b"):
        ids = listed.withColumnsRenamed({"rep": f"rep_{side}", "ids": f"ids_{side}"})
        kept = kept.join(F.broadcast(ids), f"rep_{side}", "left").withColumn(
            f"ids_{side}", F.coalesce(f"ids_{side}", F.array(f"rep_{side}"))
        )
    each = kept.select("rep_a", "rep_b", "jaccard", F.explode("ids_a").alias("x"), "ids_b")
    each = each.select("rep_a", "rep_b", "jaccard", "x", F.explode("ids_b").alias("y"))
    each = each.where((F.col("rep_a") != F.col("rep_b")) | (F.col("x") < F.col("y")))
    found = each.select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b"), "jaccard")
    return found.orderBy(F.desc("jaccard"), "doc_a", "doc_b").limit(n)


def top_pairs(pairs: DataFrame, docs: DataFrame, n: int = 20, chars: int = 300) -> DataFrame:
    """``(rank, doc_a, doc_b, jaccard, excerpt_a, excerpt_b)``, most similar first.

    Equal similarities rank by ids. Only the n pairs kept by the top-n step meet
    the window and the join with the corpus.
    """
    order = [F.desc("jaccard"), F.asc("doc_a"), F.asc("doc_b")]
    top = pairs.orderBy(*order).limit(n)
    # Stored, as two joins read it and the pairs behind it may be much work.
    top = stage(top.withColumn("rank", F.row_number().over(Window.orderBy(*order))), "top")
    ends = top.select("rank", F.explode(F.array("doc_a", "doc_b")).alias("doc_id")).distinct()
    # At most 2n rows.
    texts = docs.select("doc_id", "text").join(F.broadcast(ends), "doc_id")
    shown = texts.select("rank", "doc_id", excerpt("text", chars).alias("shown"))
    for side in ("a", "b"):
        end = shown.withColumnsRenamed({"doc_id": f"doc_{side}", "shown": f"excerpt_{side}"})
        top = top.join(end, ["rank", f"doc_{side}"], "left")
    return top.select(
        "rank", "doc_a", "doc_b",
        python_fixed("jaccard", 4).alias("jaccard"),
        F.coalesce("excerpt_a", F.lit(TEXT_MISSING)).alias("excerpt_a"),
        F.coalesce("excerpt_b", F.lit(TEXT_MISSING)).alias("excerpt_b"),
    )
