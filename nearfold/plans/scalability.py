"""Work and results at growing prefixes of a corpus."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.operators.buckets import bucket_rows, candidate_sums
from nearfold.operators.exact import exact_pairs
from nearfold.operators.shingling import shingle_sets
from nearfold.params import Params
from nearfold.plans.near_duplicates import NearDuplicates, clean
from nearfold.sources.corpus import prefix_cutoff, prefix_size
from nearfold.sources.scratch import stage

# Fixed values of the study: corpus shares.
FRACTIONS = (0.10, 0.25, 0.50, 1.00)

COUNTS_SCHEMA = "num_docs bigint, fraction double, method string, num_pairs_found bigint"
SCALABILITY_SCHEMA = (
    "num_docs bigint, fraction double, method string, runtime_seconds double, "
    "num_pairs_found bigint"
)


def prefixes(
    docs: DataFrame, fractions: Sequence[float]
) -> list[tuple[float, int, int | None]]:
    """``(fraction, number of documents, last id)`` per prefix."""
    total = docs.count()
    sizes = [(fraction, prefix_size(total, fraction)) for fraction in fractions]
    return [(fraction, n, prefix_cutoff(docs, n)) for fraction, n in sizes]


def count_candidates(sketches: DataFrame, lasts: Sequence[int]) -> DataFrame:
    """One row ``counts array<bigint>``: candidate pairs in each prefix that ends at one of ``lasts``.

    Whether two texts share a band does not depend on the prefix, so the texts
    of the whole corpus meet once, in their buckets. A class carries the number of its
    documents in every prefix, and a pair of classes stands for the product of
    the two numbers.
    """
    held = [F.count_if(F.col("doc_id") <= last).alias(f"held{i}") for i, last in enumerate(lasts)]
    classes = sketches.groupBy("text_key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("docs"),
        F.first("band_keys").alias("band_keys"), *held,
    )
    classes = stage(classes, "prefix-classes")
    names = [f"held{i}" for i in range(len(lasts))]
    sums = candidate_sums(bucket_rows(classes, names), names)
    within = [F.expr(f"{name} * ({name} - 1) div 2").alias(f"w{i}") for i, name in enumerate(names)]
    sums = sums.unionByName(classes.where("docs > 1").select(*within))
    totals = [F.coalesce(F.sum(f"w{i}"), F.lit(0)) for i in range(len(lasts))]
    return sums.agg(F.array(*totals).alias("counts"))


def scalability_counts(
    docs: DataFrame,
    fractions: Sequence[float] = FRACTIONS,
    params: Params | None = None,
) -> DataFrame:
    """``(num_docs, fraction, method, num_pairs_found)`` without timings.

    All prefixes share one pass over the texts and one join of each method. Method ``lsh`` counts
    candidates, ``brute_force`` true pairs.
    """
    params = params or Params()
    cuts = [cut for cut in prefixes(docs, fractions) if cut[2] is not None]
    if not cuts:
        return docs.sparkSession.createDataFrame([], COUNTS_SCHEMA)
    lasts = [last for _, _, last in cuts]

    def labelled(i: int, method: str, found: Column) -> Column:
        fraction, n, _ = cuts[i]
        return F.struct(
            F.lit(n).cast("bigint").alias("num_docs"), F.lit(fraction).alias("fraction"),
            F.lit(method).alias("method"), found.alias("num_pairs_found"),
        )

    within = docs.where(F.col("doc_id") <= max(lasts))
    banded = count_candidates(NearDuplicates(within, params).sketches, lasts)
    truth = exact_pairs(shingle_sets(clean(within), params.k), params.threshold)
    # A pair lies in a prefix if its larger id does: one pass counts them all.
    exact = truth.agg(F.array(*[F.count_if(F.col("doc_b") <= last) for last in lasts]).alias("counts"))
    rows = [
        counts.select(F.inline(F.array(*[labelled(i, method, F.get("counts", F.lit(i))) for i in range(len(cuts))])))
        for counts, method in ((banded, "lsh"), (exact, "brute_force"))
    ]
    return rows[0].unionByName(rows[1])


def timed_scalability(
    docs: DataFrame,
    fractions: Sequence[float] = FRACTIONS,
    params: Params | None = None,
) -> DataFrame:
    """The same table with ``runtime_seconds``: every prefix starts again from its texts."""
    params = params or Params()
    out = []
    for fraction, n, last in prefixes(docs, fractions):
        prefix = docs.where(F.col("doc_id") <= last)
        methods = {
            "lsh": lambda: count_candidates(NearDuplicates(prefix, params).sketches, [last]).first()[0][0],
            "brute_force": lambda: exact_pairs(
                shingle_sets(clean(prefix), params.k), params.threshold
            ).count(),
        }
        for method, work in methods.items():
            begun = time.perf_counter()
            found = work()
            out.append((n, fraction, method, round(time.perf_counter() - begun, 2), found))
    return docs.sparkSession.createDataFrame(out, SCALABILITY_SCHEMA)
