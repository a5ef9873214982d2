"""Exact similarity of given pairs."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from nearfold.functions import jaccard_of_counts
from nearfold.sources.scratch import stage, stage_observed

# Sets of up to this many bytes in memory may be broadcast.
BROADCAST_BYTES = 1 << 26
# Bytes of sets in a block, when they are too many to broadcast; a task holds two blocks.
BLOCK_BYTES = 1 << 24
# Memory of one id in a broadcast table of ids.
ID_BYTES = 32


def referenced(rows: DataFrame, pairs: DataFrame, a: str, b: str, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id occurs in ``pairs``; a semi-join ahead of shipping wide rows.

    The distinct ids are staged and counted while they are written. Up to
    ``BROADCAST_BYTES`` in memory they are broadcast and rows are dropped where
    they are scanned; beyond, both sides sort and merge, and Spark's own runtime
    filters, if the session has them on, drop rows ahead of the shuffle.
    """
    ids = pairs.select(F.explode(F.array(a, b)).alias(id_col)).distinct()
    ids, seen = stage_observed(ids, "wanted")
    small = seen["rows"] * ID_BYTES <= BROADCAST_BYTES
    return rows.join(F.broadcast(ids) if small else ids.hint("merge"), id_col, "left_semi")


def attach_jaccard(
    pairs: DataFrame,
    sets: DataFrame,
    a: str = "doc_a",
    b: str = "doc_b",
    size: tuple[int, int] | None = None,
) -> DataFrame:
    """Add the column ``jaccard``. A document without a set counts as empty.

    Sets are broadcast if ``size``, the counted total of their rows and elements,
    is at most ``BROADCAST_BYTES`` in memory; Spark's own size estimate knows
    nothing of array lengths and is not relied on. Beyond, pairs and sets meet
    in blocks (:func:`by_blocks`).

    Beside a broadcast, pairs are few bytes but much work each; they are dealt
    out by number first, lest AQE merges them into a handful of tasks.
    """
    if size is None:
        sets = stage(sets.select("doc_id", "shingles"), "compared-sets")
        size = count_elements(sets)
    if held_bytes(*size) > BROADCAST_BYTES:
        return by_blocks(pairs, sets, a, b, size)
    spark = pairs.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(shuffled, spark.sparkContext.defaultParallelism)
    both = pairs.repartition(tasks, F.xxhash64(a, b))
    empty = F.array().cast(sets.schema["shingles"].dataType)
    for end, held in ((a, "_set_a"), (b, "_set_b")):
        own = sets.select(F.col("doc_id").alias(end), F.col("shingles").alias(held))
        own = F.broadcast(own)
        both = both.join(own, end, "left").withColumn(held, F.coalesce(held, empty))
    # Generated, so that a filter on the result does not repeat the intersection.
    common = F.explode(F.array(F.size(F.array_intersect("_set_a", "_set_b"))))
    sized = both.select(
        *pairs.columns, F.size("_set_a").alias("_a"), F.size("_set_b").alias("_b"),
        common.alias("_common"),
    )
    score = jaccard_of_counts(F.col("_common"), F.col("_a"), F.col("_b"))
    return sized.select(*pairs.columns, score.alias("jaccard"))


def by_blocks(
    pairs: DataFrame, sets: DataFrame, a: str, b: str, size: tuple[int, int],
    block_bytes: int | None = None,
) -> DataFrame:
    """:func:`attach_jaccard` for any amount of sets.

    Documents are dealt by id hash into blocks of about ``BLOCK_BYTES`` of sets,
    and pairs are grouped by the blocks of their ends. A set goes once to each
    group that has a pair of it, not once with every pair: a thousand documents
    that are all alike send each set a few times, not a thousand.
    """
    blocks = max(1, math.ceil(held_bytes(*size) / (block_bytes or BLOCK_BYTES)))

    def block(end: str) -> Column:
        return F.pmod(F.xxhash64(end), F.lit(blocks))

    keyed = pairs.withColumns({"_block_a": block(a), "_block_b": block(b)})
    keys = ["_block_a", "_block_b"]
    at = [F.col(key).alias(key.replace("block", "at")) for key in keys]
    wanted = keyed.select(*at, F.explode(F.array(a, b)).alias("doc_id")).distinct()
    held = wanted.join(sets.select("doc_id", "shingles").hint("merge"), "doc_id")
    schema = StructType([*pairs.schema.fields, StructField("jaccard", DoubleType())])
    columns = pairs.columns

    def compare(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        ends = [mine[end].to_numpy() for end in (a, b)]
        scores = pair_scores(ends[0], ends[1], theirs["doc_id"].to_numpy(), theirs["shingles"])
        return mine.select(columns).append_column("jaccard", pa.array(scores))

    return keyed.groupBy(*keys).cogroup(held.groupBy("_at_a", "_at_b")).applyInArrow(compare, schema)


def pair_scores(left: np.ndarray, right: np.ndarray, ids: np.ndarray, sets: pa.ChunkedArray) -> np.ndarray:
    """Jaccard similarity of the sets of ``left`` and ``right``, looked up by id."""
    order = np.argsort(ids)
    listed = sets.combine_chunks()
    lengths = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
    flat = listed.flatten().to_numpy(zero_copy_only=False)
    distinct, codes = np.unique(flat, return_inverse=True)
    starts = np.cumsum(lengths) - lengths

    def places(wanted: np.ndarray) -> np.ndarray:
        """Row of each wanted id, or -1."""
        if not len(ids):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(ids, wanted, sorter=order), len(ids) - 1)
        return np.where(ids[order[at]] == wanted, order[at], -1)

    rows_a, rows_b = places(left), places(right)
    scores = np.zeros(len(left))
    marked = np.zeros(len(distinct), dtype=bool)
    by_left = np.argsort(rows_a, kind="stable")
    for group in np.split(by_left, np.flatnonzero(np.diff(rows_a[by_left])) + 1) if len(left) else ():
        own = rows_a[group[0]]
        if own < 0:
            continue
        mine = codes[starts[own] : starts[own] + lengths[own]]
        marked[mine] = True
        for pair in group.tolist():
            other = rows_b[pair]
            if other >= 0:
                common = np.count_nonzero(marked[codes[starts[other] : starts[other] + lengths[other]]])
                joined = lengths[own] + lengths[other] - common
                scores[pair] = common / joined if joined else 0.0
        marked[mine] = False
    return scores


def held_bytes(rows: int, elements: int) -> int:
    """Bound on the memory of broadcast sets: their elements, and some for each row."""
    return 4 * elements + 96 * rows


def count_elements(sets: DataFrame) -> tuple[int, int]:
    """Rows and total number of elements of stored sets."""
    counts = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("shingles")), F.lit(0)))
    return tuple(counts.first())


def verify_candidates(candidates: DataFrame, sets: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``(doc_a, doc_b, jaccard)`` of the candidates with similarity of at least ``threshold``."""
    candidates = candidates.select("doc_a", "doc_b")
    scored = attach_jaccard(candidates, referenced(sets, candidates, "doc_a", "doc_b"))
    return scored.select("doc_a", "doc_b", "jaccard").where(F.col("jaccard") >= threshold)
