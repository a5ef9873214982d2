"""Error of the signature estimate of Jaccard similarity."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from nearfold.functions import error_bound, hash_family, python_round
from nearfold.functions._batch import least_hashes
from nearfold.functions.shingles import list_array, shingle_batch_rows
from nearfold.operators.verify import pair_scores

# Bytes of texts in a block of documents; a task holds two blocks at most.
BLOCK_BYTES = 1 << 24
# Bytes of texts and places in a partition, and how many times a text's bytes travel
# if it is in four pairs.
PARTITION_BYTES = 1 << 26
TRAVELS = 8
# Texts signed and pairs compared at once.
ROWS_AT_ONCE = 1024

# The signature lengths of the study.
SIGNATURE_LENGTHS = (32, 64, 128, 256, 512)

SIGNATURE_LENGTH_SCHEMA = (
    "n int, mean_absolute_error double, std_error double, "
    "theoretical_bound_1_over_sqrt_n double, num_pairs bigint, runtime_seconds double"
)


def pair_estimates(
    docs: DataFrame,
    pairs: DataFrame,
    n_values: Sequence[int] = SIGNATURE_LENGTHS,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """``(draw, doc_a, doc_b, n, jaccard, estimate)`` for given pairs of documents.

    One signature at the largest length serves all lengths: hash families are
    drawn in sequence, so a shorter signature is a prefix of a longer one.

    Documents are dealt by id hash into blocks and pairs are grouped by the blocks
    of their ends. A text goes to each group that has a pair of it, as it is
    smaller than its set and its signature. Signatures are made once a document
    and travel as the places of the least shingles in the set: hashes are one to
    one, so entries agree where these shingles do.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = max(math.ceil(size / BLOCK_BYTES), math.ceil(math.sqrt(2 * tasks)))
    partitions = max(tasks, math.ceil(TRAVELS * size / PARTITION_BYTES))

    def block(end: str) -> Column:
        return F.pmod(F.xxhash64(end), F.lit(blocks)).cast("int")

    keys = ["_block_a", "_block_b"]
    keyed = pairs.withColumns({"_block_a": block("doc_a"), "_block_b": block("doc_b")})
    group = F.struct(*[F.col(key).alias(key.replace("block", "at")) for key in keys])
    wanted = keyed.select(F.explode(F.array("doc_a", "doc_b")).alias("doc_id"), group.alias("group"))
    wanted = wanted.groupBy("doc_id").agg(F.collect_set("group").alias("groups"))
    signed = docs.join(wanted.hint("merge"), "doc_id").select(
        "doc_id", "text", "groups", least_places("text", k, max(n_values), seed).alias("places")
    )
    held = signed.select("doc_id", "text", "places", F.inline("groups"))
    added = [StructField("jaccard", DoubleType()), StructField("estimates", ArrayType(DoubleType()))]
    columns = pairs.columns

    def compare(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        theirs = theirs.combine_chunks().sort_by("doc_id")
        ids = theirs["doc_id"].to_numpy()
        rows = [np.searchsorted(ids, mine[end].to_numpy()) for end in ("doc_a", "doc_b")]
        known = np.ones(mine.num_rows, dtype=bool)
        for end, at in zip(("doc_a", "doc_b"), rows):
            known &= np.append(ids, 0)[at] == mine[end].to_numpy()
            known &= at < len(ids)
        mine = mine.filter(pa.array(known)).select(columns)
        a, b = (at[known] for at in rows)
        lengths, values = shingle_batch_rows(theirs["text"].combine_chunks(), k)
        sets = pa.chunked_array([list_array(lengths, values)])
        scores = pair_scores(ids[a], ids[b], ids, sets)
        least = least_shingles(theirs["places"], values, lengths, max(n_values))
        estimates = np.zeros((len(a), len(n_values)))
        for at in range(0, len(a), ROWS_AT_ONCE):
            part = slice(at, at + ROWS_AT_ONCE)
            agrees = least[a[part]] == least[b[part]]
            for i, n in enumerate(n_values):
                estimates[part, i] = np.count_nonzero(agrees[:, :n], axis=1) / n
        listed = list_array(np.full(len(a), len(n_values)), estimates.ravel())
        return mine.append_column("jaccard", pa.array(scores)).append_column("estimates", listed)

    met = keyed.repartition(partitions, *keys).groupBy(*keys).cogroup(
        held.repartition(partitions, "_at_a", "_at_b").groupBy("_at_a", "_at_b")
    )
    scored = met.applyInArrow(compare, StructType([*pairs.schema.fields, *added]))
    estimates = F.array(
        *[
            F.struct(F.lit(n).alias("n"), F.get("estimates", F.lit(i)).alias("estimate"))
            for i, n in enumerate(n_values)
        ]
    )
    return scored.select(*columns, "jaccard", F.inline(estimates))


def least_places(text: str, k: int, num_hashes: int, seed: int) -> Column:
    """``binary`` of the places in a text's sorted set that have the least i-th hash.

    Byte plane by byte plane: two planes, or four for a set of more than 2**16.
    """
    family = hash_family(num_hashes, seed)

    @F.arrow_udf("binary")
    def places_batch(texts: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(texts), ROWS_AT_ONCE):
            lengths, values = shingle_batch_rows(texts.slice(at, ROWS_AT_ONCE), k)
            places = least_hashes(values, lengths, family)[1].astype("<i4")
            for row, length in zip(places, lengths):
                planes = row.view(np.uint8).reshape(-1, 4)[:, : 2 if length <= 1 << 16 else 4]
                out.append(planes.T.tobytes())
        return pa.array(out, pa.binary())

    return places_batch(text)


def least_shingles(packed: pa.ChunkedArray, values: np.ndarray, lengths: np.ndarray, num_hashes: int) -> np.ndarray:
    """Matrix of the shingles at the places of :func:`least_places`."""
    out = np.empty((len(lengths), num_hashes), dtype=values.dtype)
    begin = np.cumsum(lengths) - lengths
    for row, planes in enumerate(packed.to_pylist()):
        planes = np.frombuffer(planes, np.uint8).reshape(-1, num_hashes)
        places = np.zeros((num_hashes, 4), dtype=np.uint8)
        places[:, : len(planes)] = planes.T
        out[row] = values[begin[row] + places.view("<i4").ravel()]
    return out


def estimator_error(
    docs: DataFrame,
    pairs: DataFrame,
    n_values: Sequence[int] = SIGNATURE_LENGTHS,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Mean and population deviation of the absolute error per signature length."""
    error = F.abs(F.col("estimate") - F.col("jaccard"))
    rows = pair_estimates(docs, pairs, n_values, k, seed).select("n", error.alias("error"))
    stats = rows.groupBy("n").agg(
        F.avg("error").alias("mean"),
        F.stddev_pop("error").alias("deviation"),
        F.count(F.lit(1)).alias("num_pairs"),
    )
    return stats.select(
        "n",
        python_round("mean", 6).alias("mean_absolute_error"),
        python_round("deviation", 6).alias("std_error"),
        python_round(error_bound(F.col("n")), 6).alias("theoretical_bound_1_over_sqrt_n"),
        "num_pairs",
    )


def timed_estimator_error(
    docs: DataFrame,
    pairs: DataFrame,
    n_values: Sequence[int] = SIGNATURE_LENGTHS,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """The same table with the seconds each length took on its own."""
    out = []
    for n in n_values:
        begun = time.perf_counter()
        row = estimator_error(docs, pairs, [n], k, seed).first()
        out.append((*row, round(time.perf_counter() - begun, 2)))
    return docs.sparkSession.createDataFrame(out, SIGNATURE_LENGTH_SCHEMA)
