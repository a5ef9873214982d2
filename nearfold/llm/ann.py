"""Nearest neighbours by largest inner product from a permutation index.

A vector is represented by its nearest pivots in order (its permutation, cut to
``prefix`` places) and posted in the inverted file of each of them with its
place. Two permutations are compared by Spearman's footrule, with absent pivots
at place ``prefix``; that is ``prefix * (prefix + 1)`` less twice the sum, over
the pivots both have, of ``prefix`` minus the larger place, so it is added up from
the posting lists of the query's pivots alone. The best ``rerank`` share of each
block, and all that tie with the last of it, are compared with the query exactly.

Inner products are brought to angles first: vectors are scaled by the largest
norm and get one more component, so that all have norm one (Bachrach et al.,
2014); queries get a zero there. With vectors of norm one this changes nothing.

Rows are dealt by hash into blocks of about ``block_rows``, queries into chunks
of about ``query_rows``; a task builds the inverted files of one block and ranks
one chunk. So a task is bounded, one vector held by a third of all rows spreads
over all blocks, and the cost is rows * queries / block_rows rows shuffled. The
pivots are a bounded sample, chosen by the hash of the vector. Each block yields
the nearest ``k`` of each query; the nearest of those are the result.

Defined cases: rows with a null id and vectors that are null, empty, zero, of
another length than the pivots' or that hold null or non-finite components take
no part; equal scores are ordered by id; a row is no candidate for itself, but
another row with the same id is; with fewer than ``k`` candidates all found are
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfold.sources.scratch import stage

PIVOTS = 256
PREFIX = 64
#: Share of each block that is compared exactly, at every size.
RERANK = 0.25
BLOCK_ROWS = 16_384
QUERY_ROWS = 16_384
K = 20


def usable(vector: str) -> Column:
    """The vector has components, all finite numbers, and one that is not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the nearest pivots in order; equal distances by number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)


class InvertedFiles:
    """Posting lists (row, place) of the pivots over the permutations of one block."""

    def __init__(self, perms: np.ndarray, n_pivots: int):
        n, self.prefix = perms.shape
        self.rows = n
        pivot = perms.ravel()
        order = np.argsort(pivot, kind="stable")
        self.bounds = np.searchsorted(pivot[order], np.arange(n_pivots + 1))
        self.row = (order // self.prefix).astype(np.int32)
        # What a posting adds if the query has the pivot at an earlier place.
        self.worth = (self.prefix - order % self.prefix).astype(np.float32)

    def closeness(self, perm: np.ndarray) -> np.ndarray:
        """Footrule turned round: the sum of ``prefix - max(place, place)`` over shared pivots."""
        lists = [slice(self.bounds[p], self.bounds[p + 1]) for p in perm]
        rows = np.concatenate([self.row[s] for s in lists])
        worth = np.concatenate(
            [np.minimum(self.worth[s], self.prefix - place) for place, s in enumerate(lists)]
        )
        return np.bincount(rows, worth, self.rows)


def _matrix(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1)


def raised(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Vectors scaled by the largest norm, with the component that makes their norm one."""
    scaled = vectors / norm
    rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
    return np.column_stack([scaled, rest]).astype(np.float32)


def apart(sample: np.ndarray, count: int, most: float = 0.8) -> np.ndarray:
    """The first ``count`` vectors with inner products up to ``most`` to those chosen before.

    A crowd of nearly equal vectors would else hold many pivots, which all say the same.
    """
    chosen = sample[:1]
    for vector in sample[1:]:
        if len(chosen) == count:
            break
        if (chosen @ vector).max() <= most:
            chosen = np.vstack([chosen, vector])
    return chosen


def search(
    queries: tuple[np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray, np.ndarray],
    pivots: np.ndarray, norm: float, prefix: int, rerank: float, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its place, and the rows found with their exact scores, nearest first.

    ``queries``: row numbers and vectors; ``rows``: row numbers, ids and vectors.
    """
    numbers, asked = queries
    own, ids, vectors = rows
    files = InvertedFiles(permutations(raised(vectors, norm), pivots, prefix), len(pivots))
    plain = asked / np.sqrt((asked * asked).sum(axis=1, keepdims=True))
    perms = permutations(np.column_stack([plain, np.zeros(len(plain))]).astype(np.float32), pivots, prefix)
    wanted = min(len(vectors), max(k + 1, int(np.ceil(rerank * len(vectors)))))
    for i, perm in enumerate(perms):
        close = files.closeness(perm)
        last = np.partition(close, len(close) - wanted)[len(close) - wanted]
        chosen = np.flatnonzero((close >= last) & (own != numbers[i]))
        # Summed row by row, so that equal vectors get equal scores wherever they stand.
        scores = (vectors[chosen] * asked[i]).sum(axis=1)
        best = np.lexsort((ids[chosen], -scores))[:k]
        yield i, chosen[best], scores[best]


def nearest(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    n_pivots: int = PIVOTS,
    prefix: int = PREFIX,
    rerank: float = RERANK,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, id, score)`` of the ``k`` nearest found for each row where ``is_query``."""
    id_type = table.schema[id_col].dataType.simpleString()
    rows = table.where(F.col(id_col).isNotNull() & usable(vector_col)).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(rows, "ann-rows")
    norm2 = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias("q"),
        F.max(norm2).alias("m"),
    )
    common = lengths.orderBy(F.desc("n"), "d").limit(1).collect()
    columns = f"query_id {id_type}, rank int, {id_col} {id_type}, score double"
    if not common or not common[0]["q"]:
        return table.sparkSession.createDataFrame([], columns)
    dimension, n, n_queries, norm = common[0]["d"], common[0]["n"], common[0]["q"], float(np.sqrt(common[0]["m"]))
    rows = rows.where(F.size("vector") == dimension)

    # About eight times the pivots wanted, so that equal and very close ones can go.
    span = 1 << 30
    digest = F.xxhash64("vector")
    share = min(span, int(8 * n_pivots * span / n) + 1)
    drawn = (
        rows.where(F.pmod(digest, F.lit(span)) < share)
        .groupBy(digest.alias("h")).agg(F.first("vector").alias("vector"))
        .orderBy("h").limit(8 * n_pivots)
    ).collect()
    if not drawn:
        drawn = rows.orderBy(digest).limit(1).collect()
    pivots = apart(raised(np.array([r["vector"] for r in drawn], np.float64), norm), n_pivots)
    kept = min(prefix, len(pivots))
    blocks, chunks = -(-n // block_rows), -(-n_queries // query_rows)

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    deal = F.xxhash64("row")
    held = rows.select(
        F.pmod(deal, F.lit(blocks)).cast("int").alias("block"), every(chunks).alias("chunk"), "row", "id", "vector"
    )
    asked = rows.where("asks").select(
        every(blocks).alias("block"), F.pmod(deal, F.lit(chunks)).cast("int").alias("chunk"), "row", "id", "vector"
    )

    def rank(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = {"query": [], "query_id": [], "id": [], "score": []}
        if mine.num_rows and theirs.num_rows:
            ids = theirs.column("id").combine_chunks()
            order = np.argsort(np.array(ids.to_pylist(), object), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            queries = (mine.column("row").to_numpy(), _matrix(mine.column("vector"), np.float64))
            rows_ = (theirs.column("row").to_numpy(), place, _matrix(theirs.column("vector"), np.float64))
            for i, found, scores in search(queries, rows_, pivots, norm, kept, rerank, k):
                out["query"].append(np.full(len(found), queries[0][i]))
                out["query_id"].append(np.full(len(found), i))
                out["id"].append(found)
                out["score"].append(scores)
        joined = {name: np.concatenate(v) if v else np.empty(0, np.int64) for name, v in out.items()}
        return pa.table({
            "query": pa.array(joined["query"].astype(np.int64)),
            "query_id": mine.column("id").take(pa.array(joined["query_id"].astype(np.int64))),
            "id": theirs.column("id").take(pa.array(joined["id"].astype(np.int64))),
            "score": pa.array(joined["score"].astype(np.float64)),
        })

    found = (
        asked.groupBy("block", "chunk").cogroup(held.groupBy("block", "chunk"))
        .applyInArrow(rank, f"query long, query_id {id_type}, id {id_type}, score double")
    )
    nearest_first = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
