import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearfold.llm.ann import InvertedFiles, apart, nearest, permutations, raised
from tests.llm.helpers import CLASHING, table


def exact(ids, vectors, query, k):
    scores = (vectors * vectors[query]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if i != query]
    return [(int(ids[i]), float(scores[i])) for i in order[:k]]


def test_closeness_is_footrule():
    rng = np.random.default_rng(0)
    perms = np.array([rng.permutation(20)[:6] for _ in range(50)], np.int32)
    files = InvertedFiles(perms, 20)

    def places(p):
        out = np.full(20, 6)
        out[p] = np.arange(6)
        return out

    for perm in perms[:10]:
        footrule = np.array([np.abs(places(perm) - places(p)).sum() for p in perms])
        assert np.array_equal(footrule, 6 * 7 - 2 * files.closeness(perm))


@pytest.mark.parametrize("norms", [False, True])
def test_recall(spark, norms):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(6000, 24))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if norms:
        vectors *= rng.uniform(0.5, 2, size=(6000, 1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = nearest(frame, F.col("vec_id") % 50 == 0, block_rows=3000).toPandas()
    hits = 0
    for query, rows in found.groupby("query_id"):
        rows = rows.sort_values("rank")
        assert list(rows["rank"]) == list(range(1, 21)) and (np.diff(rows.score) <= 0).all()
        best = exact(np.arange(6000), vectors, query, 20)
        hits += len({b for b, _ in best} & set(rows.vec_id))
        assert all(math.isclose(s, float(vectors[query] @ vectors[i])) for i, s in zip(rows.vec_id, rows.score, strict=True))
    assert hits / (120 * 20) > 0.9


def test_whole_table(spark):
    frame = table(spark, "/root/testdata/sf0.01", "embeddings")
    found = nearest(frame, F.col("vec_id") % 20 == 0).toPandas()
    rows = frame.collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    hits = total = 0
    for query, got in found.groupby("query_id"):
        best = exact(ids, vectors, int(np.flatnonzero(ids == query)[0]), 20)
        hits += len({b for b, _ in best} & set(got.vec_id))
        total += 20
    assert total == 20 * (ids % 20 == 0).sum() and hits / total >= 0.9


def test_many_equal_vectors(spark):
    """A third of all rows holds one vector: ties go to the smaller ids, none is lost (whole blocks compared)."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(900, 8))
    vectors[::3] = vectors[0]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = nearest(frame, F.col("vec_id") % 90 == 0, k=5, rerank=1.0, block_rows=100, query_rows=4).toPandas()
    for query, rows in found.groupby("query_id"):
        assert list(zip(rows.sort_values("rank").vec_id, rows.sort_values("rank").score, strict=True)) == exact(
            np.arange(900), vectors, query, 5
        )


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]),
        (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [-1.0, 0.5]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", *[f"'clash' AS `{c}`" for c in (*CLASHING, "vector", "asks", "query")]
    )
    found = nearest(frame, F.col("vec_id") % 20 == 0)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    one = [(0, 1, 0, 1.0), (0, 2, 1, 0.9), (0, 3, 20, -1.0)]
    assert got == sorted([*one, *one, (20, 1, 1, -0.9 + 0.05), (20, 2, 0, -1.0), (20, 3, 0, -1.0)])
    assert nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(frame, F.lit(False)).count() == 0


def test_pivots_keep_apart():
    sample = np.eye(4)[[0, 0, 1, 1, 2, 3]]
    assert np.array_equal(apart(sample, 3), np.eye(4)[:3])
    assert permutations(np.eye(4), np.eye(4), 2)[:, 0].tolist() == [0, 1, 2, 3]
    assert np.allclose((raised(np.array([[3.0, 0], [0, 1]]), 3.0) ** 2).sum(axis=1), 1)
