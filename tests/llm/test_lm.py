import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearfold.llm import lm
from nearfold.llm.common import id_crc
from nearfold.llm.lm import large_counts, pack_array, score_documents, small_counts, unpack_array
from tests.llm.helpers import AWKWARD, awkward, table


def words_of(text):
    return (text or "").encode().lower().split() + [None]


def is_training(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 != 0


def plain_model(rows, order, weights):
    """Counts in dictionaries and the recursion over histories, token by token."""
    counts = [collections.Counter() for _ in range(order)]
    for key, text in rows:
        if is_training(key):
            words = words_of(text)
            for n in range(order):
                counts[n].update(tuple(words[i : i + n + 1]) for i in range(len(words) - n))
    total, distinct = sum(counts[0].values()), len(counts[0])

    def chance(words, i, upto=order):
        p = (counts[0][(words[i],)] + 0.1) / (total + 0.1 * (distinct + 1))
        for n in range(2, min(upto, i + 1) + 1):
            history = counts[n - 2][tuple(words[i - n + 1 : i])]
            if history:
                failure = weights[n, min(math.frexp(history)[1], lm.CLASSES - 1)]
                p = (1 - failure) * counts[n - 1][tuple(words[i - n + 1 : i + 1])] / history + failure * p
        return p

    return counts, total, chance


@pytest.fixture
def weights(monkeypatch):
    kept, original = [], lm.failure_weights
    monkeypatch.setattr(lm, "failure_weights", lambda *a: kept.append(original(*a)) or kept[-1])
    return kept


@pytest.mark.parametrize(("order", "block_tokens"), [(1, 400), (2, 1_200_000), (2, 37), (3, 500)])
def test_scores_equal_brute_force(spark, sf_small, weights, order, block_tokens):
    docs = table(spark, sf_small, "documents").where("doc_id < 60")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = score_documents(docs, id_crc() % 10 != 0, order=order, block_tokens=block_tokens).collect()
    assert len(got) == len(rows)
    counts, total, chance = plain_model(rows, order, weights[0])
    texts = dict(rows)
    for row in got:
        words = words_of(texts[row.doc_id])
        assert row.train_tokens == total and row.n_tokens == len(words)
        assert row.n_known == sum((w,) in counts[0] for w in words)
        assert math.isclose(row.base_score, sum(math.log10(chance(words, i, 1)) for i in range(len(words))))
        assert math.isclose(row.score, sum(math.log10(chance(words, i)) for i in range(len(words))))


def test_probabilities_of_every_history_add_up_to_one(spark, weights):
    rows = [(i, f"a b {'c' if i % 3 else 'd'} a b e") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score_documents(docs, id_crc() % 10 != 0, order=3).count()
    counts, _, chance = plain_model(rows, 3, weights[0])
    known = [k[0] for k in counts[0]]
    for history in ([], [b"a"], [b"a", b"b"], [b"b", b"zzz"], [b"zzz", b"b"]):
        sums = sum(chance([*history, w], len(history)) for w in [*known, b"never seen"])
        assert math.isclose(sums, 1)


def test_held_out_texts_are_more_likely_than_by_words_alone(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = score_documents(docs, id_crc() % 10 != 0).withColumn("held", id_crc() % 10 == 0).toPandas()
    held = got[got.held]
    assert held.score.sum() > 0.95 * held.base_score.sum() and (held.score > held.base_score).mean() > 0.6


def test_packed_arrays():
    values = np.array([0, 1, 2**63, 2**64 - 1], np.uint64)
    assert np.array_equal(unpack_array(pack_array(values), np.uint64), values)
    assert len(unpack_array(pack_array(values[:0]), np.uint64)) == 0
    counts = np.array([0, 254, 255, 256, 10**12, 3])
    assert np.array_equal(large_counts(small_counts(counts), len(counts)), counts)


@pytest.mark.parametrize("block_tokens", [50, 1_200_000])
def test_awkward_rows(spark, block_tokens):
    docs = awkward(spark)
    got = score_documents(docs, id_crc() % 10 != 0, block_tokens=block_tokens).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got) == sorted(
        (d is None, d or 0, len(words_of(t))) for d, t, *_ in AWKWARD
    )
    assert all(math.isfinite(r.score) for r in got)
    assert score_documents(docs.limit(0), id_crc() % 10 != 0).count() == 0
    nothing = score_documents(docs, F.lit(False)).collect()
    assert {r.train_tokens for r in nothing} == {0} and {r.score for r in nothing} == {0.0}
