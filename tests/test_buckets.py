import sys

import numpy as np
import pytest

from nearfold.operators import shingle_sets
from nearfold.operators.compare import packed_set, similar_rows, unpacked_sets
from nearfold.params import Params
from nearfold.plans import NearDuplicates, clean
from tests import brute

PARAMS = Params(k=5, num_hashes=64, bands=16, rows=4)


@pytest.fixture(scope="module")
def raw():
    return dict(enumerate(brute.corpus(60, 5)))


@pytest.fixture(scope="module")
def docs(spark, raw):
    return spark.createDataFrame(list(raw.items()), "doc_id bigint, text string").cache()


@pytest.fixture(scope="module")
def true_sets(raw):
    return {i: brute.shingles(brute.normalize(t), 5) for i, t in raw.items()}


@pytest.mark.parametrize("tile_rows", [2, 2048])
def test_pairs_and_counts_without_a_list_of_candidates(docs, true_sets, monkeypatch, tile_rows):
    found = brute.candidates({i: brute.signature(s, 64) for i, s in true_sets.items()}, 16, 4)
    scored = {p: brute.jaccard(true_sets[p[0]], true_sets[p[1]]) for p in found}
    plan = sys.modules["nearfold.plans.near_duplicates"]
    monkeypatch.setattr(plan, "class_candidates", lambda *_: pytest.fail("candidates are listed"))
    monkeypatch.setattr(plan, "SET_TILE_ROWS", tile_rows)
    run = NearDuplicates(docs, PARAMS)
    got = {(r.doc_a, r.doc_b): r.jaccard for r in run.pairs.collect()}
    assert got == {p: j for p, j in scored.items() if j >= 0.5} and got
    assert run.num_candidates() == len(found)


def test_packed_sets_come_back(docs):
    rows = shingle_sets(clean(docs)).select("shingles", packed_set("shingles").alias("packed")).toArrow()
    values, lengths = unpacked_sets(rows["packed"])
    assert values.tolist() == [x for row in rows["shingles"].to_pylist() for x in row]
    assert lengths.tolist() == [len(row) for row in rows["shingles"].to_pylist()]


@pytest.mark.parametrize("columns", [64, 1 << 13])
def test_similar_rows_equal_plain_sets(monkeypatch, columns):
    monkeypatch.setattr("nearfold.operators.compare.BIT_COLUMNS", columns)
    draw = np.random.default_rng(3)
    sets = [np.sort(draw.choice(150, draw.integers(1, 140), replace=False)).astype(np.int32) for _ in range(60)]
    lengths = np.array([len(s) for s in sets])
    first, last = np.arange(60) + 1, np.full(60, 60)
    got = {}
    for i, j, score in similar_rows(np.concatenate(sets), lengths, first, last, 0.4):
        got |= dict(zip(zip(i.tolist(), j.tolist()), score.tolist()))
    want = {
        (i, j): brute.jaccard(set(sets[i].tolist()), set(sets[j].tolist()))
        for i in range(60) for j in range(i + 1, 60)
    }
    assert got == {p: x for p, x in want.items() if x >= 0.4}


@pytest.mark.parametrize("block_weight", [12_000, 1 << 22])
def test_exact_pairs_by_blocks_join_no_prefixes(docs, true_sets, monkeypatch, block_weight):
    """Every pair once, in a few blocks and in many."""
    from nearfold.operators import exact

    monkeypatch.setattr(exact, "prefix_candidates", lambda *_: pytest.fail("prefixes are joined"))
    blocks = exact.block_pairs
    monkeypatch.setattr(exact, "block_pairs", lambda *given: blocks(*given, block_weight))
    rows = exact.exact_pairs(shingle_sets(clean(docs)), 0.5).collect()
    assert {(r.doc_a, r.doc_b): r.jaccard for r in rows} == brute.exact(true_sets, 0.5)
    assert len(rows) == len(brute.exact(true_sets, 0.5))


@pytest.mark.parametrize("members_held", [1 << 26, 0])
def test_estimates_meet_in_the_bucket(docs, true_sets, monkeypatch, members_held):
    """Signatures are joined to no list of pairs; members are broadcast, or sorted and merged."""
    from nearfold.operators import classes, lsh, minhash_signatures

    monkeypatch.setattr(lsh, "pairs_within", lambda *_, **__: pytest.fail("candidates are joined"))
    monkeypatch.setattr(classes, "BROADCAST_BYTES", members_held)
    signed = {i: brute.signature(s, 64) for i, s in true_sets.items()}
    found = lsh.estimated_candidates(minhash_signatures(shingle_sets(clean(docs)), 64), 16, 4)
    want = {
        (a, b): sum(x == y for x, y in zip(signed[a], signed[b])) / 64
        for a, b in brute.candidates(signed, 16, 4)
    }
    rows = found.collect()
    assert {(r.doc_a, r.doc_b): r.estimate for r in rows} == want and len(rows) == len(want)


@pytest.mark.parametrize("hashes, configs", [(64, [(4, 16), (32, 2), (64, 1)]), (12, [(12, 1), (4, 3)])])
def test_sweep_counts_without_a_list_of_pairs(docs, true_sets, monkeypatch, hashes, configs):
    from nearfold.operators import buckets, exact_pairs, minhash_signatures, tiling
    from nearfold.plans import param_sweep

    sets = shingle_sets(clean(docs))
    truth = exact_pairs(sets, 0.5)
    monkeypatch.setattr(tiling, "_meet", lambda *_: pytest.fail("pairs are listed"))
    whole = buckets.sharing_sums
    monkeypatch.setattr("nearfold.plans.sweep.sharing_sums", lambda *given: whole(*given, 20))
    signed = {i: brute.signature(s, hashes) for i, s in true_sets.items()}
    rows = param_sweep(minhash_signatures(sets, hashes), truth, configs).collect()
    assert [r.num_candidates for r in rows] == [len(brute.candidates(signed, b, r)) for b, r in configs]


def test_verified_query_lists_no_candidates(spark, sf_small, monkeypatch):
    import __spark_entry__ as contract

    want = contract.q_near_duplicates(spark, sf_small).count()
    monkeypatch.setattr(contract, "lsh_candidates", lambda *_: pytest.fail("candidates are listed"))
    assert contract.q_verify_candidates(spark, sf_small).count() == want


@pytest.mark.parametrize("tile_rows", [2, 2048])
def test_every_candidate_is_scored_in_its_bucket(docs, true_sets, monkeypatch, tile_rows):
    """Candidates below the threshold too; none is listed and joined with its sets."""
    plan = sys.modules["nearfold.plans.near_duplicates"]
    monkeypatch.setattr(plan, "class_candidates", lambda *_: pytest.fail("candidates are listed"))
    monkeypatch.setattr(plan, "attach_jaccard", lambda *_: pytest.fail("sets are sent to pairs"))
    monkeypatch.setattr(plan, "SET_TILE_ROWS", tile_rows)
    found = brute.candidates({i: brute.signature(s, 64) for i, s in true_sets.items()}, 16, 4)
    want = {p: brute.jaccard(true_sets[p[0]], true_sets[p[1]]) for p in found}
    rows = NearDuplicates(docs, PARAMS).scored.collect()
    assert {(r.doc_a, r.doc_b): r.jaccard for r in rows} == want and len(rows) == len(want)
    assert min(want.values()) < 0.5


def test_scoring_query_joins_no_list(spark, sf_small, monkeypatch):
    import __spark_entry__ as contract

    want = contract.candidates(spark, sf_small).count()
    monkeypatch.setattr(contract, "lsh_candidates", lambda *_: pytest.fail("candidates are listed"))
    assert contract.q_true_jaccard(spark, sf_small).count() == want


@pytest.mark.parametrize("n", [3, 40, 10_000])
def test_best_pairs_without_a_list_of_candidates(docs, true_sets, monkeypatch, n):
    """Equal sets of different texts too; at every cut the first of all pairs."""
    from nearfold.operators import top_class_pairs

    plan = sys.modules["nearfold.plans.near_duplicates"]
    monkeypatch.setattr(plan, "class_candidates", lambda *_: pytest.fail("candidates are listed"))
    monkeypatch.setattr(plan, "FIRST_ROUND", 2)
    some = docs.where("doc_id < 40").union(
        docs.sparkSession.createDataFrame([(100, "a" * 30), (101, "a" * 31)], docs.schema)
    )
    run = NearDuplicates(some, PARAMS)
    want = sorted((-r.jaccard, r.doc_a, r.doc_b) for r in run.pairs.collect())
    assert (-1.0, 100, 101) in want
    found, _ = NearDuplicates(some, PARAMS).best(n)
    got = [(-r.jaccard, r.doc_a, r.doc_b) for r in top_class_pairs(found, run.members, n).collect()]
    assert sorted(got) == want[:n]
