"""What is sent and staged for each shingle, and that codes change no result."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearfold.operators import compare, shingle_sets
from nearfold.operators.compare import Coder, unpacked_sets
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


@pytest.mark.parametrize("size", [0, 1, 300, 1 << 16])
def test_coded_sets_are_one_to_one(size):
    """Codes for shingles of the codebook, values behind them for others; gaps of a byte and longer ones."""
    draw = np.random.default_rng(size)
    book = draw.choice(1 << 17, size, replace=False).astype(np.int32)
    sets = [draw.choice(1 << 17, draw.integers(0, 900), replace=False) for _ in range(60)]
    sets += [np.zeros(0, np.int64), np.array([2**31 - 1, 0])]
    lengths = np.array([len(s) for s in sets])
    packed = Coder(book).pack(np.concatenate(sets).astype(np.int32), lengths)
    values, found = unpacked_sets(pa.chunked_array([pa.array(packed, pa.binary())]))
    place = {int(value): code for code, value in enumerate(book)}
    rows = np.split(values, np.cumsum(found)[:-1])
    assert found.tolist() == lengths.tolist()
    assert [r.tolist() for r in rows] == [sorted(place.get(int(x), size + int(x)) for x in s) for s in sets]


def test_sets_are_sent_in_two_bytes_a_shingle_at_most(docs):
    run = NearDuplicates(docs, PARAMS)
    rows, _ = run._with_sets(run.compared)
    sent, shingles = rows.agg(F.sum(F.length("packed")), F.sum("n_shingles")).first()
    assert shingles and sent < 2 * shingles


@pytest.mark.parametrize("codes, sets", [(40, 1 << 12), (1 << 16, 5)])
def test_a_poor_codebook_gives_the_same_pairs(docs, true_sets, monkeypatch, codes, sets):
    monkeypatch.setattr(compare, "BOOK_CODES", codes)
    monkeypatch.setattr(compare, "BOOK_SETS", sets)
    found = brute.candidates({i: brute.signature(s, 64) for i, s in true_sets.items()}, 16, 4)
    want = {p: brute.jaccard(true_sets[p[0]], true_sets[p[1]]) for p in found}
    run = NearDuplicates(docs, PARAMS)
    assert 0 < len(run.codebook.value) <= codes
    assert {(r.doc_a, r.doc_b): r.jaccard for r in run.scored.collect()} == want
    assert {(r.doc_a, r.doc_b): r.jaccard for r in run.pairs.collect()} == {p: j for p, j in want.items() if j >= 0.5}


@pytest.mark.parametrize("weight", [2_000, 12_000, 1 << 25])
def test_exact_pairs_stage_and_send_codes_only(docs, true_sets, monkeypatch, weight):
    """No table of plain sets is staged; every pair comes once, whatever the blocks."""
    from nearfold.operators import exact

    staged, whole, blocks = {}, exact.stage, exact.block_pairs

    def watched(df, name):
        staged[name] = whole(df, name)
        return staged[name]

    monkeypatch.setattr(exact, "stage", watched)
    monkeypatch.setattr(exact, "LEAST_WEIGHT", 1)
    monkeypatch.setattr(exact, "block_pairs", lambda *given: blocks(*given, weight))
    rows = exact.exact_pairs(shingle_sets(clean(docs)), 0.5).collect()
    want = brute.exact(true_sets, 0.5)
    assert {(r.doc_a, r.doc_b): r.jaccard for r in rows} == want and len(rows) == len(want)
    assert not [kind for table in staged.values() for _, kind in table.dtypes if kind.startswith("array")]
    held, shingles = staged["sets"].agg(F.sum(F.length("packed")), F.sum("n_shingles")).first()
    assert held < 2 * shingles


def test_sweep_joins_no_signatures_to_pairs(spark, docs, true_sets, monkeypatch):
    """True pairs are kept as ids; one of a document without a signature is no hit, one of equal signatures is."""
    from nearfold.operators import minhash_signatures
    from nearfold.plans import sweep

    staged, whole = {}, sweep.stage

    def watched(df, name):
        staged[name] = whole(df, name)
        return staged[name]

    monkeypatch.setattr(sweep, "stage", watched)
    want = brute.exact(true_sets, 0.5)
    truth = spark.createDataFrame([*want, (3, 1_000_000)], "doc_a bigint, doc_b bigint")
    signed = {i: brute.signature(s, 64) for i, s in true_sets.items()}
    configs = [(4, 16), (32, 2)]
    rows = sweep.param_sweep(minhash_signatures(shingle_sets(clean(docs)), 64), truth, configs).collect()
    for row, (b, r) in zip(rows, configs):
        found = brute.candidates(signed, b, r)
        assert row.num_candidates == len(found) and row.num_ground_truth == len(want) + 1
        assert row.recall == round(len(set(want) & set(found)) / (len(want) + 1), 4)
    assert not [kind for _, kind in staged["truth"].dtypes if kind.startswith("array")]


def test_prefixes_are_counted_in_buckets(docs, true_sets, monkeypatch):
    from nearfold.operators import lsh
    from nearfold.plans import scalability_counts

    monkeypatch.setattr(lsh, "pairs_within", lambda *_, **__: pytest.fail("candidates are joined"))
    found = brute.candidates({i: brute.signature(s, 64) for i, s in true_sets.items()}, 16, 4)
    rows = scalability_counts(docs, (0.5, 1.0), PARAMS).where("method = 'lsh'").collect()
    ids = sorted(true_sets)
    assert {r.num_docs: r.num_pairs_found for r in rows} == {
        n: sum(b <= ids[n - 1] for _, b in found) for n in (len(ids) // 2, len(ids))
    }


def test_pairs_are_compared_packed(spark, monkeypatch):
    """Pairs in several runs, repeated ones too; six bytes a pair at most where a join sends sixteen and more."""
    from nearfold.operators import evaluate, pair_metrics

    monkeypatch.setattr(evaluate, "PAIRS_PACKED", 1 << 14)
    draw = np.random.default_rng(5)
    some = {(int(a), int(b)) for a, b in draw.integers(-500, 3000, (40_000, 2)) if a < b}
    true = {p for p in some if sum(p) % 3 == 0} | {(2**40, 2**41)}
    schema = "doc_a bigint, doc_b bigint"
    listed = spark.createDataFrame([*some, *list(some)[:900]], schema).repartition(2)
    row = pair_metrics(listed, spark.createDataFrame(list(true), schema)).first()
    assert (row.num_candidates, row.num_ground_truth, row.num_hits) == (len(some), len(true), len(true) - 1)
    a, b = (np.array(side) for side in zip(*some))
    batch = pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["doc_a", "doc_b"])
    assert sum(out.nbytes for out in evaluate.packed_pairs(iter([batch]), False)) < 6 * len(some)


def test_signatures_go_to_buckets_without_keys(docs, true_sets, monkeypatch):
    """Of several bands that two rows share, the first alone counts, with keys made from the signatures."""
    from nearfold.operators import lsh, minhash_signatures

    sent, whole = [], lsh.listed_candidates

    def watched(rows, *given):
        sent.append(rows.columns)
        return whole(rows, *given)

    monkeypatch.setattr(lsh, "listed_candidates", watched)
    signed = {i: brute.signature(s, 64) for i, s in true_sets.items()}
    rows = lsh.estimated_candidates(minhash_signatures(shingle_sets(clean(docs)), 64), 32, 2).collect()
    found = brute.candidates(signed, 32, 2)
    assert {(r.doc_a, r.doc_b) for r in rows} == set(found) and len(rows) == len(found)
    assert "signature" in sent[0] and "band_keys" not in sent[0]
