import random
import statistics
import sys
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from nearfold.operators import exact_pairs, minhash_signatures, sample_pairs, shingle_sets, top_class_pairs
from nearfold.params import Params
from nearfold.plans import (
    NearDuplicates,
    audit_report,
    clean,
    corpus_audit,
    estimator_error,
    example_report,
    near_duplicates,
    pair_estimates,
    param_sweep,
    report_lines,
    run_near_duplicates,
    s_curve_table,
    scalability_counts,
    timed_estimator_error,
    timed_param_sweep,
    timed_scalability,
)
from nearfold.sources import write_text
from tests import brute

PARAMS = Params(k=5, num_hashes=64, bands=16, rows=4)


@pytest.fixture(scope="module")
def raw():
    texts = [t.title() + random.Random(len(t)).choice(["", "!", "\n"]) for t in brute.corpus(80, 11)]
    return dict(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark, raw):
    return spark.createDataFrame(list(raw.items()), "doc_id bigint, text string").cache()


@pytest.fixture(scope="module")
def true_sets(raw):
    return {i: brute.shingles(brute.normalize(t), 5) for i, t in raw.items()}


@pytest.fixture(scope="module")
def candidates(true_sets):
    return brute.candidates({i: brute.signature(s, 64) for i, s in true_sets.items()}, 16, 4)


@pytest.fixture(scope="module")
def confirmed(true_sets, candidates):
    scored = {p: brute.jaccard(true_sets[p[0]], true_sets[p[1]]) for p in candidates}
    return {p: j for p, j in scored.items() if j >= 0.5}


def scores(df):
    rows = df.collect()
    assert all(r.doc_a < r.doc_b for r in rows)
    assert len({(r.doc_a, r.doc_b) for r in rows}) == len(rows)
    return {(r.doc_a, r.doc_b): r.jaccard for r in rows}


def test_near_duplicates(docs, confirmed):
    assert any(j == 1.0 for j in confirmed.values()) and any(j < 1.0 for j in confirmed.values())
    assert scores(near_duplicates(docs, PARAMS)) == confirmed


def test_candidates_of_a_run(docs, candidates):
    got = {(r.doc_a, r.doc_b) for r in NearDuplicates(docs, PARAMS).candidates.collect()}
    assert got == candidates


def test_run_summary(spark, docs, candidates, confirmed):
    summary = run_near_duplicates(docs, PARAMS)
    assert summary.num_docs == 80
    assert summary.num_candidates == len(candidates)
    assert summary.num_confirmed == len(confirmed)
    assert scores(summary.confirmed_pairs) == confirmed
    rows = {r.phase: (r.rows, r.seconds) for r in summary.metrics(spark).collect()}
    assert set(rows) == {"sketching", "lsh", "verification", "total"}
    assert all(seconds > 0 for _, seconds in rows.values())


def test_raw_texts_and_null(spark):
    rows = [(0, "Some TEXT here"), (1, "some text here"), (2, None), (3, ""), (4, "!!")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert set(scores(near_duplicates(df, PARAMS))) == {(0, 1), (2, 3), (2, 4), (3, 4)}
    assert set(scores(near_duplicates(df, PARAMS, normalize=False))) == {(2, 3)}
    assert set(scores(near_duplicates(df, PARAMS, drop_empty=True))) == {(0, 1)}


def test_wrong_params():
    with pytest.raises(ValueError):
        Params(num_hashes=64, bands=16, rows=8)


def test_threshold_above_one_finds_nothing(docs):
    params = Params(num_hashes=64, bands=16, rows=4, threshold=1.01)
    assert scores(near_duplicates(docs, params)) == {}


def test_param_sweep(docs, true_sets):
    sets = shingle_sets(clean(docs), 5)
    signatures = minhash_signatures(sets, 64)
    truth = exact_pairs(sets, 0.5)
    configs = [(4, 16), (16, 4), (64, 1)]
    rows = param_sweep(signatures, truth, configs).collect()
    signed = {i: brute.signature(s, 64) for i, s in true_sets.items()}
    true = set(brute.exact(true_sets, 0.5))
    for row, (b, r) in zip(rows, configs):
        found = brute.candidates(signed, b, r)
        assert tuple(row)[:5] == (b, r, 0.5, len(found), len(true))
        assert row.recall == round(len(found & true) / len(true), 4)
        assert row.precision == round(len(found & true) / len(found), 4)
    timed = timed_param_sweep(signatures, truth, configs[:1]).first()
    assert tuple(timed)[:8] == tuple(rows[0]) and timed.runtime_seconds > 0


def test_s_curve_table(spark):
    rows = s_curve_table(spark, [(16, 8), (4, 2)], 11).collect()
    assert len(rows) == 22
    for r in rows:
        assert r.probability == pytest.approx(1 - (1 - r.similarity**r.r) ** r.b, abs=1e-12)
    assert {round(r.similarity, 6) for r in rows} == {i / 10 for i in range(11)}


def test_scalability(docs, true_sets, candidates):
    exact = brute.exact(true_sets, 0.5)
    want = set()
    for fraction in (0.001, 0.25, 1.0):
        n = max(1, int(80 * fraction))
        want.add((n, fraction, "lsh", sum(b < n for _, b in candidates)))
        want.add((n, fraction, "brute_force", sum(b < n for _, b in exact)))
    got = scalability_counts(docs, (0.001, 0.25, 1.0), PARAMS)
    assert {tuple(r) for r in got.collect()} == want
    timed = timed_scalability(docs, (0.001, 0.25, 1.0), PARAMS)
    assert timed.columns == [
        "num_docs", "fraction", "method", "runtime_seconds", "num_pairs_found"
    ]
    assert {(r[0], r[1], r[2], r[4]) for r in timed.collect()} == want


def test_estimator_error(spark, docs, true_sets):
    pairs = sample_pairs(docs, 120)
    drawn = [(r.doc_a, r.doc_b) for r in pairs.orderBy("draw").collect()]
    lengths = [8, 32]
    rows = {r.n: r for r in estimator_error(clean(docs), pairs, lengths).collect()}
    for n in lengths:
        signed = {i: brute.signature(s, n) for i, s in true_sets.items()}
        errors = [
            abs(sum(x == y for x, y in zip(signed[a], signed[b])) / n
                - brute.jaccard(true_sets[a], true_sets[b]))
            for a, b in drawn
        ]
        assert rows[n].mean_absolute_error == pytest.approx(statistics.fmean(errors), abs=1e-6)
        assert rows[n].std_error == pytest.approx(statistics.pstdev(errors), abs=1e-6)
        assert rows[n].theoretical_bound_1_over_sqrt_n == round(n**-0.5, 6)
        assert rows[n].num_pairs == 120
    timed = timed_estimator_error(clean(docs), pairs, [8]).first()
    assert tuple(timed)[:5] == tuple(rows[8]) and timed.runtime_seconds > 0
    assert pair_estimates(clean(docs), pairs, lengths).count() == 240


def test_audit_without_expansion(docs, confirmed):
    audit, histogram, summary = corpus_audit(docs, PARAMS)
    ends = {i for pair in confirmed for i in pair}
    row = audit.first()
    assert row.total_docs == 80 and row.total_confirmed_pairs == len(confirmed)
    assert row.docs_with_at_least_one_duplicate == len(ends)
    assert row.pct_docs_with_duplicate == round(100 * len(ends) / 80, 2)
    mean = statistics.fmean(confirmed.values())
    assert row.mean_jaccard_among_pairs == pytest.approx(mean, abs=5e-5)
    bins = {r.bin: r.pairs for r in histogram.collect()}
    assert bins["[0.9, 1.0)"] == sum(j >= 0.9 for j in confirmed.values())
    assert sum(bins.values()) == len(confirmed)
    degrees = {r.doc_id: r.pairs for r in _degrees(summary)}
    assert degrees == {i: sum(i in pair for pair in confirmed) for i in ends}


def _degrees(summary):
    from nearfold.operators import doc_degrees

    return doc_degrees(summary.run.compact, summary.run.members).collect()


def test_audit_report(docs, tmp_path):
    audit, histogram, summary = corpus_audit(docs, PARAMS)
    report = audit_report(audit, histogram, summary)
    rows = report.orderBy("position").collect()
    assert [r.section for r in rows] == (
        ["configuration"] * 5 + ["results"] * 5 + ["seconds"] * 4 + ["histogram"] * 5
    )
    write_text(report_lines(report), str(tmp_path / "audit"))
    lines = "".join(p.read_text() for p in (tmp_path / "audit").glob("*.txt")).splitlines()
    assert len(lines) == 19 and lines[0] == "configuration | shingle size | 5"
    assert lines[5] == "results | total documents | 80"


def test_example_report(docs, raw, confirmed, tmp_path):
    write_text(example_report(docs, "test corpus", PARAMS, n=3, chars=20), str(tmp_path / "top"))
    lines = "".join(p.read_text() for p in (tmp_path / "top").glob("*.txt")).splitlines()
    best = sorted(confirmed, key=lambda p: (-confirmed[p], p))[:3]
    assert lines[:4] == ["corpus: test corpus", "documents: 80", f"pairs: {len(confirmed)}", "shown: 3"]
    blocks = lines[9:]
    assert len(blocks) == 27
    for rank, (a, b) in enumerate(best, start=1):
        block = blocks[9 * (rank - 1) : 9 * rank]
        assert block[0] == "=" * 70 and block[2] == block[5] == "-" * 70
        assert block[1] == (
            f"Rank #{rank} | Doc {a} vs Doc {b} | Jaccard = {confirmed[a, b]:.4f}"
        )
        for at, doc in ((3, a), (6, b)):
            text = raw[doc]
            assert block[at] == f"[Doc {doc}]"
            assert block[at + 1] == text[:20].replace("\n", " ").strip() + (
                "..." if len(text) > 20 else ""
            )


def test_third_of_corpus_is_one_text(spark, true_sets):
    """Copies of one text meet as one class row, and expand to all their pairs."""
    rows = [(i, "one and the same text") for i in range(40)]
    rows += [(40 + i, f"different number {i * 7919} entirely {i * 104729}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    run = NearDuplicates(df, PARAMS)
    assert run.compact.where("docs_a = 40").count() == 1
    got = scores(run.pairs)
    assert {p for p in got if p[1] < 40} == set(combinations(range(40), 2))
    assert run.num_confirmed() == len(got)
    assert run.classes.agg(F.max("docs")).first()[0] == 40


def test_sweep_scores_of_known_counts(spark):
    """Three signatures, two of them true: 1 of 3 candidates is right by one row, all by two."""
    signatures = spark.createDataFrame(
        [(1, [7, 1]), (2, [7, 1]), (3, [7, 2])], "doc_id bigint, signature array<bigint>"
    )
    truth = spark.createDataFrame([(1, 2)], "doc_a bigint, doc_b bigint")
    rows = param_sweep(signatures, truth, [(2, 1), (1, 2)]).collect()
    assert [tuple(r)[3:] for r in rows] == [(3, 1, 0.3333, 1.0, 0.5), (1, 1, 1.0, 1.0, 1.0)]
    none = truth.limit(0)
    rows = param_sweep(signatures, none, [(2, 1)]).collect()
    assert [tuple(r)[3:] for r in rows] == [(3, 0, 0.0, 0.0, 0.0)]
    rows = param_sweep(signatures.where("doc_id = 1"), none, [(2, 1)]).collect()
    assert [tuple(r)[3:] for r in rows] == [(0, 0, 1.0, 1.0, 1.0)]


def test_separate_phases(docs, confirmed):
    summary = run_near_duplicates(docs, PARAMS, separate_phases=True)
    assert list(summary.seconds) == ["shingling", "minhash", "lsh", "verification", "total"]
    assert all(s > 0 for s in summary.seconds.values())
    assert scores(summary.confirmed_pairs) == confirmed and summary.num_docs == 80
    assert {r.phase for r in summary.metrics(docs.sparkSession).collect()} == set(summary.seconds)


def test_top_pairs_of_many_copies(spark):
    """A hundred thousand copies of one text are ranked without their five thousand million pairs."""
    copies = spark.range(100_000).selectExpr("id * 2 AS doc_id", "'one and the same text' AS text")
    others = spark.createDataFrame(
        [(1, "another text that two have"), (3, "another text that two have"), (5, "no other has this")],
        "doc_id bigint, text string",
    )
    run = NearDuplicates(copies.unionByName(others), PARAMS)
    got = [(r.doc_a, r.doc_b, r.jaccard) for r in top_class_pairs(run.compact, run.members, 5).collect()]
    assert got == [(0, 2 * i, 1.0) for i in range(1, 6)]


def test_top_class_pairs_equal_the_first_pairs(docs):
    run = NearDuplicates(docs, PARAMS)
    order = [F.desc("jaccard"), "doc_a", "doc_b"]
    for n in (1, 3, 50):
        want = [tuple(r) for r in run.pairs.orderBy(*order).limit(n).collect()]
        got = [tuple(r) for r in top_class_pairs(run.compact, run.members, n).collect()]
        assert sorted(got) == sorted(want)


@pytest.mark.parametrize("n", [1, 4, 25, 10_000])
def test_best_pairs_equal_the_first_of_all(docs, confirmed, monkeypatch, n):
    """Whatever the cut, ties at it included, and in rounds of a few candidates."""
    monkeypatch.setattr(sys.modules["nearfold.plans.near_duplicates"], "FIRST_ROUND", 2)
    run = NearDuplicates(docs, PARAMS)
    found, verified = run.best(n)
    got = [(r.doc_a, r.doc_b, r.jaccard) for r in top_class_pairs(found, run.members, n).collect()]
    want = sorted(((-j, *p) for p, j in confirmed.items()))[:n]
    assert sorted(got) == sorted((a, b, -j) for j, a, b in want)
    assert verified <= run.class_candidates.count()


def test_best_pairs_verify_fewer_candidates(spark):
    """Ten copies and their many far relations: none of these can be among the first, and none is read."""
    base = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(10)]
    rows += [(100 + i, " ".join(base + [f"w{i}x{j}" for j in range(i + 2)])) for i in range(20)]
    run = NearDuplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), PARAMS)
    found, verified = run.best(20)
    assert verified == 0 and run.class_candidates.count() > 20
    got = top_class_pairs(found, run.members, 20).collect()
    assert [(r.doc_a, r.doc_b) for r in got] == list(combinations(range(10), 2))[:20]
    empty = NearDuplicates(spark.createDataFrame([], "doc_id bigint, text string"), PARAMS)
    assert empty.best(5)[0].count() == 0


def test_estimates_send_no_sets(spark, docs, true_sets, monkeypatch):
    """One value a pair and length, in many blocks, long sets and unknown ids included."""
    from nearfold.plans import estimator

    for name in ("attach_jaccard", "minhash_signature"):
        monkeypatch.setattr(estimator, name, lambda *_, **__: pytest.fail("sets are sent"), raising=False)
    monkeypatch.setattr(estimator, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(estimator, "ROWS_AT_ONCE", 7)
    draw = random.Random(1)
    raw = {i: "".join(draw.choice("abcdefgh ") for _ in range(90_000)) for i in (900, 901)}
    sets = {i: brute.shingles(t, 5) for i, t in raw.items()} | true_sets
    assert len(sets[900]) <= 1 << 16
    raw[902], raw[903] = raw[900] + "".join(map(chr, range(0x4E00, 0x9000))) * 3, raw[900][:50_000]
    raw[902] += "".join(draw.choice("ijklmnopqrstuvwxyz") for _ in range(70_000))
    sets |= {i: brute.shingles(raw[i], 5) for i in (902, 903)}
    assert len(sets[902]) > 1 << 16
    more = clean(docs).union(spark.createDataFrame(list(raw.items()), "doc_id bigint, text string"))
    ids = sorted(true_sets)[:12]
    listed = [(a, b) for a in ids for b in ids if a != b] + [(900, 901), (902, 900), (902, 903), (903, ids[0])]
    pairs = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(listed)] + [(-1, ids[0], 10**9), (-2, -5, 900)],
        "draw bigint, doc_a bigint, doc_b bigint",
    )
    rows = pair_estimates(more, pairs, [4, 16]).collect()
    signed = {i: brute.signature(sets[i], 16) for i in {i for pair in listed for i in pair}}
    want = {
        (i, n): (brute.jaccard(sets[a], sets[b]), sum(x == y for x, y in zip(signed[a][:n], signed[b][:n])) / n)
        for i, (a, b) in enumerate(listed) for n in (4, 16)
    }
    assert {(r.draw, r.n): (r.jaccard, r.estimate) for r in rows} == want and len(rows) == len(want)
