import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearfold.operators import (
    band_buckets,
    dedup_audit,
    doc_degrees,
    exact_pairs,
    hash_family_table,
    jaccard_histogram,
    lsh_candidates,
    minhash_signatures,
    pair_metrics,
    sample_pairs,
    shingle_sets,
    shingle_table,
    top_pairs,
    verify_candidates,
)
from nearfold.operators.classes import class_members, collapse, expand_pairs
from nearfold.operators.lsh import class_candidates
from nearfold.operators.tiling import all_pairs, pairs_within, tiled_join
from tests import brute

K = 5


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate(brute.corpus(70)))


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)


@pytest.fixture(scope="module")
def true_sets(texts):
    return {i: brute.shingles(t, K) for i, t in texts.items()}


@pytest.fixture(scope="module")
def sets(docs):
    return shingle_sets(docs, K).cache()


def pair_set(df):
    rows = [(r.doc_a, r.doc_b) for r in df.collect()]
    assert len(rows) == len(set(rows))
    assert all(a < b for a, b in rows)
    return set(rows)


def scores(df):
    pair_set(df)
    return {(r.doc_a, r.doc_b): r.jaccard for r in df.collect()}


def test_shingle_forms_agree(docs, sets, true_sets):
    assert {r.doc_id: set(r.shingles) for r in sets.collect()} == true_sets
    assert all(r.n_shingles == len(r.shingles) for r in sets.collect())
    long = sorted(tuple(r) for r in shingle_table(docs, K).collect())
    assert long == sorted((i, x) for i, items in true_sets.items() for x in items)


def test_hash_family_table(spark):
    rows = [tuple(r) for r in hash_family_table(spark, 8, 3).orderBy("i").collect()]
    assert rows == [(i, a, b) for i, (a, b) in enumerate(brute.family(8, 3))]


@pytest.mark.parametrize("bands,rows", [(16, 4), (32, 2), (64, 1), (1, 64)])
def test_candidates_match_definition(sets, true_sets, bands, rows):
    signatures = {i: brute.signature(s, 64) for i, s in true_sets.items()}
    got = pair_set(lsh_candidates(minhash_signatures(sets, 64), bands, rows))
    assert got == brute.candidates(signatures, bands, rows)


def test_band_buckets(sets, true_sets):
    rows = band_buckets(minhash_signatures(sets, 64), 16, 4).collect()
    assert len(rows) == 16 * len(true_sets)
    by_bucket = {}
    for r in rows:
        by_bucket.setdefault((r.band, r.bucket), []).append(r.doc_id)
    pairs = {p for ids in by_bucket.values() for p in combinations(sorted(ids), 2)}
    signatures = {i: brute.signature(s, 64) for i, s in true_sets.items()}
    assert pairs == brute.candidates(signatures, 16, 4)


def test_wrong_banding_is_refused(sets):
    with pytest.raises(Exception, match="must equal bands"):
        band_buckets(minhash_signatures(sets, 64), 16, 8).collect()
    with pytest.raises(ValueError):
        band_buckets(minhash_signatures(sets, 64), 0, 8)


def test_similar_pair_is_candidate(spark):
    base = "the quick brown fox jumps over the lazy dog " * 30
    rows = [(0, base), (1, base + " slightly different ending to make it a near duplicate"),
            (2, "completely unrelated xyz abc def " * 20)]
    df = shingle_sets(spark.createDataFrame(rows, "doc_id bigint, text string"), 5)
    assert (0, 1) in pair_set(lsh_candidates(minhash_signatures(df, 128), 32, 4))


def test_dissimilar_pair_is_not(spark):
    rows = [(0, "aardvark apple avenue artifact academic " * 50),
            (1, "zebra zealot zenith zeppelin zombie " * 50)]
    df = shingle_sets(spark.createDataFrame(rows, "doc_id bigint, text string"), 5)
    assert not pair_set(lsh_candidates(minhash_signatures(df, 128, 99), 8, 16))


def test_copies_pair_completely(spark):
    rows = [(i, "shared base content " * 15) for i in range(6)]
    df = shingle_sets(spark.createDataFrame(rows, "doc_id bigint, text string"), 5)
    got = pair_set(lsh_candidates(minhash_signatures(df, 64), 16, 4))
    assert got == set(combinations(range(6), 2))


def test_verify_keeps_threshold_and_missing_documents(spark, sets, true_sets):
    pairs = list(combinations(range(12), 2)) + [(3, 999), (998, 999)]
    given = spark.createDataFrame(pairs, "doc_a bigint, doc_b bigint")
    want = {p: brute.jaccard(true_sets.get(p[0], set()), true_sets.get(p[1], set())) for p in pairs}
    assert scores(verify_candidates(given, sets, 0.0)) == want
    half = {p: j for p, j in want.items() if j >= 0.5}
    assert scores(verify_candidates(given, sets, 0.5)) == half


@pytest.mark.parametrize("threshold", [1.0, 0.8, 0.5, 0.3, 0.05, 0.0])
def test_exact_pairs_match_definition(sets, true_sets, threshold):
    assert scores(exact_pairs(sets, threshold)) == brute.exact(true_sets, threshold)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_pairs_on_random_sets(spark, seed):
    """Many sets over few items: hot items, size ratios at the limits, empty sets."""
    rng = random.Random(seed)
    true = {i: set(rng.sample(range(30), rng.randint(0, 24))) for i in range(60)}
    rows = [(i, rng.sample(sorted(s), len(s))) for i, s in true.items()]
    df = spark.createDataFrame(rows, "doc_id bigint, shingles array<int>")
    for threshold in (0.5, 2 / 3, 0.7):
        assert scores(exact_pairs(df, threshold, tile_rows=3)) == brute.exact(true, threshold)


def test_hot_key_is_dealt_into_tiles(spark, monkeypatch):
    """No task gets more than two tiles of a key that holds half of all rows."""
    from pyspark.sql import functions as F

    from nearfold.operators import tiling

    rows = spark.range(400).selectExpr("id AS doc_id", "if(id % 2 = 0, 0, id) AS g")
    want = 200 * 199 // 2
    for limit in (tiling.BROADCAST_BYTES, 0):  # shared keys broadcast, or sorted and merged
        monkeypatch.setattr(tiling, "BROADCAST_BYTES", limit)
        assert pairs_within(rows, ["g"], tile_rows=20).count() == want
    placed = tiling._place(
        rows.where("g = 0"), "doc_id", tiling.tile_count(F.lit(200), 20)
    ).groupBy("_lo", "_hi").count()
    assert placed.agg(F.max("count")).first()[0] < 2 * 45
    monkeypatch.undo()
    plan = pairs_within(rows, ["g"], tile_rows=20)._jdf.queryExecution().executedPlan().toString()
    # Sizes come from the broadcast list of shared keys; rows are shuffled by tile only.
    shuffles = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert "BroadcastHashJoin" in plan and shuffles and all("_lo" in keys for keys in shuffles)


def test_rows_that_share_no_key_do_not_travel(spark):
    """Single rows are dropped ahead of the exchange of the self-join."""
    from nearfold.operators import tiling

    rows = spark.range(1000).selectExpr("id AS doc_id", "if(id < 10, 0, id) AS g")
    shared, count = tiling.shared_keys(rows, ["g"])
    assert count == 1 and [tuple(r) for r in shared.collect()] == [(0, 10)]
    pairs = pairs_within(rows, ["g"])
    assert pairs.count() == 45
    plan = pairs._jdf.queryExecution().executedPlan()
    pairs.collect()
    written = [int(x) for x in re.findall(r"rowsWritten=(\d+)", _exchange_rows(plan))]
    assert written and max(written) == 10
    assert pairs_within(rows.where("doc_id > 9"), ["g"]).count() == 0


def _exchange_rows(plan):
    """``rowsWritten=n`` of every exchange of an executed plan."""
    found, open_ = [], [plan]
    while open_:
        node = open_.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            open_.append(node.executedPlan())
        elif "QueryStage" in name:
            open_.append(node.plan())
        elif name == "Exchange":
            found.append(f"rowsWritten={node.metrics().apply('shuffleRecordsWritten').value()}")
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return " ".join(found)


def test_pair_comes_from_its_first_shared_band_only(spark):
    """Nothing is aggregated above the join, however many bands a pair shares."""
    rows = [(0, 1, [1, 2, 3, 4]), (1, 1, [9, 2, 3, 4]), (2, 1, [9, 8, 7, 4]), (3, 2, [6, 6, 6, 6])]
    df = spark.createDataFrame(rows, "rep bigint, docs bigint, band_keys array<bigint>")
    found = class_candidates(df)
    assert sorted((r.rep_a, r.rep_b) for r in found.collect()) == [(0, 1), (0, 2), (1, 2)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "Aggregate" not in plan


def test_wanted_rows_are_filtered_at_the_scan(spark, sf_small, monkeypatch):
    from nearfold.operators import verify

    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    pairs = spark.createDataFrame([(1, 7), (7, 30), (5, 10**12)], "doc_a bigint, doc_b bigint")
    for limit, join in ((verify.BROADCAST_BYTES, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(verify, "BROADCAST_BYTES", limit)
        kept = verify.referenced(docs, pairs, "doc_a", "doc_b")
        assert {r.doc_id for r in kept.collect()} == {1, 5, 7, 30}
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert join in plan and "LeftSemi" in plan


def test_frequency_sketch_bounds_counts(spark, monkeypatch):
    from nearfold.operators import exact

    rng = random.Random(4)
    rows = [(i, sorted(rng.sample(range(500), 40))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, shingles array<int>").repartition(3)
    true = Counter(x for _, s in rows for x in s)
    want = sorted(exact_pairs(df, 0.1).collect())
    for bits in (20, 12):  # at 12 bits one stretch, and shingles that share counters
        monkeypatch.setattr(exact, "SKETCH_BITS", bits)
        sketch = exact.frequency_sketch(df)
        cells = exact._cell(np.arange(500))
        assert all(sketch[cells[x]] >= n for x, n in true.items()) and sketch.sum() == 2000
        placed, most = exact.rarest_first(df)
        assert most == sketch.max()
        for r in placed.collect():
            assert r.n == 40 and sorted(r.shingles) == rows[r.doc_id][1]
            assert r.shingles == sorted(r.shingles, key=lambda x: (sketch[cells[x]], x))
        assert sorted(exact_pairs(df, 0.1).collect()) == want
    assert exact.frequency_sketch(df.limit(0)).sum() == 0 and exact_pairs(df.limit(0), 0.5).count() == 0


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_broadcast_and_merge_give_the_same_pairs(sets, true_sets, monkeypatch, limit):
    from nearfold.operators import verify

    monkeypatch.setattr(verify, "BROADCAST_BYTES", limit)
    assert scores(exact_pairs(sets, 0.5)) == brute.exact(true_sets, 0.5)
    assert verify.held_bytes(400_000, 400_000) > 36_800_000


@pytest.mark.parametrize("block_bytes", [1, 4000, 1 << 24])
def test_blocks_of_any_size_give_the_same_scores(spark, block_bytes):
    """A set that is missing is empty; a set goes to a block once, however many pairs it has."""
    from nearfold.operators import verify

    rng = random.Random(4)
    rows = [(i, rng.sample(range(60), rng.randrange(0, 40))) for i in range(30)]
    held = {i: set(s) for i, s in rows}
    sets = spark.createDataFrame(rows, "doc_id bigint, shingles array<int>")
    pairs = [(i, j, f"x{i}") for i in range(32) for j in range(i + 1, 32)]
    frame = spark.createDataFrame(pairs, "doc_a bigint, doc_b bigint, note string")
    got = verify.by_blocks(frame, sets, "doc_a", "doc_b", verify.count_elements(sets), block_bytes)
    want = {(a, b, n, brute.jaccard(held.get(a, set()), held.get(b, set()))) for a, b, n in pairs}
    assert {tuple(r) for r in got.collect()} == want
    assert got.columns == ["doc_a", "doc_b", "note", "jaccard"]


def test_rounding_follows_python(spark):
    from nearfold.functions import python_fixed, python_round

    values = [100.0 * 107 / 4000, 1.00005, 0.5, 2.5, None, 0.125]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 4):
        got = df.select(python_round("v", digits).alias("r"), python_fixed("v", digits).alias("f")).collect()
        assert [r.r for r in got] == [None if v is None else round(v, digits) for v in values]
        assert [r.f for r in got] == [None if v is None else f"{v:.{digits}f}" for v in values]
    assert [r.r for r in df.select(python_round("v", 2).alias("r")).collect()][0] == 2.67


@pytest.mark.parametrize("tile_rows", [1, 3, 4096])
def test_pairs_within_tiles(spark, tile_rows):
    rows = [(i, i % 2 if i < 20 else 9 + i) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id bigint, g int")
    got = [(r.a.id, r.b.id) for r in pairs_within(df, ["g"], tile_rows=tile_rows).collect()]
    want = [(i, j) for (i, g), (j, h) in combinations(rows, 2) if g == h]
    assert sorted(got) == want


def test_pairs_carry_follows_the_id(spark):
    rows = [(i, 0, 100 + i) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, g int, note int")
    for r in pairs_within(df, ["g"], carry=["note"], tile_rows=2).collect():
        assert r.a.id < r.b.id and r.a.note == 100 + r.a.id and r.b.note == 100 + r.b.id


def test_all_pairs(spark):
    df = spark.range(11).withColumnRenamed("id", "doc_id")
    got = sorted((r.a.id, r.b.id) for r in all_pairs(df, tile_rows=3).collect())
    assert got == list(combinations(range(11), 2))


def test_tiled_join_meets_each_pair_once(spark):
    left = spark.range(20).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("k"))
    right = spark.range(30).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("k"))
    hot = spark.createDataFrame([(0, 10, 10), (1, 10, 10)], "k bigint, _left bigint, _right bigint")
    met = tiled_join(left, right, ["k"], F.lit(True), "doc_id", hot, 3)
    got = sorted((r[0], r[1]) for r in met.select("l.doc_id", "r.doc_id").collect())
    assert got == sorted((i, j) for i in range(20) for j in range(30) if i % 2 == j % 3)


@pytest.mark.parametrize("tile_rows", [2, 4096])
def test_expand_pairs(spark, tile_rows):
    keys = [0, 0, 0, 0, 0, 1, 2, 2, 3]
    df = spark.createDataFrame(list(enumerate(keys)), "doc_id bigint, key int")
    classes = collapse(df, ["key"])
    reps = {r.key: (r.rep, r.docs) for r in classes.collect()}
    linked = [(0, 2), (1, 3), (0, 1)]
    rows = [(*[reps[k][0] for k in ks], *[reps[k][1] for k in ks], 0.5) for ks in linked]
    schema = "rep_a bigint, rep_b bigint, docs_a bigint, docs_b bigint, jaccard double"
    between = spark.createDataFrame(rows, schema)
    members = class_members(df, classes, ["key"])
    out = expand_pairs(between, members, ["jaccard"], {"jaccard": 1.0}, tile_rows)
    want = {
        (i, j): 1.0 if keys[i] == keys[j] else 0.5
        for i, j in combinations(range(len(keys)), 2)
        if keys[i] == keys[j] or (keys[i], keys[j]) in linked or (keys[j], keys[i]) in linked
    }
    assert scores(out) == want


def make_pairs(spark, rows):
    return spark.createDataFrame(rows, "doc_a bigint, doc_b bigint, jaccard double")


@pytest.mark.parametrize(
    "found,true,want",
    [
        ([(0, 1), (0, 2)], [(0, 1), (3, 4)], (2, 2, 1, 0.5, 0.5, 0.5)),
        ([], [], (0, 0, 0, 1.0, 1.0, 1.0)),
        ([], [(0, 1)], (0, 1, 0, 0.0, 0.0, 0.0)),
        ([(0, 1)], [], (1, 0, 0, 0.0, 0.0, 0.0)),
        ([(0, 1)], [(1, 2)], (1, 1, 0, 0.0, 0.0, 0.0)),
    ],
)
def test_pair_metrics(spark, found, true, want):
    schema = "doc_a bigint, doc_b bigint"
    row = pair_metrics(spark.createDataFrame(found, schema), spark.createDataFrame(true, schema))
    got = row.select(
        "num_candidates", "num_ground_truth", "num_hits", "precision", "recall", "f1"
    ).first()
    assert tuple(got) == want


def test_audit_of_document_pairs(spark):
    rows = [(0, 1, 1.0), (0, 2, 0.5), (3, 4, 0.6), (5, 6, 0.59999), (7, 8, 0.95)]
    pairs = make_pairs(spark, rows)
    audit = dedup_audit(pairs, 40).first()
    assert tuple(audit) == (40, 5, 9, 22.5, round(sum(r[2] for r in rows) / 5, 4))
    degrees = {r.doc_id: r.pairs for r in doc_degrees(pairs).collect()}
    assert degrees == {0: 2, **dict.fromkeys(range(1, 9), 1)}
    bins = {r.bin: (r.pairs, r.pct) for r in jaccard_histogram(pairs).collect()}
    assert bins == {"[0.5, 0.6)": (2, 40.0), "[0.6, 0.7)": (1, 20.0), "[0.7, 0.8)": (0, 0.0),
                    "[0.8, 0.9)": (0, 0.0), "[0.9, 1.0)": (2, 40.0)}


def test_audit_without_pairs(spark):
    pairs = make_pairs(spark, [])
    assert tuple(dedup_audit(pairs, 0).first()) == (0, 0, 0, 0.0, 0.0)
    assert tuple(dedup_audit(pairs, 7).first()) == (7, 0, 0, 0.0, 0.0)
    assert [(r.pairs, r.pct) for r in jaccard_histogram(pairs).collect()] == [(0, 0.0)] * 5


def test_histogram_percent_counts_pairs_below_the_bins(spark):
    rows = jaccard_histogram(make_pairs(spark, [(0, 1, 0.2), (0, 2, 0.7)])).collect()
    assert {r.bin: r.pct for r in rows}["[0.7, 0.8)"] == 50.0


def test_top_pairs(spark):
    rows = [(5, 6, 0.8), (0, 1, 0.9), (0, 9, 0.8), (2, 3, 0.53125), (1, 2, 0.1)]
    docs = spark.createDataFrame(
        [(i, f" text {i}\n" + "z" * 300 * (i == 1)) for i in range(7)], "doc_id bigint, text string"
    )
    got = [tuple(r) for r in top_pairs(make_pairs(spark, rows), docs, 4).orderBy("rank").collect()]
    assert [g[:4] for g in got] == [
        (1, 0, 1, "0.9000"), (2, 0, 9, "0.8000"), (3, 5, 6, "0.8000"), (4, 2, 3, "0.5312")
    ]
    assert got[0][4] == "text 0" and got[0][5].endswith("zzz...")
    assert got[1][5] == "[text not found]"


def test_sample_pairs_dense_and_sparse(spark):
    dense = spark.range(50).withColumnRenamed("id", "doc_id")
    sparse = dense.select((F.col("doc_id") * 7 + 3).alias("doc_id"))
    a = {r.draw: (r.doc_a, r.doc_b) for r in sample_pairs(dense, 400, 1).collect()}
    b = {r.draw: (r.doc_a, r.doc_b) for r in sample_pairs(sparse, 400, 1).collect()}
    assert len(a) == 400 and all(x != y and 0 <= min(x, y) <= max(x, y) < 50 for x, y in a.values())
    assert b == {d: (x * 7 + 3, y * 7 + 3) for d, (x, y) in a.items()}
    assert len({x for x, _ in a.values()}) == 50
    with pytest.raises(ValueError):
        sample_pairs(dense.limit(1), 5)


def test_shingle_table_in_slices(docs, true_sets, monkeypatch):
    """Sets of a few bytes of text at a time give the same rows; NULL counts as empty."""
    from nearfold.functions import shingles

    monkeypatch.setattr("nearfold.operators.shingling.char_shingles", lambda *_: pytest.fail("a batch's sets are held"))
    monkeypatch.setattr(shingles, "SLICE_BYTES", 100)
    more = docs.union(docs.sparkSession.createDataFrame([(10**6, None)], docs.schema))
    rows = [(r.doc_id, r.shingle) for r in shingle_table(more, 5).collect()]
    want = {(i, x) for i, s in true_sets.items() for x in s} | {(10**6, x) for x in brute.shingles("", 5)}
    assert set(rows) == want and len(rows) == len(want)
