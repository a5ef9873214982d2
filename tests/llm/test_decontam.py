import time
from itertools import combinations

import numpy as np
import pytest

from nearfold.llm.decontam import IDENTITY, MASKS, OVERLAP, best_run, drop_contaminated, leaks, mask_offsets, seed_hashes
from tests.llm.helpers import awkward, table

ITEM = [f"item{i}" for i in range(30)]


def equal_by_definition(doc, item):
    """Some alignment has a run of tokens with enough of them equal."""
    width = min(OVERLAP, len(item))
    return width > 0 and any(
        sum(a == b for a, b in zip(doc[i : i + width], item[j : j + width], strict=True)) >= IDENTITY * width - 1e-9
        for i in range(len(doc) - width + 1) for j in range(len(item) - width + 1)
    )


@pytest.mark.parametrize(("width", "replaced"), [(20, 4), (15, 3), (12, 2), (9, 1)])
def test_masks_hit_whatever_is_replaced(width, replaced):
    values = np.arange(1, width + 1, dtype=np.uint64)
    for places in combinations(range(width), replaced):
        other = values.copy()
        other[list(places)] += np.uint64(1000)
        assert any(
            np.array_equal(a, b) or (a == b).any()
            for kind, at in enumerate(mask_offsets(MASKS))
            for a, b in [(seed_hashes(values, at, kind), seed_hashes(other, at, kind))]
        )


def test_replaced_words_do_not_hide_a_passage(spark):
    rng = np.random.default_rng(1)
    docs, truth = [], set()
    for n in range(300):
        begin = int(rng.integers(0, 10))
        part = ITEM[begin : begin + int(rng.integers(8, 21))]
        part = [f"x{n}" if rng.random() < rng.choice([0, 0.1, 0.2, 0.3]) else w for w in part]
        words = [f"a{n}_{i}" for i in range(int(rng.integers(0, 9)))] + part + [f"b{n}"]
        docs.append((n, " ".join(words)))
        if equal_by_definition(words, ITEM) or equal_by_definition(words, ITEM[:6]):
            truth.add((n, 0 if equal_by_definition(words, ITEM) else 1))
            if equal_by_definition(words, ITEM) and equal_by_definition(words, ITEM[:6]):
                truth.add((n, 1))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(
        [(0, " ".join(ITEM)), (1, " ".join(ITEM[:6])), (2, None), (3, "")], "item_id long, text string"
    )
    found = {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()}
    long_items = {t for t in truth if t[1] == 0}
    assert {f for f in found if f[1] == 0} == long_items and len(long_items) > 30
    # Six tokens are fewer than a mask needs: found where all are equal.
    assert {f for f in found if f[1] == 1} <= {t for t in truth if t[1] == 1} and len(found) > len(long_items)


def test_every_pattern_of_replaced_words_in_short_items(spark):
    docs, items = [], []
    for width in range(1, 15):
        item = [f"t{width}_{i}" for i in range(width)]
        items.append((width, " ".join(item)))
        for replaced in range(width + 1):
            if width - replaced < IDENTITY * width - 1e-9:
                break
            for places in combinations(range(width), replaced):
                words = [f"r{i}" if i in places else w for i, w in enumerate(item)]
                docs.append((1000 * len(docs) + width, " ".join(["before", *words, "behind"])))
        over = ["r"] * replaced + item[replaced:]
        docs.append((1000 * len(docs), " ".join(over)))  # one word more than allowed
    found = leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                  spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(d, d % 1000) for d, _ in docs if d % 1000}


def test_planted_passages_of_the_data(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    found = {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()}
    texts = {r.item_id: r.text for r in items.collect()}
    exact = {(d.doc_id, i) for d in docs.collect() for i, t in texts.items() if t in d.text}
    assert exact and exact <= found and len(found) <= 1.2 * len(exact) + 3
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({d for d, _ in found})


def test_run_of_equal_tokens():
    item = np.arange(40)
    part = np.concatenate([np.full(5, -1), item[3:33], np.full(5, -2)])
    assert best_run(part, item, 2, 20, 0.8) == (5, 30, 30)
    assert best_run(part, item, 3, 20, 0.8) is None
    assert best_run(part[:10], item, 2, 20, 0.8) is None


def test_repeated_tokens_cost_their_length(spark):
    """A long text of one word against items of that word, and alignments over several ranges of places."""
    rng = np.random.default_rng(3)
    mixed = rng.choice(["same", "other"], 9000, p=[0.6, 0.4]).tolist()
    item = rng.choice(["same", "other"], 40, p=[0.6, 0.4]).tolist()
    docs = spark.createDataFrame(
        [(1, "same " * 100_000), (2, "same " * 12), (3, " ".join(mixed)), (4, "unlike it " * 50)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame(
        [(1, "same " * 30), (2, " ".join(item))], "item_id long, text string"
    )
    begun = time.perf_counter()
    got = {(r.doc_id, r.item_id): (r.token_start, r.n_tokens, r.n_equal) for r in leaks(docs, items).collect()}
    assert time.perf_counter() - begun < 30
    assert got[1, 1] == (0, 30, 30) and not {2, 4} & {d for d, _ in got}
    for key, words in ((1, ["same"] * 30), (2, item)):
        code = np.array([w == "same" for w in mixed]), np.array([w == "same" for w in words])
        runs = [best_run(*code, shift, OVERLAP, IDENTITY) for shift in range(-len(words), len(mixed))]
        # Runs that no mask meets do not exist at this identity, so every alignment counts.
        want = min((-e, n, s) for s, n, e in filter(None, runs))
        assert got[3, key] == (want[2], want[1], -want[0])


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = docs.selectExpr("doc_id AS item_id", "text")
    found = {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()}
    assert {(1, 1), (5, 5), (6, 6), (7, 7), (None, None)} <= found
    assert not {2, 3, 4} & {d for d, _ in found}
    kept = drop_contaminated(docs, items.where("item_id = 6"))
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    for empty_docs, empty_items in ((docs.limit(0), items), (docs, items.limit(0))):
        assert leaks(empty_docs, empty_items).count() == 0
