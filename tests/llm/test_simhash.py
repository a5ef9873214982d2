import numpy as np
import pytest
import xxhash

from nearfold.llm import simhash
from nearfold.llm.components import components
from nearfold.llm.simhash import Groups, drop_near_copies, fingerprint, linked_fingerprints, simhash_components
from tests.llm.helpers import AWKWARD, LONG, awkward, table


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, most=4):
    """Distinct fingerprints to the set they belong to, by comparing all."""
    values = sorted(set(values))
    group = {v: {v} for v in values}
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= most and group[a] is not group[b]:
                merged = group[a] | group[b]
                for v in merged:
                    group[v] = merged
    return group


@pytest.mark.parametrize("text", ["", "  ", "One", "A b C d", "a b c d e f", "Ä É漢 x\x0by", LONG, "a b  c"])
def test_fingerprint_of_one_text(text):
    assert fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


def near_values(rng, centres, around):
    values = []
    for centre in rng.integers(0, 2**63, centres, dtype=np.uint64):
        for _ in range(around):
            value = int(centre)
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                value ^= 1 << int(bit)
            values.append(value)
    return values


@pytest.mark.parametrize("crowd", [2048, 4])
def test_links_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "GROUP_FINGERPRINTS", crowd)
    values = near_values(np.random.default_rng(crowd), 30, 12)
    signed = np.unique(np.array(values, np.uint64)).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = linked_fingerprints(fps, prefix_bits=3).collect()
    assert all(((e.u ^ e.v) & (2**64 - 1)).bit_count() <= 4 for e in edges)
    roots = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    expected = plain_components([v & (2**64 - 1) for v in signed])
    for v in signed:
        group = {x for x in signed if roots.get(x, x) == roots.get(v, v)}
        assert {x & (2**64 - 1) for x in group} == expected[v & (2**64 - 1)]


def test_every_variant_is_dealt_once():
    groups = Groups({1: 2}, 4, 2)
    keys, values = groups.deal(np.array([0x123456789ABCDEF0], np.uint64))
    assert len(set(keys.tolist())) == len(keys)
    assert set(values.tolist()) == {0x123456789ABCDEF0}


def test_whole_table_equals_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    groups = plain_components(prints.values())
    for row in simhash_components(docs).collect():
        assert row.fp & (2**64 - 1) == prints[row.doc_id]
        assert row.component_id == min(d for d, p in prints.items() if p in groups[prints[row.doc_id]])


def test_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_joins_of_hubs_can_be_split(spark):
    from nearfold.llm.components import _large_star, _small_star

    edges = spark.range(1, 300).selectExpr("id AS u", "0L AS v")
    for star in (_large_star, _small_star):
        plan = star(edges)._jdf.queryExecution().executedPlan().toString().splitlines()
        joins = [i for i, line in enumerate(plan) if "SortMergeJoin" in line]
        assert joins
        for i, line in enumerate(plan):
            if "Sort [" in line:
                assert "Exchange hashpartitioning(u" in plan[i + 1]


def test_awkward_rows(spark):
    rows = simhash_components(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.component_id for r in rows if r.fp == 0} == {2}
    assert [r.component_id for r in rows if r.doc_id == 6] == [6, 6]
    assert simhash_components(awkward(spark).limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = awkward(spark)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 5, 6, 7, 8, 9]
    assert sum(r.doc_id is None for r in kept.collect()) == 2
    assert drop_near_copies(docs.limit(0)).count() == 0
