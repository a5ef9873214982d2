import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from nearfold.llm.sharding import bounded_shards, capacities, plan_walk, ring
from tests.llm.helpers import AWKWARD, awkward, table


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=40), st.integers(1, 8), st.data())
def test_walk_places_every_row_within_capacity(counts, shards, data):
    owners = [data.draw(st.integers(0, shards - 1)) for _ in counts]
    owners[: shards] = list(range(shards))[: len(owners)]
    if len(set(owners)) < shards or not sum(counts):
        return
    limits = capacities(sum(counts), shards)
    pieces = plan_walk(counts, owners, limits)
    ends = [p[0] for p in pieces[1:]] + [sum(counts)]
    slots = {s: [] for s in range(shards)}
    for (first, shard, slot), end in zip(pieces, ends, strict=True):
        slots[shard] += range(slot, slot + end - first)
    for shard, taken in slots.items():
        assert sorted(taken) == list(range(limits[shard]))
    homes = np.zeros(shards, int)
    np.add.at(homes, owners, counts)
    at_home = 0
    arc_of = np.repeat(np.arange(len(counts)), counts)
    for (first, shard, _), end in zip(pieces, ends, strict=True):
        at_home += sum(owners[a] == shard for a in arc_of[first:end])
    assert at_home == sum(min(h, m) for h, m in zip(homes, limits, strict=True))


def test_growth_moves_few_rows(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    before = bounded_shards(docs, shards=40).toPandas()
    after = bounded_shards(docs, shards=41).toPandas()
    both = before.merge(after, on="doc_id")
    assert (both.shard_x != both.shard_y).mean() < 0.2
    counts = before.groupby("shard").slot.agg(["count", "min", "max"])
    assert len(counts) == 40 and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] == counts["count"] - 1).all()


def test_rows_are_on_the_ring_or_behind_it(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    placed = bounded_shards(docs, shards=4, replicas=8).toPandas()
    points, owners = ring(4, 8)
    import xxhash

    for row in placed.itertuples():
        position = np.uint64(xxhash.xxh64_intdigest(str(row.doc_id), 42)).astype(np.int64)
        home = owners[np.searchsorted(points, position) % len(points)]
        assert (home != row.shard) == row.moved


def test_awkward_rows(spark):
    placed = bounded_shards(awkward(spark), shards=3).toPandas()
    assert len(placed) == len(AWKWARD)
    assert sorted(placed.groupby("shard").size()) == [4, 5, 5]
    empty = placed[(placed["size"] == 16)]
    assert (empty.text_crc32 == 0).all() and len(empty) == 3
    assert bounded_shards(awkward(spark).limit(0)).count() == 0


def test_loads_with_slack():
    assert capacities(10, 4) == [3, 3, 2, 2]
    assert capacities(10, 4, 0.2) == [3] * 4


def test_whole_query_equals_brute_force(spark, sf_small):
    """Ring, arcs, walk and slots again, row by row and without Spark."""
    import xxhash

    from nearfold.llm.queries import op2_bounded_ring

    rows = [(r.doc_id, r.text) for r in table(spark, sf_small, "documents").collect()]
    points, owners = ring(40)
    placed = []
    for key, text in rows:
        position = int(np.uint64(xxhash.xxh64_intdigest(str(key), 42)).astype(np.int64))
        placed.append((position, key, len(text.encode()) + 16))
    placed.sort()
    limits = capacities(len(rows), 40)
    arcs = [int(np.searchsorted(points, p)) for p, _, _ in placed]
    load = [0] * 40
    shard_of, waiting = {}, []
    for arc, (_, key, _) in zip(arcs, placed, strict=True):
        home = int(owners[arc % len(owners)])
        if load[home] < limits[home]:
            shard_of[key] = home
            load[home] += 1
        else:
            waiting.append((arc, key))
    for arc, key in waiting:
        at = arc + 1 if arc < len(owners) else 1
        while load[owners[at % len(owners)]] >= limits[owners[at % len(owners)]]:
            at += 1
        shard_of[key] = int(owners[at % len(owners)])
        load[shard_of[key]] += 1
    got = op2_bounded_ring(spark, sf_small).collect()
    assert {r.doc_id: r.shard for r in got} == shard_of
    sizes = {key: size for _, key, size in placed}
    assert all(r["size"] == sizes[r.doc_id] and r.law == "rows" and r.grown_shard is None for r in got)
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(40) for i in range(limits[s])]
