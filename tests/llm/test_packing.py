from bisect import bisect_right

from hypothesis import given, settings
from hypothesis import strategies as st

from nearfold.llm.packing import LENGTHS, pack_documents, plan_packing, sequence_cost
from tests.llm.helpers import AWKWARD, LONG, awkward, table


def unrolled(histogram, lengths):
    """Bins as lists of (offset, length), and their lengths, from a plan."""
    plan = plan_packing(histogram, lengths)
    total = sum(histogram.values())
    bins = {}
    for i, first in enumerate(plan.piece_start):
        end = plan.piece_start[i + 1] if i + 1 < len(plan.piece_start) else total
        for piece in range(first, end):
            nth, within = divmod(piece - first, plan.per_bin[i])
            bins.setdefault(plan.first_bin[i] + nth, []).append(
                (plan.offset[i] + within * plan.length[i], plan.length[i])
            )
    sizes = {b: plan.bin_length[bisect_right(plan.bin_start, b) - 1] for b in bins}
    return bins, sizes


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=30))
def test_plan_fills_bins_without_gaps(histogram):
    lengths = (8, 16, 64)
    bins, sizes = unrolled(histogram, lengths)
    assert sorted(bins) == list(range(len(bins)))
    placed = {}
    for number, pieces in bins.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
            placed[length] = placed.get(length, 0) + 1
        assert at <= sizes[number] == min(s for s in lengths if s >= at)
    assert placed == histogram


def test_small_pieces_fill_the_best_fitting_bin():
    bins, sizes = unrolled({10: 1, 6: 1, 5: 1}, (16,))
    assert {b: sorted(x[1] for x in v) for b, v in bins.items()} == {0: [6, 10], 1: [5]}


def test_bins_shrink_to_their_contents():
    _, sizes = unrolled({3: 1}, (4, 64))
    assert list(sizes.values()) == [4]


def test_packing_is_dense(spark, sf_small):
    packed = pack_documents(table(spark, sf_small, "documents")).toPandas()
    bins = packed.groupby("bin").agg(used=("n_tokens", "sum"), size=("bin_length", "first"))
    assert (bins.used <= bins["size"]).all()
    assert bins.used.sum() / bins["size"].sum() > 0.95
    for _, group in packed.sort_values("bin_offset").groupby("bin"):
        assert list(group.bin_offset) == [0, *group.n_tokens.cumsum()[:-1]]
    joint = sum(sequence_cost(s) for s in bins["size"])
    single = [
        sum(sequence_cost(s) for s in unrolled(_histogram(packed, size), (size,))[1].values())
        for size in LENGTHS if size >= packed.n_tokens.max()
    ]
    assert all(joint <= cost * 1.001 for cost in single)


def _histogram(packed, size):
    return packed.n_tokens.value_counts().to_dict()


def test_awkward_rows(spark):
    packed = pack_documents(awkward(spark)).toPandas()
    words = sorted(len((t or "").split()) + 1 for _, t, *_ in AWKWARD)
    whole = packed.groupby(["doc_id", "piece"], dropna=False).n_tokens.sum()
    assert packed.n_tokens.sum() == sum(words) and whole.sum() == sum(words)
    long = packed[packed.doc_id == 5].sort_values("piece")
    assert long.n_tokens.sum() == len(LONG.split()) + 1
    assert list(long.token_start) == [4096 * i for i in range(len(long))]
    assert pack_documents(awkward(spark).limit(0)).count() == 0


def test_given_lengths(spark):
    docs = spark.createDataFrame([(1, 5), (2, None), (3, -4), (4, 9000)], "doc_id long, n int")
    packed = pack_documents(docs.selectExpr("*", "'x' AS text"), length_col="n").toPandas()
    assert packed.groupby("doc_id").n_tokens.sum().to_dict() == {1: 5, 4: 9000}
