import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nearfold.functions import (
    LARGE_PRIME,
    char_shingles,
    error_bound,
    estimate_jaccard,
    excerpt,
    hash_family,
    jaccard,
    minhash_signature,
    normalize_text,
    s_curve,
    shingle_hash,
    text_sketch,
)
from nearfold.functions._batch import minhash_rows, shingle_rows
from tests import brute

TEXTS = [
    "", " ", "ab", "Hello, World!", "A\tB\nC", "é€x😀 Ünïcode", "İstanbul ẞ K", "x" * 300,
    "the quick brown fox jumps over the lazy dog", "a-b_c", "42nd street", "\x1c\x85\xa0x",
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = list(enumerate([*TEXTS, None]))
    return spark.createDataFrame(rows, "doc_id bigint, text string").cache()


def column(df, expr):
    return {row[0]: row[1] for row in df.select("doc_id", expr).collect()}


def test_normalize_matches_definition(texts):
    got = column(texts, normalize_text("text"))
    assert got == {i: brute.normalize(t) for i, t in enumerate([*TEXTS, ""])}


def test_shingle_hash(texts):
    got = column(texts.where("text is not null"), shingle_hash("text"))
    assert got == {i: brute.hash31(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("k", [1, 3, 5, 13, 20, 60])
def test_char_shingles_match_definition(texts, k):
    got = column(texts, char_shingles("text", k))
    for i, text in enumerate([*TEXTS, ""]):
        assert got[i] == sorted(brute.shingles(text, k))


def test_char_shingles_reject_k(texts):
    with pytest.raises(ValueError):
        char_shingles("text", 0)


def test_shingle_invariants(spark):
    rows = [(0, "abcdefgh"), (1, "aabbc"), (2, "ab"), (3, ""), (4, "a" * 16), (5, "b" * 16)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    three, one = column(df, char_shingles("text", 3)), column(df, char_shingles("text", 1))
    assert len(three[0]) == 6 and len(one[1]) == 3
    assert len(three[2]) == len(three[3]) == 1
    assert not set(three[4]) & set(three[5])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8), st.integers(1, 20))
def test_batch_shingles_property(texts, k):
    import numpy as np

    parts = [t.encode("utf-8", "ignore") for t in texts]
    texts = [p.decode() for p in parts]
    offsets = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)
    lengths, values = shingle_rows(np.frombuffer(b"".join(parts), dtype=np.uint8), offsets, k)
    at = 0
    for text, size in zip(texts, lengths.tolist()):
        assert values[at : at + size].tolist() == sorted(brute.shingles(text, k))
        at += size


def test_long_rows_cross_slices():
    import numpy as np

    from nearfold.functions import _batch

    rng = random.Random(3)
    texts = ["".join(rng.choices("abc d", k=n)) for n in (40_000, 7, 0, 33_000)]
    data = "".join(texts).encode()
    offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    old = _batch.RUN_BYTES
    try:
        _batch.RUN_BYTES = 1000
        lengths, values = shingle_rows(np.frombuffer(data, dtype=np.uint8), offsets, 5)
    finally:
        _batch.RUN_BYTES = old
    sets = [sorted(brute.shingles(t, 5)) for t in texts]
    assert lengths.tolist() == [len(s) for s in sets]
    assert values.tolist() == sum(sets, [])
    numbers = np.array([rng.randrange(2**31) for _ in range(40_000)], dtype=np.int32)
    sizes = np.array([20_000, 0, 1, 19_999])
    got = minhash_rows(numbers, sizes, brute.family(3))
    ends = np.append(0, np.cumsum(sizes))
    for row, lo, hi in zip(got.tolist(), ends, ends[1:]):
        assert row == brute.signature(numbers[lo:hi].tolist(), 3)


def test_hash_family():
    assert len(hash_family(128)) == 128
    assert all(1 <= a < LARGE_PRIME and 0 <= b < LARGE_PRIME for a, b in hash_family(64))
    assert hash_family(64, 0) == hash_family(64, 0) != hash_family(64, 1)
    assert hash_family(512)[:32] == hash_family(32) == brute.family(32)


def test_signature_matches_definition(spark):
    sets = [[1, 2, 3, 4, 5], [], [10, 20, 30, 40], [0, 2**31 - 1], None]
    df = spark.createDataFrame(list(enumerate(sets)), "doc_id bigint, shingles array<int>")
    got = column(df, minhash_signature("shingles", 100, 7))
    for i, items in enumerate(sets):
        assert got[i] == brute.signature(items or [], 100, 7)
    assert set(got[1]) == {LARGE_PRIME}


def test_sketch_equals_two_steps(texts):
    sketch = column(texts, text_sketch("text", 5, 16))
    sets, signatures = column(texts, char_shingles("text", 5)), column(
        texts, minhash_signature(char_shingles("text", 5), 16)
    )
    for i in sketch:
        assert sketch[i].n_shingles == len(sets[i])
        assert sketch[i].signature == signatures[i]


@pytest.mark.parametrize("target", [0.2, 0.5, 0.8])
def test_estimate_close_to_truth(spark, target):
    common = round(target * 2000)
    half = (2000 - common) // 2
    a = list(range(common + half))
    b = list(range(common)) + list(range(common + half, 2000))
    df = spark.createDataFrame([(a, b)], "a array<int>, b array<int>")
    signed = df.select(
        jaccard("a", "b").alias("true"),
        minhash_signature("a", 200).alias("sa"), minhash_signature("b", 200).alias("sb"),
    )
    row = signed.select("true", estimate_jaccard("sa", "sb").alias("estimate")).first()
    assert abs(row.true - target) < 0.01 and abs(row.estimate - row.true) < 0.15


def test_jaccard_cases(spark):
    cases = [([1, 2, 3], [1, 2, 3], 1.0), ([1, 2], [3, 4], 0.0), ([1, 2, 3], [2, 3, 4], 0.5),
             ([], [], 0.0), ([1, 2, 3], [], 0.0)]
    df = spark.createDataFrame([c[:2] for c in cases], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(jaccard("a", "b")).collect()] == [c[2] for c in cases]


def test_estimate_cases(spark):
    cases = [([1, 2, 3, 4], [1, 2, 9, 9], 0.5), ([], [1], 0.0), ([1], [], 0.0),
             ([1, 2], [1, 2, 3, 4], 1.0), ([1, 2, 3, 4], [1, 2], 0.5)]
    df = spark.createDataFrame([c[:2] for c in cases], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in df.select(estimate_jaccard("a", "b")).collect()] == [c[2] for c in cases]


def test_s_curve(spark):
    df = spark.range(11).select((F.col("id") / 10).alias("s"))
    got = [r[0] for r in df.orderBy("s").select(s_curve("s", 16, 8)).collect()]
    assert got == sorted(got) and got[0] == 0.0 and got[-1] == 1.0
    assert got[9] > 0.95 and got[1] < 0.05
    assert spark.range(1).select(error_bound(64)).first()[0] == 0.125


def test_excerpt(spark):
    cases = ["short", "  padded\n", "a\nb" + "c" * 300, "y" * 300, "", "\x1c  z  "]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    got = column(df, excerpt("text", 300))
    for i, text in enumerate(cases):
        want = text[:300].replace("\n", " ").strip() + ("..." if len(text) > 300 else "")
        assert got[i] == want, json.dumps(text)


def test_functions_on_a_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = list(enumerate(["Some Text here", "other"]))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(source)
    stream = spark.readStream.schema("doc_id bigint, text string").parquet(source)
    query = (
        stream.select("doc_id", text_sketch(normalize_text("text"), 5, 8).alias("sketch"))
        .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(sink)
    )
    query.awaitTermination(120)
    got = {r.doc_id: r.sketch.signature for r in spark.read.parquet(sink).collect()}
    want = {i: brute.signature(brute.shingles(brute.normalize(t), 5), 8) for i, t in rows}
    assert got == want


@pytest.mark.parametrize("slice_bytes", [1, 300, 1 << 20])
def test_sets_of_a_batch_are_never_held_together(monkeypatch, slice_bytes):
    import pyarrow as pa

    from nearfold.functions import shingles
    from nearfold.functions.minhash import signature_slice

    monkeypatch.setattr(shingles, "SLICE_BYTES", slice_bytes)
    texts = ["", "x" * 900, *brute.corpus(20, 3), "caf\u00e9"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(-1, len(texts))), "text": ["cut off", *texts]}).slice(1)
    rows = []
    for part in shingles.in_slices(signature_slice(5, 8, 42), "signature")(iter([batch, batch.slice(0, 0)])):
        held = [len(texts[i].encode()) for i in part["doc_id"].to_pylist()]
        assert sum(held) <= slice_bytes or len(held) == 1
        rows += zip(part["doc_id"].to_pylist(), part["signature"].to_pylist())
    assert rows == [(i, list(brute.signature(brute.shingles(t, 5), 8))) for i, t in enumerate(texts)]
