import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nearfold.llm import bpe
from nearfold.llm.queries import op13_batched_bpe, tokenizer
from tests.llm.helpers import LONG, awkward, table

PATH = tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


def mine(texts):
    counts, ids = bpe.encoder(PATH).encode(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def theirs(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=80), min_size=1, max_size=5))
def test_any_text(texts):
    made = Tokenizer.from_file(PATH)
    assert mine(texts) == theirs(made, texts)


def test_every_character(library):
    texts = [f"a{chr(c)}b {chr(c)}1" for c in range(0, 0x30000, 1) if not 0xD800 <= c < 0xE000]
    for begin in range(0, len(texts), 20_000):
        part = texts[begin : begin + 20_000]
        assert mine(part) == theirs(library, part)


def test_special_tokens_long_words_and_forgetting(library, monkeypatch):
    draw = random.Random(3)
    texts = [
        "<|startoftext|> hi <|ENDOFTEXT|><|endoftext|>x", "ΑΣ ΣΑΣ. ΑΣ", "a" * 50_000, "=-" * 9_999, "İ ẞ ﬁ ①½² ٣",
        "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=50_000)), LONG, "", " \t\n ", "don't we'll 'S",
    ]
    want = theirs(library, texts)
    assert mine(texts) == want
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    for text, ids in zip(texts, want, strict=True):
        assert mine([text]) == [ids]


def test_merges_one_place_at_a_time():
    """A merge whose token takes part in a merge of lower rank goes one place at a time, from the left."""
    made = bpe.Vocabulary.__new__(bpe.Vocabulary)
    ids = {"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "abc": 5, "abca": 6}
    made.tokens, made.inner, made.last = list(ids), np.array([0] * 256), np.array([0] * 256)
    # "a bc" makes "abc", which "abc a" takes at a lower rank.
    made._read_merges([["b", "c"], ["abc", "a"], ["a", "bc"], ["ab", "c"]], ids)
    symbols = np.array([0, 1, 2, 0, 1, 2], np.int32)
    merged, word = made.merge(symbols, np.zeros(6, np.int64))
    assert merged.tolist() == [6, 4] and word.tolist() == [0, 0]


def test_whole_table_equals_library(spark, library):
    import hashlib

    docs = table(spark, "/root/testdata/sf0.01", "documents").collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for row in docs:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[row.doc_id] = (len(ids), digest(" ".join(map(str, ids))), digest(text))
    got = op13_batched_bpe(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert len(got) == len(docs)


def test_awkward_rows(spark, library):
    docs = awkward(spark)
    out = docs.withColumn("ids_", bpe.bpe_encode("text", PATH)).withColumn("back", bpe.bpe_decode("ids_", PATH))
    rows = out.collect()
    assert len(rows) == docs.count()
    for row in rows:
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids_ == want and row.back == library.decode(want, skip_special_tokens=False)
    assert out.limit(0).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([1, 999_999, -1],)], "ids array<int>")
    assert [r.t for r in odd.select(bpe.bpe_decode(F.col("ids"), PATH).alias("t")).collect()] == ["", "", '"']


def test_stretches_split_together():
    """Split one by one or together, with the library's tables or without: the same words."""
    stretches = ["", "Ab", "", "é-É", "ΑΣ", "́x", "a\tb\nC'S", "12'll", ""]
    vocabulary = bpe.encoder(PATH).vocabulary
    found = vocabulary.split(stretches)
    words, lists = [], []
    for word in [*found, " "]:
        if word == " ":
            lists.append(words)
            words = []
        else:
            words.append(word)
    assert lists == [vocabulary.split([s]) for s in stretches]
    newer = [*stretches, "\U0010fffe"]  # never assigned
    assert vocabulary.split(newer)[: len(found)] == found
