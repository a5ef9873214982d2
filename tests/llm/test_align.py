import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from nearfold.llm.align import Pair, PerfectHash, align
from nearfold.llm.bpe import byte_letters
from nearfold.llm.queries import op12_hashed_alignment, tokenizer
from tests.llm.helpers import awkward, table

PATHS = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain(libraries, texts):
    """Per text the counts and the groups, token by token."""
    a_model, b_model = libraries
    letters = {c: i for i, c in enumerate(byte_letters())}
    size_a = lambda i: bytes(letters[c] for c in a_model.id_to_token(i))

    def size_b(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = a_model.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_model.encode(text or "")
        if not text or b"".join(map(size_a, a)) != whole or b"".join(map(size_b, b)) != whole:
            a, b = [], []
        links, groups, left, right, i, j, end_a, end_b = [], [], [], [], 0, 0, 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            to_a, to_b = end_a + len(size_a(a[i])), end_b + len(size_b(b[j]))
            if to_a <= to_b:
                left.append(a[i])
                i, end_a = i + 1, to_a
            if to_b <= to_a:
                right.append(b[j])
                j, end_b = j + 1, to_b
            if to_a == to_b:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
         sum(counts[x] for x in links), ";".join(groups))
        for n_a, n_b, groups, links in found
    ]


def test_whole_table_equals_plain(spark, sf_small, libraries):
    docs = table(spark, sf_small, "documents").collect()
    want = {r.doc_id: w for r, w in zip(docs, plain(libraries, [r.text for r in docs]), strict=True)}
    got = op12_hashed_alignment(spark, sf_small).collect()
    assert len(got) == len(docs)
    for r in got:
        *numbers, groups = want[r.doc_id]
        assert [r[c] for c in COLUMNS] == numbers
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_many_blocks_and_a_deep_tree(spark, sf_small, libraries):
    docs = table(spark, sf_small, "documents").repartition(3)
    rows = docs.collect()
    want = sorted((r.doc_id, *w) for r, w in zip(rows, plain(libraries, [r.text for r in rows]), strict=True))
    got = align(docs, *PATHS, parts=3, block_bytes=30_000, fan=2)
    assert sorted(tuple(r) for r in got.select("doc_id", *COLUMNS, "groups").collect()) == want


def test_awkward_rows(spark, libraries):
    docs = awkward(spark)
    more = spark.createDataFrame(
        [(20, "a ▁ b"), (21, "<s> </s> <unk> <|endoftext|>"), (22, "  two  spaces \n\t x "), (23, "\x00 \x85 é́"),
         (24, " " * 20_000 + "x")], "doc_id long, text string",
    )
    docs = docs.unionByName(more, allowMissingColumns=True)
    rows = docs.collect()
    key = lambda r: (r[0] is None, *r)
    want = sorted(((r.doc_id, *w) for r, w in zip(rows, plain(libraries, [r.text for r in rows]), strict=True)), key=key)
    got = align(docs, *PATHS)
    assert sorted((tuple(r) for r in got.select("doc_id", *COLUMNS, "groups").collect()), key=key) == want
    assert any(r[0] == 20 and r[1] == 0 for r in want) and any(r[0] == 21 and r[1] > 0 for r in want)
    assert align(docs.limit(0), *PATHS).count() == 0


def test_long_white_space(libraries):
    pair, text = Pair(*PATHS), "x" + " " * 2_000_000 + "y"
    assert pair.encode_a(text) == libraries[0].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1_000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64))
    made = PerfectHash.of(keys)
    again = PerfectHash.unpacked(**made.packed())
    assert sorted(again.numbers(keys).tolist()) == list(range(len(keys)))
    strangers = keys + np.uint64(1)
    assert ((again.numbers(strangers) >= -1) & (again.numbers(strangers) < max(1, n))).all()


def test_perfect_hash_lists_what_levels_leave(monkeypatch):
    monkeypatch.setattr("nearfold.llm.align.LEVELS", 1)
    keys = np.arange(1_000, dtype=np.uint64)
    made = PerfectHash.of(keys)
    assert len(made.rest) > 0 and sorted(made.numbers(keys).tolist()) == list(range(1_000))
    assert (made.numbers(np.array([5_000], np.uint64)) < 1_000).all()
