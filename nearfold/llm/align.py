"""Alignment of two tokenizers over a corpus, with counts under minimal perfect hashes.

Both tokenizers encode a text; the ends of their tokens are byte offsets into the
same bytes. Offsets where tokens of both end cut the text into groups. Every
stretch between neighbouring ends, of either, lies in one token of A and one of B:
these are the links, all pairs of tokens whose byte ranges overlap, each once.

Texts are encoded once and kept as ids. How often a pair of ids is linked is counted
over the whole corpus. The first pass aligns blocks of documents of some
``BLOCK_BYTES`` of text and hands on each block's distinct pairs with their counts, split into ``PARTS`` parts by the hash of B's id.
Per part, the distinct pairs are gathered over a tree of groups of at most ``FAN``
tables and get a minimal perfect hash: levels of bits, a pair belongs to the first
level where no other pair has its bit, and the bits set before that one are its
number. Each block's counts then become dense vectors under those numbers, added up
over the same tree. The pair itself is kept at its number, so that a pair that was
never counted is told apart. As all pairs of an id of B are in one part, the part
also knows the highest count of each. Blocks look their pairs up in the parts'
tables; the second pass aligns the documents again and reads the answers.

Bounds: a table never holds more than the distinct pairs of a part (all parts: at
most ids of A times ids of B, whatever the corpus), a task of the trees at most
``FAN`` tables, a task of a pass one block. No table passes the driver and none is
broadcast. The files of both tokenizers must be readable by every worker.

Defined cases: texts that are null, empty or whose joined bytes differ from the
text with a space ahead (white space that a tokenizer normalises, U+2581) have no
tokens: zero counts and an empty list of groups; repeated rows and null ids are
counted and returned row by row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nearfold.llm.bpe import byte_letters
from nearfold.llm.common import whole
from nearfold.llm.lm import large_counts, pack_array, small_counts, unpack_array
from nearfold.sources.scratch import release, stage

#: Bytes of text in a block (a longer text has a block alone).
BLOCK_BYTES = 1 << 20
PARTS = 64
FAN = 256
#: Bits per key in a level of a hash, and levels before the rest is listed.
GAMMA = 2
LEVELS = 24
#: Texts aligned at once, by tokens of A.
SLICE_TOKENS = 1 << 17
#: Runs of white space from this length on need the slower of two encoders.
LONG_SPACE = 10_000
#: Fixed value: how the byte-level vocabulary splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x + np.uint64(salt * 0xBF58476D1CE4E5B9 % 2**64)) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct keys.

    In a level every key has a bit; a bit that only one key has settles that
    key. All others go on to the next, smaller level; what is left after the
    last one is a sorted list.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.befores, taken = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.befores.append(taken + np.cumsum(ones) - ones)
            taken += int(ones.sum())
        self.settled = taken

    @staticmethod
    def _place(keys: np.ndarray, level: int, words: int) -> tuple[np.ndarray, np.ndarray]:
        at = mixed(keys, level + 1) % np.uint64(words * 64)
        return (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys) and len(levels) < LEVELS:
            words = max(1, -(-GAMMA * len(keys) // 64))
            word, bit = cls._place(keys, len(levels), words)
            place = word * 64 + bit.astype(np.int64)
            single = np.bincount(place, minlength=words * 64) == 1
            levels.append(np.packbits(single, bitorder="little").view(np.uint64))
            keys = keys[~single[place]]
        return cls(levels, np.sort(keys))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; of a key it was not made for, any number or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            word, bit = self._place(keys[left], level, len(bits))
            found = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[found]] = (self.befores[level][word] + np.bitwise_count(below))[found]
            left = left[~found]
        if len(self.rest) and len(left):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            out[left] = np.where(self.rest[at] == keys[left], self.settled + at, -1)
        return out

    def packed(self) -> dict[str, object]:
        return {"levels": [b.tobytes() for b in self.levels], "rest": self.rest.tobytes()}

    @classmethod
    def unpacked(cls, levels: list[bytes], rest: bytes) -> PerfectHash:
        return cls([np.frombuffer(b, np.uint64) for b in levels], np.frombuffer(rest, np.uint64))


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.path_a = path_a
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte = {letter: bytes([i]) for i, letter in enumerate(byte_letters())}
        ids = {token: i for token, i in model["vocab"].items() if all(c in byte for c in token)}
        raw = {b"".join(byte[c] for c in token): i for token, i in ids.items()}
        made = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(made):
            raise ValueError("the ids of merged tokens are not in the order of the merges")
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=raw, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_a = [b""] * (1 + max(ids.values()))
        for token, i in raw.items():
            bytes_a[i] = token
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        ]
        self.bytes_a = bytes_a
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (bytes_a, self.bytes_b))
        self.told = [
            np.array([f"{i}{mark}" for i in range(n)], object)
            for n, mark in ((len(bytes_a), ","), (len(bytes_a), "|"), (len(self.bytes_b), ","), (len(self.bytes_b), ";"))
        ]
        self.dtype = np.uint16 if max(len(bytes_a), len(self.bytes_b)) <= 1 << 16 else np.uint32

    def encode_a(self, text: str) -> list[int]:
        if len(text) > LONG_SPACE and re.search(rf"\s{{{LONG_SPACE}}}", text):
            # The matcher behind the fast encoder overflows its stack; the other library does not.
            return self.slow_a.encode(text, add_special_tokens=False).ids
        return self.a.encode_ordinary(text)

    @cached_property
    def slow_a(self) -> Tokenizer:
        made = Tokenizer.from_file(self.path_a)
        made.no_truncation()
        made.no_padding()
        made.encode_special_tokens = True
        return made

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both; none where the joined bytes are not those of the text with a space ahead."""
        spaced = " " + text
        exact = spaced.encode("utf-8")
        a, b = self.encode_a(spaced), self.b.encode(text)
        right = b"".join(map(self.bytes_a.__getitem__, a)) == exact == b"".join(map(self.bytes_b.__getitem__, b))
        return (a, b) if right and text else ([], [])


@cache
def tokenizers_of(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Alignment:
    """Groups and links of some texts, given as ids, over their bytes in a row."""

    def __init__(self, pair: Pair, a: list[np.ndarray], b: list[np.ndarray]):
        self.n_a, self.n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        self.a, self.b = (np.concatenate([np.empty(0, pair.dtype), *x]) for x in (a, b))
        ends_a, ends_b = np.cumsum(pair.size_a[self.a]), np.cumsum(pair.size_b[self.b])
        doc_of_a = np.repeat(np.arange(len(a)), self.n_a)
        ends = np.concatenate((ends_a, ends_b))
        ends.sort(kind="stable")  # two sorted runs
        twice = ends[1:] == ends[:-1]
        common = ends[1:][twice]
        ends = ends[np.concatenate((~twice, np.ones(min(1, len(ends)), bool)))]
        link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.link_doc = doc_of_a[link_a]
        self.keys = (self.b[link_b].astype(np.uint64) << np.uint64(32)) | self.a[link_a].astype(np.uint64)
        self.last_a, self.last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        self.n_groups = np.bincount(doc_of_a[self.last_a], minlength=len(a))

    def groups(self, pair: Pair) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        a, b = pair.told[0][self.a], pair.told[2][self.b]
        a[self.last_a] = pair.told[1][self.a[self.last_a]]
        b[self.last_b] = pair.told[3][self.b[self.last_b]]
        group = 2 * np.arange(len(self.last_a))
        of = [np.repeat(group + i, np.diff(x, prepend=-1)) for i, x in enumerate((self.last_a, self.last_b))]
        told = np.concatenate((a, b))[np.argsort(np.concatenate(of), kind="stable")].tolist()
        bounds = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        return ["".join(told[x:y])[:-1] for x, y in zip(bounds, bounds[1:], strict=False)]


def ids_of(column: pa.Array | pa.ChunkedArray, dtype: type) -> list[np.ndarray]:
    return [unpack_array(v.as_py(), dtype) for v in column]


def runs(a: list[np.ndarray], b: list[np.ndarray]) -> Iterator[tuple[list, list]]:
    """The texts in runs of about ``SLICE_TOKENS`` tokens."""
    begin, held = 0, 0
    for i, ids in enumerate(a):
        held += len(ids)
        if held >= SLICE_TOKENS or i + 1 == len(a):
            yield a[begin : i + 1], b[begin : i + 1]
            begin, held = i + 1, 0


def encoded(
    docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, block_bytes: int
) -> DataFrame:
    """``(block, id, a, b)`` with the ids packed, staged; a block's number is that of its first row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, block, held = tokenizers_of(path_a, path_b), None, 0
        for batch in batches:
            numbers, out, a, b = batch.column(0).to_pylist(), [], [], []
            for number, value in zip(numbers, batch.column(2), strict=True):
                text = value.as_py()
                if block is None or held + len(text) > block_bytes:
                    block, held = number, 0
                held += len(text)
                out.append(block)
                for ids, to in zip(pair.tokens(text), (a, b), strict=True):
                    to.append(pack_array(np.array(ids, pair.dtype)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int64()), batch.column(1), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                ["block", "id", "a", "b"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), whole(text_col).alias("text")
    )
    simple = docs.schema[id_col].dataType.simpleString()
    return stage(rows.mapInArrow(encode, f"block long, id {simple}, a binary, b binary"), "align-encoded")


def tree(
    rows: DataFrame, n_blocks: int, merge: Callable[[pa.Table], pa.Table], schema: str, fan: int = FAN
) -> DataFrame:
    """One row a part, made by ``merge`` from groups of at most about ``fan`` rows of it, level by level."""
    while True:
        n_blocks = -(-n_blocks // fan)
        slot = F.pmod(F.xxhash64("block"), F.lit(max(1, n_blocks)))
        rows = rows.withColumn("block", slot).groupBy("part", "block").applyInArrow(merge, schema)
        if n_blocks <= 1:
            return rows


def _keys(table: pa.Table) -> list[np.ndarray]:
    return [unpack_array(k.as_py(), np.uint64) for k in table.column("keys")]


def _blocks(
    batches: Iterator[pa.RecordBatch], dtype: type
) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
    """Blocks of rows that stand together, with the ids of each."""
    held, a, b = None, [], []
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), *(ids_of(batch.column(i), dtype) for i in (1, 2)), strict=True)
        for block, ids_a, ids_b in rows:
            if block != held and a:
                yield held, a, b
                a, b = [], []
            held = block
            a.append(ids_a)
            b.append(ids_b)
    if a:
        yield held, a, b


def _distinct(table: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate(_keys(table)))
    return pa.table({
        "part": table.column("part")[:1], "block": table.column("block")[:1], "keys": [pack_array(keys)],
    })


def _hashed(table: pa.Table) -> pa.Table:
    """The hash of a part's distinct pairs, and each pair at its number."""
    keys = _keys(table)[0]
    made = PerfectHash.of(keys)
    placed = np.empty_like(keys)
    placed[made.numbers(keys)] = keys
    packed = made.packed()
    return pa.table({
        "part": table.column("part"), "levels": pa.array([packed["levels"]], pa.list_(pa.binary())),
        "rest": [packed["rest"]], "placed": [pack_array(placed)],
    })


HASH = "part int, levels array<binary>, rest binary, placed binary"


def _hash(table: pa.Table) -> tuple[PerfectHash, np.ndarray]:
    made = PerfectHash.unpacked(table.column("levels")[0].as_py(), table.column("rest")[0].as_py())
    return made, unpack_array(table.column("placed")[0].as_py(), np.uint64)


def _vectors(mine: pa.Table, hashes: pa.Table) -> pa.Table:
    """The counts of some blocks as one dense vector under the part's hash."""
    made, placed = _hash(hashes)
    total = np.zeros(len(placed), np.int64)
    for keys, counts in zip(_keys(mine), mine.column("counts"), strict=True):
        total[made.numbers(keys)] += large_counts(counts.as_py(), len(keys))
    return pa.table({
        "part": mine.column("part")[:1], "block": mine.column("block")[:1], "vector": [pack_array(total)],
    })


def _added(table: pa.Table) -> pa.Table:
    total = sum(unpack_array(v.as_py(), np.int64) for v in table.column("vector"))
    return pa.table({
        "part": table.column("part")[:1], "block": table.column("block")[:1], "vector": [pack_array(total)],
    })


def pair_counts(asked: DataFrame, n_blocks: int, fan: int = FAN) -> DataFrame:
    """The table of each part: its hash, the pairs at their numbers and their counts, staged."""
    keys = tree(asked.select("part", "block", "keys"), n_blocks, _distinct, "part int, block long, keys binary", fan)
    hashes = stage(keys.select("part", "keys").mapInArrow(_each(_hashed), HASH), "align-hashes")
    slots = -(-n_blocks // fan)
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(max(1, slots))))
    vectors = (
        dealt.groupBy("part", "block")
        .cogroup(_every_slot(hashes, slots).groupBy("part", "block"))
        .applyInArrow(lambda m, h: _vectors(m, h) if m.num_rows else _no_vector(), "part int, block long, vector binary")
    )
    if slots > 1:
        vectors = tree(vectors, slots, _added, "part int, block long, vector binary", fan)
    tables = stage(hashes.join(vectors.select("part", "vector").hint("merge"), "part"), "align-tables")
    release(hashes)
    return tables


def _every_slot(hashes: DataFrame, slots: int) -> DataFrame:
    return hashes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, slots - 1)).cast("long"))))


def _no_vector() -> pa.Table:
    return pa.schema([("part", pa.int32()), ("block", pa.int64()), ("vector", pa.binary())]).empty_table()


def _each(make: Callable[[pa.Table], pa.Table]) -> Callable:
    """``make`` on one row after another."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from make(pa.Table.from_batches([batch.slice(i, 1)])).combine_chunks().to_batches()

    return over


def _answers(mine: pa.Table, held: pa.Table) -> pa.Table:
    """Counts of the pairs of some blocks, and whether each is its B id's highest."""
    schema = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])
    if not mine.num_rows or not held.num_rows:
        return schema.empty_table()
    made, placed = _hash(held)
    counts = unpack_array(held.column("vector")[0].as_py(), np.int64)
    b = (placed >> np.uint64(32)).astype(np.int64)
    highest = np.zeros(int(b.max()) + 1, np.int64)
    np.maximum.at(highest, b, counts)
    best = counts == highest[b]
    out = []
    for block, keys in zip(mine.column("block").to_pylist(), _keys(mine), strict=True):
        number = made.numbers(keys)
        known = (number >= 0) & (placed[number] == keys)
        if not known.all():
            raise ValueError("a pair of the second pass was not counted in the first")
        out.append({
            "block": block, "keys": pack_array(keys), "counts": pack_array(counts[number]),
            "best": np.packbits(best[number]).tobytes(),
        })
    return pa.Table.from_pylist(out, schema)


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int = PARTS,
    block_bytes: int = BLOCK_BYTES,
    fan: int = FAN,
) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` of every row."""
    tokens = encoded(docs, path_a, path_b, id_col, text_col, block_bytes)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct pairs of each block; a block cut by a split of the file asks twice."""
        pair = tokenizers_of(path_a, path_b)
        for block, a, b in _blocks(batches, pair.dtype):
            found = [np.unique(Alignment(pair, *run).keys, return_counts=True) for run in runs(a, b)]
            distinct, inverse = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            total = np.bincount(inverse, np.concatenate([n for _, n in found]), len(distinct)).astype(np.int64)
            part = (mixed(distinct >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            used, begins = np.unique(part[order], return_index=True)
            ranges = np.split(order, begins[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()),
                    pa.array([pack_array(distinct[r]) for r in ranges[: len(used)]], pa.binary()),
                    pa.array([small_counts(total[r]) for r in ranges[: len(used)]], pa.binary()),
                ],
                ["part", "block", "keys", "counts"],
            )

    asked = tokens.select("block", "a", "b").mapInArrow(ask, "part int, block long, keys binary, counts binary")
    asked = stage(asked, "align-asked")
    n_blocks = asked.select("block").distinct().count()
    tables = pair_counts(asked, n_blocks, fan)
    # Blocks come in groups of at most about ``fan``; each group of each part meets the part's table.
    slots = max(1, -(-n_blocks // fan))
    dealt = asked.select("part", F.pmod(F.xxhash64("block"), F.lit(slots)).alias("slot"), "block", "keys")
    held = _every_slot(tables, slots).withColumnRenamed("block", "slot")
    answers = (
        dealt.groupBy("part", "slot").cogroup(held.groupBy("part", "slot"))
        .applyInArrow(_answers, "block long, keys binary, counts binary, best binary")
    )
    answers = stage(answers, "align-answers")
    release(asked, tables)

    id_type = docs.schema[id_col].dataType
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

    def answer(texts: pa.Table, known: pa.Table) -> pa.Table:
        pair = tokenizers_of(path_a, path_b)
        keys = np.concatenate([np.empty(0, np.uint64), *_keys(known)])
        counts = np.concatenate(
            [np.empty(0, np.int64), *(unpack_array(c.as_py(), np.int64) for c in known.column("counts"))]
        )
        sizes = [len(k) for k in _keys(known)]
        best = np.concatenate([np.empty(0, bool), *(
            np.unpackbits(np.frombuffer(b.as_py(), np.uint8), count=n).astype(bool)
            for b, n in zip(known.column("best"), sizes, strict=True)
        )])
        order = np.argsort(keys)
        keys, counts, best = keys[order], counts[order], best[order]
        told: dict[str, list] = {name: [] for name in columns}
        groups: list[str] = []
        for run in runs(ids_of(texts.column("a"), pair.dtype), ids_of(texts.column("b"), pair.dtype)):
            found = Alignment(pair, *run)
            at = np.searchsorted(keys, found.keys)
            n = len(found.n_a)
            total = np.zeros(n, np.int64)
            np.add.at(total, found.link_doc, counts[at])
            values = (
                found.n_a, found.n_b, found.n_groups, np.bincount(found.link_doc, minlength=n),
                np.bincount(found.link_doc[best[at]], minlength=n), total,
            )
            for name, value in zip(columns, values, strict=True):
                told[name].append(value)
            groups += found.groups(pair)
        return pa.table({
            "id": texts.column("id"),
            **{name: pa.array(np.concatenate(v).astype(np.int64)) for name, v in told.items()},
            "groups": pa.array(groups, pa.string()),
        })

    counted = ", ".join(f"{name} long" for name in columns)
    result = tokens.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        answer, f"id {id_type.simpleString()}, {counted}, groups string"
    )
    return result.withColumnRenamed("id", id_col)


def groups_digest(groups: str = "groups") -> Column:
    """SHA-256 of the listed groups; the empty text where there are none."""
    return F.when(F.col(groups) == "", F.lit("")).otherwise(F.sha2(groups, 256))
