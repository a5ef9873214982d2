"""Exact comparison of many sets in one task, in runs of neighbouring rows.

Rows come ordered so that the partners of a row are neighbours of one another.
Their sets are coded by the values that occur, and common values become columns
of bits: one pass over the bits gives most of each overlap, and with the number
of other values a bound on all of it. Only pairs whose bound reaches the
threshold are compared by their other values too. The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of bits at most, and the part of all rows that has a value at least.
BIT_COLUMNS = 1 << 13
COMMON_SHARE = 1 / 64
# Slack for products of the threshold, as in the exact join: looser, never tighter.
SLACK = 1e-9
# Pairs made at once from lists of rows.
PAIRS_AT_ONCE = 1 << 20
# Rows that a row is compared with at once.
ROWS_AT_ONCE = 2048
# Codes of a codebook at most, and sets it is counted over, more or less. A code is two bytes.
BOOK_CODES = 1 << 16
BOOK_SETS = 1 << 12
# Bits of a code or of a value behind the codes, values packed and rows unpacked at once, and the byte for a
# gap that takes two more.
CODE_BITS = 32
VALUES_AT_ONCE = 1 << 20
ROWS_UNPACKED = 512
ESCAPE = 255


def set_codebook(sets: DataFrame, count: int | None = None) -> Broadcast[np.ndarray]:
    """Frequent shingles of ``sets``, broadcast: the place of one is its code in :func:`packed_set`.

    They are counted over some ``BOOK_SETS`` sets drawn by id hash, as whole sets.
    Any codebook gives back the same sets; a fitting one makes them short. Codes
    ascend from frequent to rare by powers of two, and at equal power by the
    marked sets that hold a shingle: those that occur together lie close.
    """
    count = sets.count() if count is None else count
    drawn = sets.where(F.pmod(F.xxhash64(F.lit("book"), "doc_id"), F.lit(max(1, count // BOOK_SETS))) == 0)
    place = F.xxhash64(F.lit("mark"), "doc_id")
    # One set in 64 is marked, each by a bit.
    mark = F.when(F.pmod(place, F.lit(64)) == 0, F.expr("shiftleft(1L, cast(pmod(xxhash64('bit', doc_id), 64) as int))"))
    # An outer explode: for the other, Spark would cut all sets once more to filter empty ones.
    rows = drawn.select(mark.alias("mark"), F.explode_outer("shingles").alias("shingle"))
    held = rows.where("shingle is not null").groupBy("shingle").agg(
        F.count(F.lit(1)).alias("sets"), F.coalesce(F.bit_or("mark"), F.lit(0)).alias("marks")
    )
    top = held.orderBy(F.desc("sets"), "shingle").limit(BOOK_CODES)
    ordered = top.toArrow()
    power = np.floor(np.log2(np.maximum(ordered["sets"].to_numpy(), 1)))
    marks = ~ordered["marks"].to_numpy().view(np.uint64)
    order = np.lexsort((ordered["shingle"].to_numpy(), marks, -power))
    book = ordered["shingle"].to_numpy()[order].astype(np.int32)
    return sets.sparkSession.sparkContext.broadcast(book)


def packed_set(shingles: Column | str, book: Broadcast[np.ndarray] | None = None) -> Column:
    """``binary`` of an ``array<int>`` of distinct shingles, the same for equal sets.

    Shingles of the codebook become codes, the others follow by value. Gaps of
    either are small numbers, most of them a byte, and compressed. Without a
    codebook the values come back, with one other numbers that are equal where
    the values are.
    """

    @F.arrow_udf("binary")
    def pack(sets: pa.Array) -> pa.Array:
        coded = Coder(np.zeros(0, np.int32) if book is None else book.value)
        lengths = pc.fill_null(pc.list_value_length(sets), 0).to_numpy(zero_copy_only=False)
        values = sets.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        ends = np.append(0, np.cumsum(lengths))
        packed, lo = [], 0
        while lo < len(lengths):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + VALUES_AT_ONCE, side="right")) - 1)
            packed += coded.pack(values[ends[lo] : ends[hi]], lengths[lo:hi])
            lo = hi
        return pa.array(packed, pa.binary())

    return pack(F.col(shingles) if isinstance(shingles, str) else shingles)


class Coder:
    """Packs sets by the codes of one codebook."""

    def __init__(self, book: np.ndarray):
        self.codes = np.argsort(book, kind="stable")
        self.values = book[self.codes]
        self.zip = pa.Codec("zstd", compression_level=1)

    def pack(self, values: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        size, row = len(self.values), np.repeat(np.arange(lengths.size), lengths)
        codes = values.astype(np.int64) + size
        if size:
            at = np.minimum(np.searchsorted(self.values, values), size - 1)
            codes = np.where(self.values[at] == values, self.codes[at], codes)
        # Rows stay where they are; codes ascend in each.
        codes = np.sort((row << CODE_BITS) | codes) & ((1 << CODE_BITS) - 1)
        head = np.diff(row, prepend=-1) > 0
        listed = codes < size
        # The other values start anew behind the codes of a row.
        turn = ~listed & (head | np.append(False, listed[:-1]))
        gaps = np.diff(codes, prepend=0)
        gaps[head & listed] = codes[head & listed] + 1
        gaps[turn] = codes[turn] - size
        short = gaps[listed] - 1
        long = short >= ESCAPE
        ends = [
            np.append(0, np.cumsum(np.bincount(row[which], minlength=lengths.size)))
            for which in (listed, np.flatnonzero(listed)[long], ~listed)
        ]
        parts = [
            np.minimum(short, ESCAPE).astype(np.uint8), short[long].astype("<u2"),
            gaps[~listed].astype("<i4").view(np.uint8).reshape(-1, 4),
        ]
        heads = np.stack([*(np.diff(e) for e in ends), np.full(lengths.size, size)], axis=1).astype(">u4")
        packed = []
        for i in range(lengths.size):
            codes, escaped, rest = (part[e[i] : e[i + 1]] for part, e in zip(parts, ends))
            held = codes.tobytes() + escaped.tobytes() + rest.T.tobytes()
            packed.append(heads[i].tobytes() + self.zip.compress(held, asbytes=True))
        return packed


def packed_size(packed: Column | str) -> Column:
    """Shingles of a :func:`packed_set`: the coded and the others, as its head says."""
    coded, others = (F.conv(F.hex(F.substring(packed, at, 4)), 16, 10).cast("int") for at in (1, 9))
    return coded + others


def unpacked_sets(packed: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat numbers, ascending in each row, and row lengths of :func:`packed_set` binaries of one codebook."""
    runs = [_unpacked_rows(packed.slice(lo, ROWS_UNPACKED).to_pylist()) for lo in range(0, len(packed), ROWS_UNPACKED)]
    if not runs:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate([values for values, _ in runs]), np.concatenate([lengths for _, lengths in runs])


def _unpacked_rows(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    unzip = pa.Codec("zstd")
    heads = np.zeros((len(packed), 4), dtype=np.int64)
    parts: tuple[list, list, list] = ([], [], [])
    for i, row in enumerate(packed):
        if not row:
            continue
        heads[i] = np.frombuffer(row, ">u4", 4)
        codes, escaped, rest, _ = heads[i].tolist()
        if codes + rest:
            held = unzip.decompress(row[16:], codes + 2 * escaped + 4 * rest, asbytes=True)
            parts[0].append(np.frombuffer(held, np.uint8, codes))
            parts[1].append(np.frombuffer(held, "<u2", escaped, codes))
            planes = np.frombuffer(held, np.uint8, 4 * rest, codes + 2 * escaped).reshape(4, -1)
            parts[2].append(np.ascontiguousarray(planes.T).view("<i4").ravel())
    short, escaped, rest = (
        np.concatenate(part) if part else np.zeros(0, np.int64) for part in parts
    )
    listed, _, others, size = heads.T
    gaps = short.astype(np.int64) + 1
    gaps[short == ESCAPE] = escaped.astype(np.int64) + 1
    lengths = listed + others
    begin = np.cumsum(lengths) - lengths
    out = np.empty(int(lengths.sum()), dtype=np.uint32)
    out[ranges(begin, listed)] = _summed(gaps, listed) - 1
    out[ranges(begin + listed, others)] = _summed(rest.astype(np.int64), others) + np.repeat(size, others)
    return out, lengths


def _summed(gaps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Running sums of ``gaps`` that start anew in each row."""
    total = np.append(0, np.cumsum(gaps))
    return total[1:] - np.repeat(total[np.cumsum(lengths) - lengths], lengths)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``starts[i] + arange(lengths[i])``."""
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(shift.size)


class CodedSets:
    """Sets of rows coded by the values that occur, common values as bits."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        rows = lengths.size
        row = np.repeat(np.arange(rows), lengths)
        distinct, codes, counts = np.unique(values, return_inverse=True, return_counts=True)
        least = max(4, int(rows * COMMON_SHARE))
        common = np.flatnonzero(counts >= least)
        if common.size > BIT_COLUMNS:
            common = np.sort(common[np.argsort(-counts[common], kind="stable")[:BIT_COLUMNS]])
        place = np.full(distinct.size, -1, dtype=np.int64)
        place[common] = np.arange(common.size)
        at = place[codes]
        is_common = at >= 0
        flags = np.zeros((rows, max(1, -(-common.size // 64)) * 64), dtype=bool)
        flags[row[is_common], at[is_common]] = True
        self.bits = np.packbits(flags, axis=1).view(np.uint64)
        # Values of one row only are in no overlap.
        other = ~is_common & (counts[codes] > 1)
        self.rest, self.rests = codes[other], np.bincount(row[other], minlength=rows)
        self.begin = np.cumsum(self.rests) - self.rests
        # The rows that have each of the other values.
        self.holders = row[other][np.argsort(self.rest, kind="stable")]
        self.held = np.bincount(self.rest, minlength=distinct.size)
        self.first = np.cumsum(self.held) - self.held
        self.marked = np.zeros(distinct.size, dtype=bool)
        self.lengths = lengths

    def common(self, i: int, j: slice | np.ndarray) -> np.ndarray:
        """Common values that row ``i`` shares with each row of ``j``."""
        return np.bitwise_count(self.bits[j] & self.bits[i]).sum(axis=1, dtype=np.int64)

    def others(self, i: int, j: np.ndarray) -> np.ndarray:
        """Other values that row ``i`` shares with each row of ``j``."""
        if not self.rests[i]:
            return np.zeros(len(j), dtype=np.int64)
        mine = self.rest[self.begin[i] : self.begin[i] + self.rests[i]]
        held = self.held[mine]
        if held.sum() <= self.rests[j].sum():
            return np.bincount(self.holders[ranges(self.first[mine], held)], minlength=self.rests.size)[j]
        self.marked[mine] = True
        met = np.append(0, np.cumsum(self.marked[self.rest[ranges(self.begin[j], self.rests[j])]], dtype=np.int64))
        self.marked[mine] = False
        ends = np.cumsum(self.rests[j])
        return met[ends] - met[ends - self.rests[j]]

    def score(self, i: int, j: np.ndarray, overlap: np.ndarray) -> np.ndarray:
        return overlap / np.maximum(self.lengths[j] + self.lengths[i] - overlap, 1)


def similar_rows(
    values: np.ndarray, lengths: np.ndarray, first: np.ndarray, last: np.ndarray, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(i, j, jaccard)`` of rows i and j of ``first[i] <= j < last[i]`` that reach ``threshold > 0``."""
    sets = CodedSets(values, lengths)
    share = threshold / (1 + threshold)
    for i in np.flatnonzero(last > first):
        lo, hi = first[i], last[i]
        overlap = sets.common(i, slice(lo, hi))
        needed = (lengths[lo:hi] + lengths[i]) * share - SLACK
        j = lo + np.flatnonzero(overlap + np.minimum(sets.rests[lo:hi], sets.rests[i]) >= needed)
        if not j.size:
            continue
        score = sets.score(i, j, overlap[j - lo] + sets.others(i, j))
        kept = score >= threshold
        if kept.any():
            yield np.full(int(kept.sum()), i), j[kept], score[kept]


def row_scores(sets: CodedSets, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the rows ``i`` and ``j``, pair by pair; ``i`` ascends."""
    scores = np.zeros(len(i))
    heads = np.flatnonzero(np.diff(i, prepend=-1))
    for lo, hi in zip(heads, np.append(heads[1:], len(i))):
        for at in range(lo, hi, ROWS_AT_ONCE):
            run = slice(at, min(at + ROWS_AT_ONCE, hi))
            scores[run] = sets.score(i[lo], j[run], sets.common(i[lo], j[run]) + sets.others(i[lo], j[run]))
    return scores
