"""Array arithmetic for one Arrow batch: hashed k-shingles and MinHash minima.

These helpers see the rows of one batch inside a task and nothing else. They
work on the flat buffers of the batch, in slices of a bounded number of
elements, so memory follows the batch size and not the number of hashes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np

# The modulus of the hash family and the mask of a shingle hash.
MERSENNE_61 = (1 << 61) - 1
SHINGLE_MASK = 0x7FFFFFFF

# Fixed values of MD5 (RFC 1321): rotation per step and the start state. The
# sine table follows from its definition.
MD5_ROTATIONS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
MD5_SINES = tuple(int(abs(math.sin(i + 1)) * 2**32) for i in range(64))

# One MD5 block holds at most this many message bytes beside its padding.
ONE_BLOCK = 55
# Elements handled at once, a power of two.
SLICE = 1 << 15
RUN_BYTES = 1 << 18
# Above twice the largest error of a scaled hash: about SLICE * 2**31 from the
# coefficient and less than 2 * SLICE from the constant and the position.
BLUR = SLICE << 33


def _md5_first_word(words: dict[int, np.ndarray], size: int) -> np.ndarray:
    """First digest word of one-block messages; absent words are zero."""
    a, b, c, d = (np.full(size, v, dtype=np.uint32) for v in MD5_START)
    mix = np.empty_like(a)
    for step in range(64):
        turn = step // 16
        if turn == 0:
            word = step
            np.bitwise_xor(c, d, out=mix)
            mix &= b
            mix ^= d
        elif turn == 1:
            word = (5 * step + 1) % 16
            np.bitwise_xor(b, c, out=mix)
            mix &= d
            mix ^= c
        elif turn == 2:
            word = (3 * step + 5) % 16
            np.bitwise_xor(b, c, out=mix)
            mix ^= d
        else:
            word = (7 * step) % 16
            np.invert(d, out=mix)
            mix |= b
            mix ^= c
        mix += a
        mix += np.uint32(MD5_SINES[step])
        if word in words:
            mix += words[word]
        left = MD5_ROTATIONS[turn][step % 4]
        np.left_shift(mix, np.uint32(left), out=a)
        mix >>= np.uint32(32 - left)
        a |= mix
        a += b
        a, b, c, d = d, a, b, c
    return a + np.uint32(MD5_START[0])


def _short_message_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Shingle hashes of messages that fit one MD5 block each."""
    shortest, longest = int(length.min()), int(length.max())
    words: dict[int, np.ndarray] = {14: (length * 8).astype(np.uint32)}
    for pos in range(longest + 1):
        if pos == longest == shortest:
            byte = np.full(start.size, 0x80, dtype=np.uint32)
        else:
            byte = data.take(start + pos, mode="clip").astype(np.uint32)
        if pos >= shortest != longest:
            byte[length == pos] = 0x80
            byte[length < pos] = 0
        byte <<= np.uint32(8 * (pos % 4))
        word = pos // 4
        if word in words:
            words[word] |= byte
        else:
            words[word] = byte
    return _md5_first_word(words, start.size) & np.uint32(SHINGLE_MASK)


def message_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """31-bit shingle hash of every message ``data[start : start + length]``."""
    out = np.empty(start.size, dtype=np.int64)
    if data.size == 0:
        data = np.zeros(1, dtype=np.uint8)
    for lo in range(0, start.size, SLICE):
        part = slice(lo, lo + SLICE)
        begin, size = start[part], length[part]
        short = size <= ONE_BLOCK
        if short.any():
            out[lo + np.flatnonzero(short)] = _short_message_hashes(data, begin[short], size[short])
        # Only the messages that need a second block are hashed one by one.
        for i in np.flatnonzero(~short).tolist():
            message = data[begin[i] : begin[i] + size[i]].tobytes()
            out[lo + i] = int.from_bytes(hashlib.md5(message).digest()[:4], "little") & SHINGLE_MASK
    return out


def shingle_spans(data: np.ndarray, offsets: np.ndarray, k: int):
    """Row, first byte and byte length of every k-character window.

    ``data`` is UTF-8 and windows count code points. A row with fewer than k
    characters has one window, the whole row.
    """
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    bounds = np.append(heads, data.size)
    first = np.searchsorted(heads, offsets)
    chars = np.diff(first)
    row = np.repeat(np.arange(chars.size), chars)
    index = np.arange(row.size)
    whole = index + k <= first[1:][row]
    index, row = index[whole], row[whole]
    start = bounds[index]
    length = bounds[index + k] - start
    short = np.flatnonzero(chars < k)
    return (
        np.concatenate([row, short]),
        np.concatenate([start, offsets[:-1][short]]),
        np.concatenate([length, np.diff(offsets)[short]]),
    )


def shingle_rows(data: np.ndarray, offsets: np.ndarray, k: int):
    """Sorted distinct shingle hashes per row as row lengths and flat values.

    Rows are taken in runs of about ``RUN_BYTES`` bytes of text; a longer row
    forms a run of its own.
    """
    lengths, values = [], []
    lo, rows = 0, offsets.size - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + RUN_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        run = offsets[lo : hi + 1]
        row, start, length = shingle_spans(data[run[0] : run[-1]], run - run[0], k)
        keys = np.sort((row << 31) | message_hashes(data[run[0] : run[-1]], start, length))
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
        lengths.append(np.bincount(keys >> 31, minlength=hi - lo))
        values.append((keys & SHINGLE_MASK).astype(np.int32))
        lo = hi
    if not lengths:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
    return np.concatenate(lengths), np.concatenate(values)


def exact_hash(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``(a*x + b) mod (2**61 - 1)`` for ``x < 2**31``, all as uint64.

    With ``a = hi * 2**32 + lo`` every term below stays under 2**64, and
    ``2**61 = 1`` modulo the prime folds ``hi * x * 2**32`` back.
    """
    prime = np.uint64(MERSENNE_61)
    high = x * (a >> np.uint64(32))
    low = x * (a & np.uint64(0xFFFFFFFF)) + b
    low += high >> np.uint64(29)
    low += (high & np.uint64((1 << 29) - 1)) << np.uint64(32)
    low = (low & prime) + (low >> np.uint64(61))
    return np.minimum(low, low - prime)  # the difference wraps unless low >= prime


def minhash_rows(values: np.ndarray, lengths: np.ndarray, family: list[tuple[int, int]]) -> np.ndarray:
    """Signature matrix: row minima of ``(a*x + b) mod (2**61 - 1)``."""
    return least_hashes(values, lengths, family)[0]


def least_hashes(
    values: np.ndarray, lengths: np.ndarray, family: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`minhash_rows`, and the places in their rows of the values with these minima.

    Only the least value of a row is needed exactly. As a fraction of 2**64 a
    hash is ``x*A + B`` in wrapping 64-bit arithmetic up to ``BLUR``, with A and
    B the coefficients scaled by 2**64 over the prime and their low bits free to
    hold the position of x: one minimum yields the place to evaluate exactly.
    Where the two least are too close to tell, the whole row is evaluated.
    """
    a = np.array([pair[0] for pair in family], dtype=np.uint64)
    b = np.array([pair[1] for pair in family], dtype=np.uint64)
    scaled_a = [np.uint64((c << 64) // MERSENNE_61 // SLICE * SLICE) for c, _ in family]
    scaled_b = [
        np.uint64(((c << 64) // MERSENNE_61 // SLICE * SLICE + BLUR // 2) % 2**64)
        for _, c in family
    ]
    out = np.full((lengths.size, len(family)), MERSENNE_61, dtype=np.uint64)
    places = np.zeros(out.shape, dtype=np.int32)
    begin = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(lengths.size), lengths)
    place = np.arange(SLICE, dtype=np.uint64)
    last = np.uint64(2**64 - 1)
    for at in range(0, values.size, SLICE):
        x = values[at : at + SLICE].astype(np.uint64)
        rows = row[at : at + SLICE]
        cuts = np.append(0, np.flatnonzero(np.diff(rows)) + 1)
        ends = np.append(cuts[1:], x.size)
        least = np.empty((len(family), cuts.size), dtype=np.uint64)
        second = np.empty_like(least)
        near = np.empty_like(x)
        for i in range(len(family)):
            np.multiply(x, scaled_a[i], out=near)
            near += scaled_b[i]
            near |= place[: x.size]
            np.minimum.reduceat(near, cuts, out=least[i])
            near[least[i] & np.uint64(SLICE - 1)] = last
            np.minimum.reduceat(near, cuts, out=second[i])
        found = (least & np.uint64(SLICE - 1)).astype(np.int64)
        exact = exact_hash(x[found], a[:, None], b[:, None])
        # A value below BLUR may have wrapped around from the top.
        unsure = (least < np.uint64(BLUR)) | (second - least <= np.uint64(BLUR))
        unsure &= cuts + 1 < ends
        i, part = np.nonzero(unsure)
        if i.size:
            sizes = ends[part] - cuts[part]
            whole = np.concatenate([x[cuts[p] : ends[p]] for p in part])
            each = exact_hash(whole, np.repeat(a[i], sizes), np.repeat(b[i], sizes))
            heads = np.cumsum(sizes) - sizes
            exact[i, part] = np.minimum.reduceat(each, heads)
            hits = np.flatnonzero(each == np.repeat(exact[i, part], sizes))[::-1]  # the first is set last
            of = np.repeat(np.arange(sizes.size), sizes)[hits]
            found[i[of], part[of]] = cuts[part[of]] + hits - heads[of]
        target = rows[cuts]
        less = exact.T < out[target]
        places[target] = np.where(less, found.T + (at - begin[target])[:, None], places[target])
        out[target] = np.where(less, exact.T, out[target])
    return out.astype(np.int64), places
