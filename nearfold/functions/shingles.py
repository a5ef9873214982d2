"""Hashed character k-shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from nearfold.functions._batch import shingle_rows

# Bytes of text that are cut into sets at once; a longer text is taken by itself.
SLICE_BYTES = 1 << 20


def shingle_hash(text: Column | str) -> Column:
    """31-bit hash of a whole string: first four MD5 bytes, little-endian.

    JVM-side expression, for hashing a column of strings one by one.
    """
    digest = F.md5(text)
    turned = F.concat(*[F.substring(digest, at, 2) for at in (7, 5, 3, 1)])
    return F.conv(turned, 16, 10).cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint"))


def char_shingles(text: Column | str, k: int = 5) -> Column:
    """Set of hashed k-character substrings as a sorted ``array<int>``.

    A text shorter than k (also the empty one) has one shingle, itself. Hashes
    are below 2**31, so INT holds them at half the bytes of BIGINT. Windows
    overlap, so each is a fresh string for a JVM expression; here one Arrow
    batch is hashed from its flat UTF-8 buffer instead.
    """
    if k < 1:
        raise ValueError(f"shingle size must be at least 1, got {k}")

    @F.arrow_udf("array<int>")
    def shingle_batch(texts: pa.Array) -> pa.Array:
        return list_array(*shingle_batch_rows(texts, k))

    text = F.col(text) if isinstance(text, str) else text
    return shingle_batch(F.coalesce(text, F.lit("")))


def shingle_batch_rows(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes and flat sorted hashes of an Arrow string array without NULLs."""
    _, ends, data = texts.cast(pa.binary()).buffers()
    offsets = np.frombuffer(ends, dtype=np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return shingle_rows(np.frombuffer(data or b"", dtype=np.uint8), offsets, k)


def row_slices(texts: pa.Array) -> Iterator[slice]:
    """Runs of rows of about ``SLICE_BYTES`` of an Arrow string array, in order."""
    ends = np.frombuffer(texts.cast(pa.binary()).buffers()[1], dtype=np.int32)
    ends = ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(ends, ends[lo] + SLICE_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), len(texts))
        yield slice(lo, hi)
        lo = hi


def in_slices(
    work: Callable[[pa.Array], pa.Array], name: str
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow``: ``(doc_id, text)`` to ``(doc_id, name)``, a slice of texts at a time.

    Sets are larger than texts, so a batch's sets are never held together: what a
    task holds is one batch of texts and the sets of one slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for part in row_slices(texts) if len(texts) else ():
                rows = part.stop - part.start
                columns = [ids.slice(part.start, rows), work(texts.slice(part.start, rows))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", name])

    return run


def list_array(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    """Arrow list array from row lengths and flat values."""
    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
