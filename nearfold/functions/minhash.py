"""MinHash signatures over hashed shingles."""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from nearfold.functions._batch import MERSENNE_61, minhash_rows
from nearfold.functions.shingles import list_array, row_slices, shingle_batch_rows

LARGE_PRIME = MERSENNE_61


def hash_family(num_hashes: int, seed: int = 42) -> list[tuple[int, int]]:
    """Coefficients (a, b) of ``num_hashes`` functions ``(a*x + b) mod p``.

    Draws are sequential, so a shorter family is a prefix of a longer one.
    """
    draw = random.Random(seed).randint
    return [(draw(1, LARGE_PRIME - 1), draw(0, LARGE_PRIME - 1)) for _ in range(num_hashes)]


def minhash_signature(shingles: Column | str, num_hashes: int = 128, seed: int = 42) -> Column:
    """Signature ``array<bigint>``: entry i is the least i-th hash over the set.

    An empty or NULL set gives the modulus in every entry. The product needs
    92 bits, which no JVM integer expression has, so one Arrow batch is reduced
    with split 64-bit arithmetic inside the task; no shuffle is involved.
    """
    family = hash_family(num_hashes, seed)

    @F.arrow_udf("array<bigint>")
    def minhash_batch(sets: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(sets), 0).to_numpy(zero_copy_only=False)
        values = sets.flatten().to_numpy(zero_copy_only=False)
        return _signature_array(minhash_rows(values, lengths, family))

    return minhash_batch(F.col(shingles) if isinstance(shingles, str) else shingles)


def text_sketch(text: Column | str, k: int = 5, num_hashes: int = 128, seed: int = 42) -> Column:
    """``struct<n_shingles int, signature array<bigint>>`` of a text.

    Shingles and signature in one batch call: the shingle sets, larger than the
    texts, never leave the task.
    """
    family = hash_family(num_hashes, seed)

    @F.arrow_udf("n_shingles int, signature array<bigint>")
    def sketch_batch(texts: pa.Array) -> pa.Array:
        counts, signed = np.zeros(len(texts), dtype=np.int32), np.zeros((len(texts), num_hashes), dtype=np.int64)
        for part in row_slices(texts) if len(texts) else ():
            lengths, values = shingle_batch_rows(texts.slice(part.start, part.stop - part.start), k)
            counts[part], signed[part] = lengths, minhash_rows(values, lengths, family)
        return pa.StructArray.from_arrays(
            [pa.array(counts), _signature_array(signed)], names=["n_shingles", "signature"]
        )

    text = F.col(text) if isinstance(text, str) else text
    return sketch_batch(F.coalesce(text, F.lit("")))


def signature_slice(k: int, num_hashes: int, seed: int) -> Callable[[pa.Array], pa.Array]:
    """Function from a slice of texts to their signatures."""
    family = hash_family(num_hashes, seed)

    def sign(texts: pa.Array) -> pa.Array:
        lengths, values = shingle_batch_rows(texts, k)
        return _signature_array(minhash_rows(values, lengths, family))

    return sign


def _signature_array(matrix: np.ndarray) -> pa.Array:
    return list_array(np.full(matrix.shape[0], matrix.shape[1]), matrix.ravel())
