"""Column functions."""

from nearfold.functions.minhash import LARGE_PRIME, hash_family, minhash_signature, text_sketch
from nearfold.functions.rounding import python_fixed, python_round
from nearfold.functions.shingles import char_shingles, shingle_hash
from nearfold.functions.similarity import (
    error_bound,
    estimate_jaccard,
    jaccard,
    jaccard_of_counts,
    s_curve,
)
from nearfold.functions.text import excerpt, normalize_text

__all__ = [
    "LARGE_PRIME",
    "char_shingles",
    "error_bound",
    "estimate_jaccard",
    "excerpt",
    "hash_family",
    "jaccard",
    "jaccard_of_counts",
    "minhash_signature",
    "normalize_text",
    "python_fixed",
    "python_round",
    "s_curve",
    "shingle_hash",
    "text_sketch",
]
