"""Operators on DataFrames."""

from nearfold.operators.audit import class_degrees, dedup_audit, doc_degrees, jaccard_histogram
from nearfold.operators.evaluate import pair_metrics
from nearfold.operators.exact import exact_pairs
from nearfold.operators.examples import top_class_pairs, top_pairs
from nearfold.operators.lsh import band_buckets, lsh_candidates
from nearfold.operators.sampling import sample_pairs
from nearfold.operators.shingling import shingle_sets, shingle_table
from nearfold.operators.signatures import hash_family_table, minhash_signatures
from nearfold.operators.verify import attach_jaccard, verify_candidates

__all__ = [
    "attach_jaccard",
    "band_buckets",
    "class_degrees",
    "dedup_audit",
    "doc_degrees",
    "exact_pairs",
    "hash_family_table",
    "jaccard_histogram",
    "lsh_candidates",
    "minhash_signatures",
    "pair_metrics",
    "sample_pairs",
    "shingle_sets",
    "shingle_table",
    "top_class_pairs",
    "top_pairs",
    "verify_candidates",
]
