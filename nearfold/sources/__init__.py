"""Sources, sinks and intermediate tables."""

from nearfold.sources.corpus import corpus_prefix, load_corpus, prefix_cutoff, prefix_size, spread
from nearfold.sources.scratch import release, scratch_root, stage, stage_observed
from nearfold.sources.tables import read_csv, write_csv, write_text

__all__ = [
    "corpus_prefix",
    "load_corpus",
    "prefix_cutoff",
    "prefix_size",
    "read_csv",
    "release",
    "scratch_root",
    "spread",
    "stage",
    "stage_observed",
    "write_csv",
    "write_text",
]
