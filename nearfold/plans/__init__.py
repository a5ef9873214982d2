"""Composite jobs."""

from nearfold.plans.estimator import estimator_error, pair_estimates, timed_estimator_error
from nearfold.plans.near_duplicates import (
    NearDuplicates,
    RunSummary,
    clean,
    near_duplicates,
    run_near_duplicates,
)
from nearfold.plans.reports import (
    audit_report,
    corpus_audit,
    example_lines,
    example_report,
    report_lines,
)
from nearfold.plans.scalability import scalability_counts, timed_scalability
from nearfold.plans.sweep import param_sweep, s_curve_table, timed_param_sweep

__all__ = [
    "NearDuplicates",
    "RunSummary",
    "audit_report",
    "clean",
    "corpus_audit",
    "estimator_error",
    "example_lines",
    "example_report",
    "near_duplicates",
    "pair_estimates",
    "param_sweep",
    "report_lines",
    "run_near_duplicates",
    "s_curve_table",
    "scalability_counts",
    "timed_estimator_error",
    "timed_param_sweep",
    "timed_scalability",
]
