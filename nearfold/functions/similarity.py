"""Set similarity, its MinHash estimate and the banding curve."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Exact Jaccard similarity of two duplicate-free arrays; two empty ones give 0."""
    a, b = _col(a), _col(b)
    common = F.size(F.array_intersect(a, b))
    # A lambda variable: the intersection is taken once, not once per mention.
    scored = F.transform(F.array(common), lambda c: jaccard_of_counts(c, F.size(a), F.size(b)))
    return F.get(scored, F.lit(0))


def jaccard_of_counts(common: Column, size_a: Column, size_b: Column) -> Column:
    """Jaccard similarity from the sizes of the intersection and of both sets."""
    union = size_a + size_b - common
    return F.when(union > 0, common / union).otherwise(F.lit(0.0))


def estimate_jaccard(a: Column | str, b: Column | str) -> Column:
    """Share of agreeing signature positions, counted over the length of ``a``.

    ``zip_with`` pads the shorter array with NULL, which never agrees.
    """
    a, b = _col(a), _col(b)
    agreeing = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), agreeing / F.size(a)).otherwise(F.lit(0.0))


def s_curve(similarity: Column | str, bands: int | Column, rows: int | Column) -> Column:
    """Chance ``1 - (1 - s^r)^b`` that a pair of similarity s shares a band."""
    return F.lit(1.0) - F.pow(F.lit(1.0) - F.pow(_col(similarity), rows), bands)


def error_bound(num_hashes: int | Column) -> Column:
    """Theoretical scale ``1/sqrt(n)`` of the estimator's error."""
    return F.lit(1.0) / F.sqrt(F.lit(num_hashes) if isinstance(num_hashes, int) else num_hashes)
