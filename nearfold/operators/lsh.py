"""Candidate pairs by banding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.operators.buckets import LIST_TILE_ROWS, bucket_rows, listed_candidates
from nearfold.operators.classes import class_members, collapse, digest128, expand_pairs
from nearfold.operators.tiling import pairs_within
from nearfold.sources.scratch import stage


def band_keys(signature: Column | str, bands: int, rows: int) -> Column:
    """``array<bigint>`` with a 64-bit hash of each band's slice of the signature."""
    # A lambda rather than one expression per band, so the code stays small at many bands.
    starts = F.sequence(F.lit(1), F.lit((bands - 1) * rows + 1), F.lit(rows))
    return F.transform(starts, lambda at: F.xxhash64(F.slice(signature, at, rows)))


def shares_band(a: Column | str, b: Column | str, bands: int, rows: int) -> Column:
    """Whether two signatures agree in all rows of at least one band."""
    starts = F.sequence(F.lit(1), F.lit((bands - 1) * rows + 1), F.lit(rows))
    return F.exists(starts, lambda at: F.slice(a, at, rows) == F.slice(b, at, rows))


def require_bands(signatures: DataFrame, bands: int, rows: int) -> Column:
    """The signature, or a failed task if its length is not ``bands * rows``."""
    if bands < 1 or rows < 1:
        raise ValueError(f"bands ({bands}) and rows ({rows}) must be positive")
    message = F.lit(f"signature length must equal bands ({bands}) times rows ({rows})")
    fits = F.size(signatures["signature"]) == bands * rows
    return F.when(fits, signatures["signature"]).otherwise(F.raise_error(message))


def band_buckets(signatures: DataFrame, bands: int, rows: int) -> DataFrame:
    """``(band, bucket, doc_id)``: one row per document and band."""
    keys = band_keys(require_bands(signatures, bands, rows), bands, rows)
    return signatures.select(F.posexplode(keys).alias("band", "bucket"), "doc_id")


def class_candidates(classes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Pairs of different classes that share a band, in class form.

    ``classes`` has ``rep``, ``docs``, ``band_keys`` and the carried columns,
    which come back twice, suffixed ``_a`` and ``_b``. Each pair comes once, from
    the first band it shares: both rows bring the keys of the bands before.
    """
    carry = ["docs", *carry]
    rows = classes.select("rep", *carry, "band_keys", F.posexplode("band_keys").alias("band", "bucket"))
    rows = rows.withColumn("earlier", F.slice("band_keys", F.lit(1), F.col("band"))).drop("band_keys")
    pairs = pairs_within(
        rows, ["band", "bucket"], id_col="rep", carry=[*carry, "earlier"], condition=first_shared_band
    )
    flat = pairs.select(
        F.col("a.id").alias("rep_a"), F.col("b.id").alias("rep_b"),
        *[F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in carry for side in ("a", "b")],
    )
    return flat


def first_shared_band(x: Column, y: Column) -> Column:
    """Whether the keys of the bands before this one, ``earlier`` of two rows, differ everywhere."""
    agrees = F.zip_with(x["earlier"], y["earlier"], lambda p, q: p == q)
    return ~F.exists(agrees, lambda same: same)


def met_candidates(classes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """:func:`class_candidates` with rows that meet in arrays inside a task, for many candidates."""
    carry = ["docs", *carry]
    return listed_candidates(bucket_rows(classes, carry, LIST_TILE_ROWS), carry)


def signature_classes(
    signatures: DataFrame, bands: int, rows: int, carry: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Staged sketches ``(doc_id, h1, h2, band_keys, carry...)`` and their staged classes."""
    signature = require_bands(signatures, bands, rows)
    checked = signatures.select("doc_id", signature.alias("signature"))
    sketches = checked.select(
        "doc_id", *digest128("signature"), band_keys("signature", bands, rows).alias("band_keys"),
        *carry,
    )
    sketches = stage(sketches, "sketches")
    return sketches, stage(collapse(sketches, ["h1", "h2"], ["band_keys", *carry]), "classes")


def lsh_candidates(signatures: DataFrame, bands: int, rows: int) -> DataFrame:
    """Distinct pairs ``(doc_a, doc_b)``, ``doc_a < doc_b``, that share at least one band.

    Equal signatures are collapsed first, so copies do not swell every bucket,
    and the pairs among copies are added at the end.
    """
    sketches, classes = signature_classes(signatures, bands, rows)
    members = class_members(sketches, classes, ["h1", "h2"])
    return expand_pairs(met_candidates(classes), members, inside={})


def estimated_candidates(signatures: DataFrame, bands: int, rows: int) -> DataFrame:
    """:func:`lsh_candidates` with ``estimate``, the part of entries in which their signatures agree."""
    sketches, classes = signature_classes(signatures, bands, rows, ["signature"])
    members = class_members(sketches, classes, ["h1", "h2"])
    # A signature holds its bands: their keys stay behind.
    placed = bucket_rows(classes, ["docs", "signature"], LIST_TILE_ROWS).drop("band_keys")
    found = listed_candidates(placed, ["docs"], "signature", bands)
    return expand_pairs(found, members, ["estimate"], inside={"estimate": 1.0})
