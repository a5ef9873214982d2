"""Settings of a near-duplicate run."""

from __future__ import annotations

from dataclasses import dataclass


def check_bands(num_hashes: int, bands: int, rows: int) -> None:
    """The bands have to use up the signature exactly."""
    if bands < 1 or rows < 1 or bands * rows != num_hashes:
        raise ValueError(
            f"bands ({bands}) times rows ({rows}) must equal the signature length ({num_hashes})"
        )


@dataclass(frozen=True)
class Params:
    """Shingle size, signature length, banding, Jaccard threshold and seed."""

    k: int = 5
    num_hashes: int = 128
    bands: int = 16
    rows: int = 8
    threshold: float = 0.5
    seed: int = 42

    def __post_init__(self) -> None:
        check_bands(self.num_hashes, self.bands, self.rows)
