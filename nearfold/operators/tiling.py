"""Pairs of rows that share a key, with hot keys split over many tasks.

A self-join on a key is quadratic in the rows of that key, and one key may hold
a large share of all rows. Each key's rows are therefore dealt by id hash into
tiles of about ``TILE_ROWS`` rows, and the join key is (key, tile, tile): no
task meets more than two tiles of a key at once, a key with one tile joins
plainly, and every pair is produced exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.sources.scratch import stage_observed

TILE_ROWS = 4096
# Shared keys are broadcast up to this many bytes in memory.
BROADCAST_BYTES = 1 << 26


def tile_count(size: Column, tile_rows: int = TILE_ROWS) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / tile_rows)).cast("int")


def tile_of(id_col: str, tiles: Column) -> Column:
    return F.pmod(F.xxhash64(id_col), tiles).cast("int")


def shared_keys(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """``(keys, _size)`` of the keys that two or more rows have, staged, and their number."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    table, seen = stage_observed(sizes.where("_size >= 2"), "shared-keys")
    return table, seen["rows"]


def pairs_within(
    rows: DataFrame,
    keys: Sequence[str],
    id_col: str = "doc_id",
    carry: Sequence[str] = (),
    tile_rows: int = TILE_ROWS,
    condition: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Pairs ``(a, b)`` of rows with equal ``keys``, as structs (id, carry...), a.id < b.id.

    Group sizes are counted with map-side partial sums, and the keys of two or
    more rows are kept as a staged table. Rows meet it first and take the size
    of their group along: where it is broadcast, a row that pairs with none is
    not shuffled at all. Beyond ``BROADCAST_BYTES`` the two sort and merge, both
    as plain exchanges, so that AQE splits a hot key; runtime filters, if the
    session has them on, drop single rows ahead of that exchange. Then rows of
    hot keys are dealt into tiles. A pair comes once per group it shares;
    ``condition`` on the two structs drops pairs inside the join.
    """
    shared, count = shared_keys(rows, keys)
    small = count * (16 * len(keys) + 48) <= BROADCAST_BYTES
    sized = rows.join(F.broadcast(shared) if small else shared.hint("merge"), list(keys))
    return pairs_of_sized(sized, keys, "_size", id_col, carry, tile_rows, condition)


def pairs_of_sized(
    rows: DataFrame,
    keys: Sequence[str],
    size_col: str,
    id_col: str = "doc_id",
    carry: Sequence[str] = (),
    tile_rows: int = TILE_ROWS,
    condition: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """:func:`pairs_within` for rows that already carry the size of their group."""
    placed = _place(rows, id_col, tile_count(F.col(size_col), tile_rows))
    return _meet(placed, keys, id_col, carry, condition)


def all_pairs(rows: DataFrame, id_col: str = "doc_id", tile_rows: int = TILE_ROWS) -> DataFrame:
    """Every pair of rows, for questions whose answer is every pair."""
    return _meet(_place(rows, id_col, tile_count(F.lit(rows.count()), tile_rows)), (), id_col, ())


def _place(rows: DataFrame, id_col: str, tiles: Column) -> DataFrame:
    """Copy each row to every tile pair its own tile takes part in."""
    placed = rows.withColumn("_tiles", tiles).withColumn("_tile", tile_of(id_col, F.col("_tiles")))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    return placed.withColumns(
        {"_lo": F.least("_tile", "_other"), "_hi": F.greatest("_tile", "_other")}
    )


def _meet(
    placed: DataFrame,
    keys: Sequence[str],
    id_col: str,
    carry: Sequence[str],
    condition: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Join the tiles. Both sides are the same plan, so they share one exchange."""
    item = F.struct(F.col(id_col).alias("id"), *carry).alias("_item")
    side = placed.select(*keys, "_lo", "_hi", "_tile", item)
    x, y = side.alias("x"), side.alias("y")
    same = [F.col(f"x.{key}") == F.col(f"y.{key}") for key in (*keys, "_lo", "_hi")]
    # Tiles meet across; within a tile only on the diagonal, each pair one way.
    one_way = (F.col("x._tile") < F.col("y._tile")) | (
        (F.col("x._lo") == F.col("x._hi")) & (F.col("x._item.id") < F.col("y._item.id"))
    )
    if condition is not None:
        one_way &= condition(F.col("x._item"), F.col("y._item"))
    return x.join(y.hint("merge"), [*same, one_way]).select(
        F.least("x._item", "y._item").alias("a"), F.greatest("x._item", "y._item").alias("b")
    )


def tiled_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    condition: Column,
    id_col: str,
    hot: DataFrame | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Inner join of aliased ``l`` and ``r`` on ``keys`` where hot keys form a grid of tiles.

    ``hot`` lists the keys to split with their row counts ``_left`` and
    ``_right``; all other keys join as one tile.
    """
    if hot is None:
        same = [F.col(f"l.{key}") == F.col(f"r.{key}") for key in keys]
        return left.alias("l").join(right.hint("merge").alias("r"), [*same, condition])
    grid = hot.select(
        *keys,
        tile_count(F.col("_left"), tile_rows).alias("_lefts"),
        tile_count(F.col("_right"), tile_rows).alias("_rights"),
    )

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(grid, list(keys), "left").fillna(1, ["_lefts", "_rights"])
        return rows.withColumn(own, tile_of(id_col, F.col(f"{own}s"))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))
        )

    placed_left, placed_right = dealt(left, "_left", "_right"), dealt(right, "_right", "_left")
    same = [F.col(f"l.{key}") == F.col(f"r.{key}") for key in (*keys, "_left", "_right")]
    return placed_left.alias("l").join(placed_right.hint("merge").alias("r"), [*same, condition])
