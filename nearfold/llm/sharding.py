"""Shards by consistent hashing with virtual nodes and bounded loads.

Every shard owns ``replicas`` points on a ring of 64-bit hashes; a row belongs
to the first point at or after the hash of its key. No shard may take more than
its share: with ``slack`` 0 the shares are floor or ceiling of rows / shards, so
counts differ by at most one. Rows stay at home while their shard has room, in
ring order; the others continue clockwise to the first shard that has room left.

The rows of a ring arc are interchangeable for that decision, so the walk is
planned over the counts of the arcs (``shards * replicas + 1`` numbers, whatever
the size of the corpus) and yields intervals of rows in ring order. Spark
numbers the rows in ring order with one shuffle of ids, sizes and checksums;
texts are read once and never shuffled.

Defined cases: null text counts as empty, a null key hashes like the empty
text, equal rows are placed one by one, an empty table gives an empty result,
other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.llm.common import globally_ranked, whole
from nearfold.sources.scratch import stage

SHARDS = 40
REPLICAS = 256
ROW_OVERHEAD = 16


def ring(shards: int, replicas: int = REPLICAS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted signed 64-bit points and the shard that owns each."""
    owners = np.repeat(np.arange(shards), replicas)
    points = np.array(
        [xxhash.xxh64_intdigest(f"{s}/{r}") for s in range(shards) for r in range(replicas)],
        dtype=np.uint64,
    ).view(np.int64)
    order = np.lexsort((owners, points))
    return points[order], owners[order]


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard; they add up to at least ``rows``."""
    if slack > 0:
        return [int(np.ceil((1 + slack) * rows / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan_walk(
    counts: Sequence[int], owners: Sequence[int], limits: Sequence[int]
) -> list[tuple[int, int, int]]:
    """Intervals ``(first row, shard, first slot)`` in ring order that cover all rows.

    ``counts`` are the rows of the arcs in ring order, ``owners`` their shards.
    """
    room = list(limits)
    used = [0] * len(room)
    pieces: list[tuple[int, int, int]] = []
    waiting: list[tuple[int, int, int]] = []  # arc, first row, rows
    first = 0
    for arc, count in enumerate(counts):
        shard = owners[arc]
        home = min(count, room[shard])
        if home:
            pieces.append((first, shard, used[shard]))
            used[shard] += home
            room[shard] -= home
        if count > home:
            waiting.append((arc, first + home, count - home))
        first += count
    for arc, start, count in waiting:
        at = arc
        while count:
            at = (at + 1) % len(owners)
            shard = owners[at]
            if moved := min(count, room[shard]):
                pieces.append((start, shard, used[shard]))
                used[shard] += moved
                room[shard] -= moved
                start += moved
                count -= moved
    return sorted(pieces)


def bounded_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    replicas: int = REPLICAS,
    slack: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, size, text_crc32, shard, slot, moved)``; ``moved``: not on the shard of its own point."""
    points, owners = ring(shards, replicas)
    # Rows beyond the last point belong to the first: one more arc with that owner.
    arc_owner = np.append(owners, owners[0])

    @F.pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, position.to_numpy(), side="left").astype(np.int32))

    text = whole(text_col)
    keyed = docs.select(
        F.col(id_col).alias(id_col),
        (F.octet_length(text).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_position"),
        F.monotonically_increasing_id().alias("_row"),
    )
    keyed = stage(keyed.withColumn("_arc", arc_of("_position")), "shard-keys")
    found = {r["_arc"]: r["count"] for r in keyed.groupBy("_arc").count().collect()}
    counts = [found.get(arc, 0) for arc in range(len(arc_owner))]
    pieces = plan_walk(counts, arc_owner.tolist(), capacities(sum(counts), shards, slack))
    begins = np.array([p[0] for p in pieces], dtype=np.int64)
    targets = np.array([p[1] for p in pieces], dtype=np.int32)
    slots = np.array([p[2] for p in pieces], dtype=np.int64)

    @F.pandas_udf("shard int, slot long")
    def place(g: pd.Series) -> pd.DataFrame:
        rows = g.to_numpy()
        piece = np.searchsorted(begins, rows, side="right") - 1
        return pd.DataFrame({"shard": targets[piece], "slot": slots[piece] + rows - begins[piece]})

    @F.pandas_udf("int")
    def owner_of(arc: pd.Series) -> pd.Series:
        return pd.Series(arc_owner[arc.to_numpy()].astype(np.int32))

    ranked = globally_ranked(
        keyed, ["_position", id_col, "size", "text_crc32", "_row"], "shard-order"
    )
    return ranked.withColumn("_place", place("g")).select(
        id_col, "size", "text_crc32", "_place.shard", "_place.slot",
        (owner_of("_arc") != F.col("_place.shard")).alias("moved"),
    )
