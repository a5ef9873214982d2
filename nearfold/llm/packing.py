"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are placed longest first. A piece goes into the open bin with the least
room that still holds it; if none does, a bin is opened whose length has the
least cost for each token it is expected to hold, given the shorter pieces
still to come. At the end every bin shrinks to the least permitted length that
holds its contents.

Pieces of one length are interchangeable, so the packing is planned over the
histogram of lengths: at most ``max(lengths)`` numbers, whatever the size of the
corpus. The plan says which run of pieces (in the order of length) goes to which
run of bins and at which offset. Spark numbers the pieces with one shuffle of
ids and lengths; each row then looks up its place.

A document is as long as its white-space words plus ``end_tokens`` (or the value
of ``length_col``); one longer than the largest bin is cut into pieces, none is
dropped. Defined cases: null text counts as empty (a piece of ``end_tokens``
tokens), a null or negative length counts as 0, documents of length 0 make no
piece, null ids and repeated rows are packed like others, an empty table gives
an empty result, other columns of the input are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.llm.common import globally_ranked, whole
from nearfold.sources.scratch import stage

LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a sequence: a fixed share, a linear one and the quadratic one of attention.
FIXED_COST = 32.0
QUADRATIC_COST = 1 / 8192


def sequence_cost(length: int) -> float:
    return FIXED_COST + length + QUADRATIC_COST * length * length


@dataclass
class PackingPlan:
    """Runs of pieces and runs of bins, as parallel arrays sorted by their starts."""

    piece_start: list[int] = field(default_factory=list)
    first_bin: list[int] = field(default_factory=list)
    per_bin: list[int] = field(default_factory=list)
    length: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    bin_start: list[int] = field(default_factory=list)
    bin_tokens: list[int] = field(default_factory=list)
    bin_opened: list[int] = field(default_factory=list)
    bin_length: list[int] = field(default_factory=list)


def plan_packing(histogram: dict[int, int], lengths: Sequence[int] = LENGTHS) -> PackingPlan:
    """Plan for ``histogram`` (length to pieces); pieces are numbered longest first."""
    sizes = sorted(lengths)
    plan = PackingPlan()
    rooms: dict[int, list[tuple[int, int, int]]] = {}  # room: runs (first bin, bins, opened length)
    order: list[int] = []  # rooms in use, ascending
    bins = piece = 0
    ahead = sum(size * count for size, count in histogram.items())

    def put(room: int, run: tuple[int, int, int]) -> None:
        if room not in rooms:
            bisect.insort(order, room)
            rooms[room] = []
        rooms[room].append(run)

    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        ahead -= length * count

        def fill(first: int, full: int, each: int, room: int, opened: int, length: int = length) -> None:
            nonlocal piece
            plan.piece_start.append(piece)
            plan.first_bin.append(first)
            plan.per_bin.append(each)
            plan.length.append(length)
            plan.offset.append(opened - room)
            piece += full * each
            put(room - each * length, (first, full, opened))

        while count and (at := bisect.bisect_left(order, length)) < len(order):
            room = order[at]
            first, many, opened = rooms[room].pop()
            each = min(room // length, count)
            full = min(many, count // each)
            if full < many:
                rooms[room].append((first + full, many - full, opened))
            if not rooms[room]:
                del rooms[room]
                order.pop(at)
            fill(first, full, each, room, opened)
            count -= full * each
        while count:
            each, opened = _opening(length, count, ahead, sizes)
            full = count // each
            fill(bins, full, each, opened, opened)
            bins += full
            count -= full * each
    runs = sorted((*run, room) for room, group in rooms.items() for run in group)
    for first, _, opened, room in runs:
        plan.bin_start.append(first)
        plan.bin_opened.append(opened)
        plan.bin_tokens.append(opened - room)
        plan.bin_length.append(next(s for s in sizes if s >= opened - room))
    return plan


def _opening(length: int, count: int, ahead: int, sizes: Sequence[int]) -> tuple[int, int]:
    """Pieces a bin and bin length of least cost for each token expected in it."""
    best = None
    for size in sizes:
        if size >= length:
            each = min(size // length, count)
            full = count // each
            expected = full * each * length + min(full * (size - each * length), ahead)
            cost = full * sequence_cost(size) / expected
            if best is None or cost < best[0]:
                best = (cost, each, size)
    return best[1], best[2]


def word_count(text_col: str = "text") -> Column:
    """White-space words; ASCII white space only, so that it is the same everywhere."""
    trimmed = F.regexp_replace(whole(text_col), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")))


def pack_documents(
    docs: DataFrame,
    lengths: Sequence[int] = LENGTHS,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
    end_tokens: int = 1,
) -> DataFrame:
    """``(id, piece, token_start, n_tokens, bin, bin_offset, bin_tokens, opened_length, bin_length)``."""
    largest = max(lengths)
    tokens = F.col(length_col) if length_col else word_count(text_col) + end_tokens
    sized = docs.select(
        F.col(id_col).alias(id_col),
        F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(0)).alias("_tokens"),
        F.monotonically_increasing_id().alias("_row"),
    )
    cut = sized.where("_tokens > 0").withColumn(
        "piece", F.explode(F.sequence(F.lit(0), ((F.col("_tokens") - 1) / largest).cast("int")))
    )
    token_start = F.col("piece").cast("long") * largest
    pieces = cut.select(
        id_col, "piece", token_start.alias("token_start"),
        F.least(F.lit(largest), F.col("_tokens") - token_start).cast("int").alias("n_tokens"), "_row",
    )
    pieces = stage(pieces, "pack-pieces")
    histogram = {r["n_tokens"]: r["count"] for r in pieces.groupBy("n_tokens").count().collect()}
    plan = plan_packing(histogram, lengths)
    run = {k: np.array(getattr(plan, k), dtype=np.int64) for k in plan.__dataclass_fields__}

    @F.pandas_udf("bin long, bin_offset int, bin_tokens int, opened_length int, bin_length int")
    def place(g: pd.Series) -> pd.DataFrame:
        rows = g.to_numpy()
        i = np.searchsorted(run["piece_start"], rows, side="right") - 1
        nth, within = np.divmod(rows - run["piece_start"][i], run["per_bin"][i])
        number = run["first_bin"][i] + nth
        j = np.searchsorted(run["bin_start"], number, side="right") - 1
        return pd.DataFrame({
            "bin": number,
            "bin_offset": run["offset"][i] + within * run["length"][i],
            "bin_tokens": run["bin_tokens"][j],
            "opened_length": run["bin_opened"][j],
            "bin_length": run["bin_length"][j],
        })

    pieces = pieces.withColumn("_shorter", -F.col("n_tokens"))
    ranked = globally_ranked(pieces, ["_shorter", id_col, "piece", "_row"], "pack-order")
    return ranked.withColumn("_place", place("g")).select(
        id_col, "piece", "token_start", "n_tokens", "_place.*"
    )
