"""Benchmark decontamination by spaced-seed hashing.

A seed looks at some of the tokens in a stretch of text and ignores the others.
Fixed masks are laid at every position of every benchmark item and every
document; where the tokens they look at have equal hashes, item and document are
aligned there. An alignment is a leak if a run of ``overlap`` aligned tokens (or
the whole item, if it is shorter) has at least ``identity`` of them equal, so
replaced words do not hide a passage.

The seeds of the benchmark are a bitmap of fixed size, broadcast: a narrow pass
over the whole texts keeps only the stretches around hits. Hits then join the
benchmark's seeds by hash, alignments are deduplicated, and the stretches are
compared with the items. Documents that share nothing with a benchmark send
nothing into a shuffle (but for chance hits of the bitmap).

Tokens are runs of letters and figures, lower-cased. For items shorter than
``overlap``, patterns of replaced words that no mask hits have seeds of their
own; for items shorter than the longest mask these are all patterns. Defined cases:
null and empty texts (and items without a token) match nothing; null ids are
kept in the result of :func:`leaks` and never dropped by
:func:`drop_contaminated`; repeated rows and items are matched one by one and
reported once for each pair of ids; empty tables give empty results; other
columns are ignored by :func:`leaks` and kept by :func:`drop_contaminated`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.llm.common import byte_hint, drop_ids, sized_hint, whole
from nearfold.sources.scratch import stage

#: Positions a mask looks at (1) and ignores (0). Together they hit every run of 20 tokens of which 16 or
#: more are equal, whatever the places of the others, and every run of 15 of which 12 are.
MASKS = ("11111", "1101011", "110010101")
OVERLAP = 20
IDENTITY = 0.8
#: Alignments of a stretch and an item at this many neighbouring places are compared together.
SHIFTS = 4096
#: Bits of the bitmap of benchmark seeds (8 MB): a fixed size, larger benchmarks only pass more chance hits.
BITMAP_BITS = 1 << 26

_TOKEN = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Token to 64-bit hash, remembered; forgotten when it has grown large."""

    LIMIT = 500_000

    def __missing__(self, token: str) -> int:
        if len(self) > self.LIMIT:
            self.clear()
        self[token] = value = xxhash.xxh3_64_intdigest(token)
        return value


def tokens(text: str, hashes: _Hashes) -> np.ndarray:
    found = _TOKEN.findall(text.lower())
    return np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))


def seed_hashes(values: np.ndarray, offsets: np.ndarray, kind: int) -> np.ndarray:
    """Hash of the tokens at ``offsets`` from every position where the mask fits."""
    count = len(values) - int(offsets[-1])
    if count <= 0:
        return np.empty(0, np.uint64)
    mixed = np.full(count, kind + 1, np.uint64)
    for offset in offsets.tolist():
        mixed = (mixed ^ values[offset : offset + count]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


def mask_offsets(masks: tuple[str, ...]) -> list[np.ndarray]:
    return [np.flatnonzero(np.array(list(m)) == "1") for m in masks]


@cache
def extra_offsets(width: int, masks: tuple[str, ...], identity: float) -> list[np.ndarray]:
    """Offsets of further seeds for items of ``width`` tokens: one for each pattern that no mask hits.

    Patterns are the places that may be replaced with ``identity`` kept; the seed looks at all others.
    """
    replaced = width - math.ceil(identity * width - 1e-9)
    seen = [set((at + o).tolist()) for o in mask_offsets(masks) for at in range(width - int(o[-1]))]
    return [
        np.setdiff1d(np.arange(width), places)
        for places in combinations(range(width), replaced)
        if not any(s.isdisjoint(places) for s in seen)
    ]


def used_masks(width: int, masks: tuple[str, ...]) -> tuple[str, ...]:
    """All masks, or none for items shorter than the longest."""
    return masks if width >= max(len(m) for m in masks) else ()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    masks: tuple[str, ...] = MASKS,
    overlap: int = OVERLAP,
    identity: float = IDENTITY,
) -> DataFrame:
    """``(id, item, token_start, n_tokens, n_equal)``: the best run for each pair of ids.

    ``token_start`` is the first token of the run in the document.
    """
    offsets = mask_offsets(masks)
    longest = max(len(m) for m in masks)
    item_type = benchmark.schema[item_col].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()

    def extra_kinds(width: int) -> list[tuple[int, np.ndarray]]:
        found = extra_offsets(width, used_masks(width, masks), identity)
        return [((width << 32) + n, places) for n, places in enumerate(found)]

    def read_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            values = [tokens(t.as_py(), hashes) for t in batch.column(1)]
            lists = pa.array([v.view(np.int64) for v in values], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["item", "tokens"])

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, listed in zip(batch.column(0), batch.column(1), strict=True):
                values = np.array(listed.as_py(), np.int64).view(np.uint64)
                width = len(values)
                used = [(kind, places, 0) for kind, places in enumerate(offsets) if width >= longest]
                if width < overlap or width < longest:
                    used += [(kind, places, width) for kind, places in extra_kinds(width)]
                for kind, places, short in used:
                    found = seed_hashes(values, places, kind).view(np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "_item_row": [key.as_py()] * len(found), "seed": found,
                        "item_at": np.arange(len(found), dtype=np.int32),
                        "short": np.full(len(found), short, np.int32),
                    })

    items = benchmark.select(F.col(item_col).alias("item"), whole(text_col).alias("text"))
    items = items.mapInArrow(read_items, f"item {item_type}, tokens array<long>").where("size(tokens) > 0")
    items = items.withColumns({"_item_row": F.monotonically_increasing_id(), "_width": F.size("tokens")})
    items = stage(items, "bench-items")
    seeds = items.select("_item_row", "tokens").mapInArrow(
        item_seeds, "_item_row long, seed long, item_at int, short int"
    )
    seeds = stage(seeds, "bench-seeds")

    # The bitmap, gathered as the distinct bytes that have a bit set: at most BITMAP_BITS / 8 rows.
    slot = F.col("seed").bitwiseAND(F.lit(BITMAP_BITS - 1))
    held = (
        seeds.select(F.shiftright(slot, 3).alias("byte"), F.pmod(slot, F.lit(8)).alias("bit"))
        .groupBy("byte").agg(F.bit_or(F.expr("shiftleft(1, cast(bit as int))")).alias("bits"))
    ).toArrow()
    bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)
    bitmap[held.column("byte").to_numpy()] = held.column("bits").to_numpy().astype(np.uint8)
    shorts = sorted(r["short"] for r in seeds.where("short > 0").select("short").distinct().collect())
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bitmap.tobytes())
    kinds = [*enumerate(offsets), *(kind for n in shorts for kind in extra_kinds(n))]
    reach = max(overlap, longest)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_bits = np.frombuffer(shared.value, np.uint8)
        hashes = _Hashes()
        for batch in batches:
            ids, starts, parts, hit_seeds, hit_places = [], [], [], [], []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                values = tokens(text.as_py(), hashes)
                places, seeds_here, ends = [], [], []
                for kind, at in kinds:
                    found = seed_hashes(values, at, kind)
                    slots = found & np.uint64(BITMAP_BITS - 1)
                    hit = np.flatnonzero(held_bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1)
                    places.append(hit)
                    ends.append(hit + len(at))
                    seeds_here.append(found[hit])
                place = np.concatenate(places)
                if not len(place):
                    continue
                order = np.argsort(place, kind="stable")
                place, seed = place[order], np.concatenate(seeds_here)[order]
                # Hits whose stretches touch are sent as one stretch.
                breaks = np.flatnonzero(np.diff(place) > 2 * reach + longest) + 1
                for group in np.split(np.arange(len(place)), breaks):
                    first = max(0, int(place[group[0]]) - reach)
                    last = int(place[group[-1]]) + longest + reach + (shorts[-1] if shorts else 0)
                    ids.append(key)
                    starts.append(first)
                    parts.append(values[first:last].view(np.int64))
                    hit_seeds.append(seed[group].view(np.int64))
                    hit_places.append(place[group].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i.as_py() for i in ids], batch.schema.field(0).type),
                    pa.array(starts, pa.int32()), pa.array(parts, pa.list_(pa.int64())),
                    pa.array(hit_seeds, pa.list_(pa.int64())), pa.array(hit_places, pa.list_(pa.int32())),
                ],
                ["id", "start", "part", "seeds", "places"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"token_start": [], "n_tokens": [], "n_equal": []}
            for part, item, start, shifts in zip(
                batch.column("part"), batch.column("tokens"), batch.column("start"),
                batch.column("shifts"), strict=True,
            ):
                begin = start.as_py()
                run = best_of_shifts(
                    part.values.to_numpy(), item.values.to_numpy(),
                    shifts.values.to_numpy() - begin, overlap, identity,
                )
                out["token_start"].append(None if run is None else run[0] + begin)
                out["n_tokens"].append(None if run is None else run[1])
                out["n_equal"].append(None if run is None else run[2])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("item"), *(pa.array(v, pa.int32()) for v in out.values())],
                ["id", "item", *out],
            )

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    stretches = rows.mapInArrow(
        scan, f"id {id_type}, start int, part array<long>, seeds array<long>, places array<int>"
    ).withColumn("_stretch", F.monotonically_increasing_id())
    stretches = stage(stretches, "bench-stretches")
    hits = stretches.select("_stretch", F.explode(F.arrays_zip("seeds", "places")).alias("hit")).select(
        "_stretch", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("place")
    )
    # All alignments of a stretch and an item in a range of SHIFTS places are one row, and only the tokens
    # they reach go with it: a text that repeats one word costs its length, not its square.
    shift = F.col("place") - F.col("item_at")
    aligned = (
        hits.join(sized_hint(seeds), "seed")
        .groupBy("_stretch", "_item_row", F.floor(shift / SHIFTS).cast("int").alias("_range"))
        .agg(F.collect_set(shift).alias("shifts"))
    )
    first = F.greatest(F.lit(0), F.array_min("shifts") - F.col("start"))
    last = F.array_max("shifts") - F.col("start") + F.col("_width")
    compared = (
        aligned.join(sized_hint(items.select("_item_row", "_width")), "_item_row")
        .join(stretches.select("_stretch", "id", "start", "part").hint("merge"), "_stretch")
        .select(
            "_item_row", "id", "shifts", (F.col("start") + first).alias("start"),
            F.slice("part", first + 1, F.greatest(F.lit(0), last - first)).alias("part"),
        )
        .join(byte_hint(items.select("_item_row", "item", "tokens")), "_item_row")
        .select("id", "item", "start", "shifts", "part", "tokens")
        .mapInArrow(compare, f"id {id_type}, item {item_type}, token_start int, n_tokens int, n_equal int")
    )
    best = F.max_by(
        F.struct("token_start", "n_tokens", "n_equal"),
        F.struct("n_equal", -F.col("n_tokens"), -F.col("token_start")),
    )
    runs = compared.where("n_equal is not null").groupBy("id", "item").agg(best.alias("_run"))
    return runs.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "_run.*")


def best_of_shifts(
    part: np.ndarray, item: np.ndarray, shifts: np.ndarray, overlap: int, identity: float
) -> tuple[int, int, int] | None:
    """Best of :func:`best_run` over ``shifts``: most equal tokens, then shortest, then first."""
    best = None
    for shift in np.sort(shifts).tolist():
        run = best_run(part, item, shift, overlap, identity)
        if run is not None and (best is None or (run[2], -run[1], -run[0]) > (best[2], -best[1], -best[0])):
            best = run
            if best[2] == len(item):  # the whole item, and no later one comes before it
                break
    return best


def best_run(
    part: np.ndarray, item: np.ndarray, shift: int, overlap: int, identity: float
) -> tuple[int, int, int] | None:
    """First to last leaking window as (start in part, tokens, equal tokens), if any.

    Item token i is aligned with part token ``shift + i``.
    """
    first, last = max(0, -shift), min(len(item), len(part) - shift)
    width = min(overlap, len(item))
    if last - first < width:
        return None
    equal = (part[shift + first : shift + last] == item[first:last]).astype(np.int64)
    sums = np.concatenate(([0], np.cumsum(equal)))
    good = np.flatnonzero(sums[width:] - sums[:-width] >= identity * width - 1e-9)
    if not len(good):
        return None
    a, b = int(good[0]), int(good[-1]) + width
    while not equal[a]:  # a run begins and ends with equal tokens
        a += 1
    while not equal[b - 1]:
        b -= 1
    return shift + first + a, b - a, int(sums[b] - sums[a])


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without those that hold a passage of ``benchmark``."""
    found = leaks(docs, benchmark, id_col, text_col=text_col).where(F.col(id_col).isNotNull())
    return drop_ids(docs, stage(found.select(id_col).distinct(), "contaminated"), id_col)
