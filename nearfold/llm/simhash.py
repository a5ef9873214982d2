"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most ``2 r`` bits share a variant:
half of the differing bits flipped in one is the other half flipped in the
other. So every distinct fingerprint emits all its variants within radius ``r``
(2,081 for r = 2), variants meet, and fingerprints that share one are linked.
Sharing is also proof, as both are within ``r`` of the variant; it is checked
again by counting bits. Fingerprints of one variant are all linked to the least
of them, so a group of any size yields a chain of stars, never all its pairs.

Shuffling 2,081 rows for each fingerprint would be many times the corpus.
Variants are therefore grouped by their leading bits: a fingerprint travels once
to each group in which it has variants (56 groups for ten bits), packed with
others into one binary row, and the group's task enumerates exactly the variants
that begin with its bits. The work is the same 2,081 variants each, the shuffle
some 450 bytes. Where many fingerprints share their leading bits the groups are
split by further bits, so that a task holds a bounded number.

Fingerprints: lower-case A-Z, words between ASCII white space, shingles of four
words with repeats (fewer words: the whole sequence), each hashed by XXH64 with
seed 42; a bit is set if more than half of the hashes have it. Without words the
fingerprint is zero. Defined cases: null text counts as empty, so all empty
texts are one group; a null id takes part and gets the least id of its group
(null if there is none); repeated rows each give a row; other columns of the
input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.llm.common import drop_ids, whole
from nearfold.llm.components import components
from nearfold.sources.scratch import stage

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
BITS = 64
#: Groups by leading bits, and fingerprints a group may hold before it is split further.
PREFIX_BITS = 10
GROUP_FINGERPRINTS = 2048


def fingerprint(text: str, words_each: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(words_each, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)), np.uint64, len(ends)
    )
    ones = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 65536):  # bounded memory for very long texts
        part = hashes[begin : begin + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp long)`` of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    signed = rows.mapInArrow(sign, f"id {docs.schema[id_col].dataType.simpleString()}, fp long")
    return signed.withColumnRenamed("id", id_col)


def flips(bits: int, radius: int) -> list[np.ndarray]:
    """Masks over the low ``bits`` bits with exactly 0, 1, ... ``radius`` bits set."""
    return [
        np.array([sum(1 << b for b in c) for c in combinations(range(bits), n)], dtype=np.uint64)
        for n in range(radius + 1)
    ]


def _up_to(masks: list[np.ndarray], most: int) -> np.ndarray:
    return np.concatenate(masks[: most + 1]) if most >= 0 else masks[0][:0]


class Groups:
    """Groups of variants: the leading bits, and ``extra[prefix]`` bits more where it is crowded."""

    def __init__(self, extra: dict[int, int], prefix_bits: int, radius: int):
        self.extra, self.prefix_bits, self.radius = extra, prefix_bits, radius
        self.prefix_flips = flips(prefix_bits, radius)
        self.extra_flips = {bits: flips(bits, radius) for bits in set(extra.values())}

    def deal(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group keys and fingerprints: each once for each group where it has a variant."""
        keys, values = [], []
        for flipped, masks in enumerate(self.prefix_flips):
            for mask in masks:
                prefix = (fps >> np.uint64(BITS - self.prefix_bits)) ^ mask
                plain = np.ones(len(fps), dtype=bool)
                for crowded, bits in self.extra.items():
                    here = prefix == np.uint64(crowded)
                    plain &= ~here
                    for more in _up_to(self.extra_flips[bits], self.radius - flipped) if here.any() else ():
                        sub = (fps[here] >> np.uint64(BITS - self.prefix_bits - bits)) & np.uint64((1 << bits) - 1)
                        keys.append((np.uint64(crowded) << np.uint64(32)) | (sub ^ more))
                        values.append(fps[here])
                keys.append(prefix[plain] << np.uint64(32))
                values.append(fps[plain])
        return np.concatenate(keys), np.concatenate(values)

    def links(self, key: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links among ``fps`` by the variants in group ``key``, as a forest of stars."""
        prefix, sub = key >> 32, key & 0xFFFFFFFF
        bits = self.extra.get(prefix, 0)
        fixed = self.prefix_bits + bits
        head = np.uint64((prefix << bits) | sub)
        fps = np.unique(fps)
        spent = np.bitwise_count((fps >> np.uint64(BITS - fixed)) ^ head).astype(np.int64)
        tails = flips(BITS - fixed, self.radius)
        low = np.uint64((1 << (BITS - fixed)) - 1)
        variants, owners = [], []
        for used in range(self.radius + 1):
            own = np.flatnonzero(spent == used)
            masks = _up_to(tails, self.radius - used)
            variants.append(((fps[own] & low)[:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(own, len(masks)))
        variant, owner = np.concatenate(variants), np.concatenate(owners)
        order = np.argsort(variant, kind="stable")
        variant, owner = variant[order], owner[order]
        same = np.flatnonzero(variant[1:] == variant[:-1])
        pairs = np.unique(np.stack([owner[same], owner[same + 1]], axis=1), axis=0)
        a, b = fps[pairs[:, 0]], fps[pairs[:, 1]]
        near = np.bitwise_count(a ^ b) <= 2 * self.radius
        return a[near], b[near]


def linked_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """Edges ``(u, v)`` that connect all distinct ``fps(fp)`` within ``max_bits`` of each other.

    ``fps`` should be a staged table of distinct values. ``max_bits`` is rounded
    up to ``2 r`` for the variants; pairs beyond it are then dropped, and for an
    odd value links are between the pairs that share a variant.
    """
    if max_bits % 2:
        raise ValueError("an odd number of bits has no exact half")
    radius = max_bits // 2
    home = F.shiftrightunsigned("fp", BITS - prefix_bits).alias("prefix")
    crowd = fps.groupBy(home).count().where(F.col("count") > GROUP_FINGERPRINTS).collect()
    extra = {
        int(r["prefix"]): min(24, int(np.ceil(np.log2(r["count"] / GROUP_FINGERPRINTS)))) for r in crowd
    }
    groups = Groups(extra, prefix_bits, radius)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, values = groups.deal(batch.column(0).to_numpy().view(np.uint64))
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
            begins = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1)) if len(keys) else []
            bounds = [*begins, len(keys)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[begins].astype(np.int64)),
                    pa.array([values[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()),
                ],
                ["key", "fps"],
            )

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        held = np.concatenate([np.frombuffer(b.as_py(), np.uint64) for b in table.column("fps")])
        u, v = groups.links(key[0].as_py(), held)
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    dealt = fps.select("fp").mapInArrow(deal, "key long, fps binary")
    return dealt.groupBy("key").applyInArrow(meet, "u long, v long").distinct()


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """``(id, fp, component_id)`` of every row; component_id: least id that links reach."""
    signed = stage(fingerprints(docs, id_col, text_col), "simhash-fps")
    distinct = stage(signed.groupBy("fp").agg(F.min(id_col).alias("_least")), "simhash-distinct")
    roots = components(linked_fingerprints(distinct, max_bits))
    rooted = distinct.join(
        roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left"
    ).withColumn("component", F.coalesce("component", "fp"))
    rooted = stage(rooted.select("fp", "component", "_least"), "simhash-rooted")
    least = rooted.groupBy("component").agg(F.min("_least").alias("component_id"))
    labels = stage(
        rooted.join(least.hint("merge"), "component").select("fp", "component_id"), "simhash-labels"
    )
    return signed.join(labels.hint("merge"), "fp").select(id_col, "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the least id of each near-duplicate group, see :func:`keep_least`."""
    return keep_least(docs, simhash_components(docs, id_col, text_col), id_col)


def keep_least(docs: DataFrame, components: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the least id of each group of ``components(id, component_id)``; rows with a null id stay.

    Of rows that share a kept id the one with the least hash of its content stays.
    """
    grouped = stage(components.where(F.col(id_col).isNotNull()), "simhash-groups")
    gone = stage(grouped.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct(), "simhash-gone")
    kept = drop_ids(docs, gone, id_col)
    twice = stage(
        grouped.where(F.col(id_col) == F.col("component_id"))
        .groupBy(id_col).count().where("count > 1").select(id_col),
        "simhash-twice",
    )
    if twice.isEmpty():
        return kept
    least = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns))
    repeated = kept.join(twice, id_col, "left_semi").select(*docs.columns)
    one = repeated.groupBy(F.col(id_col).alias("_id")).agg(least.alias("_row")).select("_row.*")
    return drop_ids(kept, twice, id_col).unionByName(one.select(*docs.columns))
