"""Collocations of every language by Toivonen's sampling method.

A phrase is two to five words side by side within a piece of text; it is a
candidate if it occurs ``least`` times or more in its language. A phrase cannot
be frequent unless the phrases without its first and without its last word are.

1. The sample (the documents whose row hash falls into one of ``SAMPLE`` parts)
   proposes all phrases with a lowered count.
2. The full pass counts, over all documents, every word, and every phrase whose
   two shorter parts are proposed: the proposed ones and their negative border.
   A phrase of the border that never occurs needs no count, so the border is
   never listed; it is met where it stands in a text.
3. Phrases that are frequent without having been proposed are failures of the
   border. If there are any, an expansion pass counts all phrases that were not
   counted and might be frequent: those whose two parts are frequent, or might be
   in their turn. That is the closure of the border, so nothing is left open after
   this one pass. Counts are exact and complete whatever the sample held.

Proposed and frequent phrases are each a bitmap of ``2**BITMAP_BITS`` bits indexed by phrase hash:
a fixed 8 MB, for any corpus. Phrases that share a bit with one of them may be
counted without need, and nothing else changes.

Texts are tokenised once into blocks of at most ``BLOCK_TOKENS`` words. A pass
hands on the distinct phrases of each block with their counts, split by hash; the
parts add them up over a tree of groups of at most ``FAN`` tables, so that a
phrase that every block holds is no hot key. A part remembers one block for each
phrase; that block names the words of the frequent ones at the end. Scores are
plain joins of the frequent phrases with their parts, in exact decimals.

Hashes have 61 bits; two phrases of the same length with equal hashes would share
their count (one chance in four that there is any such pair among 10^9 phrases).

Defined cases: null text counts as empty, a null language as ``und``; a text or
piece longer than a block goes on in the next one, no phrase is lost or counted
twice; repeated rows are counted one by one; ids are not needed; a language
without a candidate gives no row; an empty table gives an empty result; ties are
ordered by the phrase; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfold.llm.align import mixed, tree
from nearfold.llm.common import whole
from nearfold.llm.lm import large_counts, pack_array, small_counts, unpack_array
from nearfold.sources.scratch import release, stage

LEAST = 100
MOST_WORDS = 5
TOP = 2_000
#: Parts of a language's candidates that are ranked apart first.
RANK_PARTS = 256
#: One in so many documents is in the sample; phrases are proposed from this count on.
SAMPLE = 16
PROPOSED = 3
BITMAP_BITS = 26
BLOCK_TOKENS = 500_000
#: Phrases that all blocks together send to a part, and parts at least.
PART_KEYS = 1 << 22
LEAST_PARTS = 16
#: Tables added up at once; a part's tables of all blocks hold some ``PART_KEYS`` phrases together.
FAN = 1 << 14
#: What ends a piece of text.
ENDS = b".,;:!?\n\x0b\x0c\r"
#: No UTF-8 text holds this byte: it stands for the end of a piece.
_END = b"\xff"
_TO_END = bytes(0xFF if b in ENDS else b for b in range(256))
_WORD = np.uint64(0xD6E8FEB86659FD93)


class _Places(dict):
    """Word to the order of its first appearance; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _tokenise(block_tokens: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (row, sampled, lang, text) to blocks; texts that do not fit are cut, with overlap."""
    schema = pa.schema([
        ("block", pa.int64()), ("words", pa.binary()), ("tokens", pa.binary()), ("lengths", pa.list_(pa.int32())),
        ("own", pa.list_(pa.int32())), ("lang", pa.list_(pa.int32())), ("sampled", pa.list_(pa.bool_())),
        ("langs", pa.list_(pa.string())), ("n_words", pa.list_(pa.int64())),
    ])
    places, langs, parts, about, held, number = _Places({_END: 0}), {}, [], [], 0, None

    def block() -> pa.RecordBatch:
        lengths, own, lang, sampled = (list(x) for x in zip(*about, strict=True))
        words = np.zeros(len(langs), np.int64)
        for ids, n, i in zip(parts, own, lang, strict=True):
            words[i] += np.count_nonzero(ids[:n])
        row = {
            "block": number, "words": zstandard.compress(b" ".join(places), 1),
            "tokens": pack_array(np.concatenate(parts)), "lengths": lengths, "own": own, "lang": lang,
            "sampled": sampled, "langs": list(langs), "n_words": words.tolist(),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for row, sampled, lang, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            data = text.encode("utf-8", "surrogatepass").lower().translate(_TO_END)
            found, begin = data.replace(_END, b" \xff ").split(), 0
            while begin < len(found):
                # A block's number is that of a row whose text begins or goes on in it, and of its part.
                number = row * 4096 + begin // block_tokens % 4096 if number is None else number
                room = block_tokens - held
                taken = found[begin : begin + room + MOST_WORDS - 1]
                ids = np.fromiter(map(places.__getitem__, taken), np.int32, len(taken))
                parts.append(np.append(ids, np.int32(0)))
                own = min(room, len(taken))
                about.append((len(parts[-1]), own, langs.setdefault(lang, len(langs)), sampled))
                held += own
                begin += own
                if held >= block_tokens:
                    yield block()
                    places, langs, parts, about, held, number = _Places({_END: 0}), {}, [], [], 0, None
    if about:
        yield block()


class Block:
    """Words of some texts, and the hash of the phrase of each length that begins at each word."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.words = zstandard.decompress(row["words"]).split(b" ")
        self.langs = row["langs"]
        self.tokens = unpack_array(row["tokens"], np.int32)
        lengths = np.array(row["lengths"], np.int64)
        digest = xxhash.xxh3_64_intdigest
        hashes = np.fromiter(map(digest, self.words), np.uint64, len(self.words))[self.tokens]
        self.lang = np.repeat(np.array(row["lang"], np.int32), lengths)
        seeds = np.fromiter((digest(x, 1) for x in self.langs), np.uint64, len(self.langs))
        n = len(self.tokens)
        place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.own = place < np.repeat(np.array(row["own"], np.int64), lengths)
        self.sampled = np.repeat(np.array(row["sampled"], bool), lengths)
        ends = np.flatnonzero(self.tokens == 0)
        room = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
        rolling = mixed(hashes ^ seeds[self.lang])
        self.keys, self.fits = [], []
        for k in range(1, MOST_WORDS + 1):
            if k > 1:
                rolling = mixed(rolling * _WORD + np.concatenate((hashes[k - 1 :], hashes[: k - 1])))
            self.keys.append((rolling & ~np.uint64(7)) | np.uint64(k))
            self.fits.append(self.own & (room >= k))

    def phrase(self, at: int, k: int) -> str:
        return b" ".join(self.words[i] for i in self.tokens[at : at + k].tolist()).decode("utf-8", "replace")

    def both(self, k: int, bitmap: np.ndarray) -> np.ndarray:
        """Whether the phrases of ``k - 1`` words that make up the one of ``k`` words are in the bitmap."""
        held = in_bitmap(self.keys[k - 2], bitmap)
        return held & np.append(held[1:], False)

    def counted(self, proposed: np.ndarray | None, frequent: np.ndarray | None) -> np.ndarray:
        """Phrases to count in this pass, as often as they occur.

        Without bitmaps all of the sample; with the proposed phrases all words, and phrases
        whose parts are proposed. With the frequent ones of that pass too: what it did not
        count and might be frequent, as each part is frequent or not counted yet either.
        """
        chosen, possible = [], None
        for k in range(1, MOST_WORDS + 1):
            use = self.fits[k - 1]
            if proposed is None:
                use = use & self.sampled
            elif frequent is None:
                use = use if k == 1 else use & self.both(k, proposed)
            else:
                known = self.both(k, proposed) if k > 1 else np.ones(len(use), bool)
                held = in_bitmap(self.keys[k - 1], frequent)
                if k > 1:
                    open_ = possible & np.append(possible[1:], False)
                    use, held = use & open_ & ~known, np.where(known, held, open_)
                else:
                    use = use & ~known
                possible = held
            chosen.append(self.keys[k - 1][use])
        return np.concatenate(chosen)


def in_bitmap(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


COUNTS = "part int, block long, keys binary, counts binary, carriers binary"


def _sums(table: pa.Table) -> pa.Table:
    """Counts of the same phrase added up; its carrier is the least block that has it."""
    keys = [unpack_array(k.as_py(), np.uint64) for k in table.column("keys")]
    counts = [large_counts(c.as_py(), len(k)) for c, k in zip(table.column("counts"), keys, strict=True)]
    carriers = [
        np.full(len(k), b.as_py()) if c.as_py() is None else unpack_array(c.as_py(), np.int64)
        for k, c, b in zip(keys, table.column("carriers"), table.column("carrier"), strict=True)
    ]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, np.concatenate(carriers))
    return pa.table({
        "part": table.column("part")[:1], "block": table.column("block")[:1], "keys": [pack_array(distinct)],
        "counts": [small_counts(totals)], "carriers": [pack_array(least)], "carrier": pa.array([None], pa.int64()),
    })


class Miner:
    """The passes over the blocks of one corpus."""

    def __init__(self, blocks: DataFrame, least: int, fan: int):
        self.blocks, self.least, self.fan = blocks, least, fan
        self.spark: SparkSession = blocks.sparkSession
        size = blocks.agg(F.count(F.lit(1)), F.sum(F.expr("aggregate(own, 0L, (s, x) -> s + x)"))).head()
        self.n_blocks = size[0]
        wanted = max(LEAST_PARTS, -(-MOST_WORDS * (size[1] or 0) // PART_KEYS))
        self.part_bits = min(16, int(np.ceil(np.log2(wanted))))

    def count(self, least: int, *bitmaps: Broadcast) -> DataFrame:
        """One row a part with the phrases that a pass counts ``least`` times or more, staged."""
        shift = np.uint64(64 - self.part_bits)

        def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [np.frombuffer(b.value, np.uint8) for b in bitmaps]
            held += [None] * (2 - len(held))
            for batch in batches:
                for i in range(batch.num_rows):
                    block = Block(batch.slice(i, 1).to_pylist()[0])
                    keys, counts = np.unique(block.counted(*held), return_counts=True)
                    parts, begins = np.unique((keys >> shift).astype(np.int64), return_index=True)
                    ranges = [slice(x, y) for x, y in zip(begins, [*begins[1:], len(keys)], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(parts, pa.int32()), pa.array([block.number] * len(parts), pa.int64()),
                            pa.array([pack_array(keys[r]) for r in ranges], pa.binary()),
                            pa.array([small_counts(counts[r]) for r in ranges], pa.binary()),
                            pa.nulls(len(parts), pa.binary()), pa.array([block.number] * len(parts), pa.int64()),
                        ],
                        ["part", "block", "keys", "counts", "carriers", "carrier"],
                    )

        schema = f"{COUNTS}, carrier long"
        told = self.blocks.mapInArrow(tell, schema)
        summed = tree(told, self.n_blocks, _sums, schema, self.fan)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, packed, told, carried in zip(*batch.columns, strict=True):
                    keys = unpack_array(packed.as_py(), np.uint64)
                    counts = large_counts(told.as_py(), len(keys))
                    use = counts >= least
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part.as_py()], pa.int32()), pa.array([pack_array(keys[use])]),
                            pa.array([small_counts(counts[use])]),
                            pa.array([pack_array(unpack_array(carried.as_py(), np.int64)[use])]),
                        ],
                        ["part", "keys", "counts", "carriers"],
                    )

        kept = summed.select("part", "keys", "counts", "carriers")
        return stage(kept.mapInArrow(keep, "part int, keys binary, counts binary, carriers binary"), "phrase-counts")

    def bitmap(self, counts: DataFrame, known: Broadcast | None) -> tuple[Broadcast, int]:
        """The bits of the phrases of a pass.

        Also the number of those with less than ``MOST_WORDS`` words that are not ``known``. A part's
        hashes share their leading bits, so each part makes its own stretch of the bitmap.
        """
        part_bits, stretch = self.part_bits, 1 << (BITMAP_BITS - self.part_bits)

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, packed in zip(*batch.columns, strict=True):
                    keys = unpack_array(packed.as_py(), np.uint64)
                    bits = np.zeros(stretch, np.uint8)
                    at = (keys >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                    bits[at - (part.as_py() << (BITMAP_BITS - part_bits))] = 1
                    open_ = keys & np.uint64(7) < MOST_WORDS
                    if known is not None:
                        open_ &= ~in_bitmap(keys, np.frombuffer(known.value, np.uint8))
                    packed_bits = zstandard.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.as_py()], pa.int32()), pa.array([packed_bits]), pa.array([int(open_.sum())])],
                        ["part", "bits", "n"],
                    )

        made, total, size = np.zeros(1 << (BITMAP_BITS - 3), np.uint8), 0, stretch >> 3
        drawn = counts.select("part", "keys").mapInArrow(draw, "part int, bits binary, n long")
        # At most the bitmap itself.
        for part, bits, n in zip(*drawn.toArrow().columns, strict=True):
            begin = part.as_py() * size
            made[begin : begin + size] |= np.frombuffer(zstandard.decompress(bits.as_py()), np.uint8)
            total += n.as_py()
        return self.spark.sparkContext.broadcast(made.tobytes()), total

    def frequent(self, sample_least: int) -> list[DataFrame]:
        """Tables of counts in which every frequent word and phrase stands once."""
        sampled = self.count(sample_least)
        proposed, _ = self.bitmap(sampled, None)
        release(sampled)
        found = [self.count(self.least, proposed)]
        frequent, failures = self.bitmap(found[0], proposed)
        if failures:
            found.append(self.count(self.least, proposed, frequent))
        for bitmap in (proposed, frequent):
            bitmap.destroy()
        return found


def named(blocks: DataFrame, counts: list[DataFrame]) -> DataFrame:
    """``(lang, size, phrase, f)`` of every frequent word and phrase, staged.

    One block that holds a phrase is asked for its words.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, told, carried in zip(*batch.columns, strict=True):
                keys = unpack_array(packed.as_py(), np.uint64)
                f = large_counts(told.as_py(), len(keys))
                carrier = unpack_array(carried.as_py(), np.int64)
                order = np.argsort(carrier, kind="stable")
                asked, begins = np.unique(carrier[order], return_index=True)
                ranges = np.split(order, begins[1:])[: len(asked)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(asked, pa.int64()), pa.array([keys[r].tobytes() for r in ranges], pa.binary()),
                        pa.array([f[r].tobytes() for r in ranges], pa.binary()),
                    ],
                    ["block", "keys", "f"],
                )

    wanted = [
        c.select("keys", "counts", "carriers").mapInArrow(ask, "block long, keys binary, f binary") for c in counts
    ]
    asked = wanted[0]
    for more in wanted[1:]:
        asked = asked.unionByName(more)

    def name(mine: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"lang": [], "size": [], "phrase": [], "f": []}
        if asked.num_rows and mine.num_rows:
            keys, f = (
                np.concatenate([np.frombuffer(x.as_py(), t) for x in asked.column(c)])
                for c, t in (("keys", np.uint64), ("f", np.int64))
            )
            order = np.argsort(keys)
            keys, f = keys[order], f[order]
            block = Block(mine.to_pylist()[0])
            for k in range(1, MOST_WORDS + 1):
                at = np.flatnonzero(block.fits[k - 1])
                here = block.keys[k - 1][at]
                found = np.minimum(np.searchsorted(keys, here), len(keys) - 1)
                hit = np.flatnonzero(keys[found] == here)
                number, first = np.unique(found[hit], return_index=True)
                for i, place in zip(number.tolist(), at[hit][first].tolist(), strict=True):
                    out["lang"].append(block.langs[block.lang[place]])
                    out["size"].append(k)
                    out["phrase"].append(block.phrase(place, k))
                    out["f"].append(int(f[i]))
        schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])
        return pa.table(out, schema)

    met = blocks.groupBy("block").cogroup(asked.groupBy("block"))
    return stage(met.applyInArrow(name, "lang string, size int, phrase string, f long"), "phrases")


def _words(count: Column) -> Column:
    """The first words of a phrase, or with a negative count the last."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), count)


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of the candidates that no longer one makes needless.

    ``phrases(lang, size, phrase, f)`` holds all frequent words and phrases, ``totals(lang, n)``
    the words of each language.
    """
    candidates = phrases.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))
    # A phrase inside one as frequent is inside one that is longer by one word and as frequent.
    inner = F.explode(F.array(*[_words(sign * (F.col("size") - 1)) for sign in (1, -1)]))
    longer = candidates.where("size > 2").select("lang", inner.alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(longer.hint("merge"), ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer")
    cut = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", _words(F.col("k")).alias("left"),
        _words(F.col("k") - F.col("size")).alias("right"),
    )
    for side, count in (("left", "l"), ("right", "r")):
        part = phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
        cut = cut.join(part.hint("merge"), ["lang", side])
    # One row a language.
    cut = cut.join(F.broadcast(totals), "lang")
    score = F.expr("(cast(a as decimal(18,0)) * cast(n as decimal(15,0)) * 1000BD) div "
                   "(cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cut.groupBy("lang", "phrase", "a", "n").agg(least).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = LEAST,
    top: int = TOP,
    sample: int = SAMPLE,
    proposed: int = PROPOSED,
    block_tokens: int = BLOCK_TOKENS,
    fan: int = FAN,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` candidates of each language."""
    row = F.monotonically_increasing_id()
    rows = docs.select(
        row.alias("row"), (F.pmod(F.xxhash64(row), F.lit(sample)) == 0).alias("sampled"),
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), whole(text_col).alias("text"),
    )
    blocks = rows.mapInArrow(
        lambda batches: _tokenise(block_tokens, batches),
        "block long, words binary, tokens binary, lengths array<int>, own array<int>, lang array<int>, "
        "sampled array<boolean>, langs array<string>, n_words array<long>",
    )
    blocks = stage(blocks, "phrase-blocks")
    totals = blocks.select(F.explode(F.arrays_zip("langs", "n_words")).alias("x"))
    totals = totals.groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.n_words").alias("n"))
    miner = Miner(blocks, least, fan)
    counts = miner.frequent(proposed)
    phrases = named(blocks, counts)
    return first_of_each(scored(phrases, totals), top)


def first_of_each(found: DataFrame, top: int, parts: int = RANK_PARTS) -> DataFrame:
    """The first ``top`` rows of each language with their ranks.

    Ranked by part of the phrases' hashes first, so that no task sorts more of a
    language than a part, and at the end than ``top`` rows of each part.
    """
    order: list[Column] = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = found.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    within = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    first = dealt.withColumn("_within", within).where(F.col("_within") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
