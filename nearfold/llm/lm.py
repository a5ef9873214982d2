"""Scores of a language model: a weighted backoff automaton over n-grams.

States are the histories seen in training, up to ``order - 1`` words, and the
empty one. From history h an arc of word x has the weight
``(1 - w) * c(hx) / c(h) + w * p(x | h')``, where h' is h without its first word;
a word without an arc takes the failure arc to h', whose weight is w. The
weights w depend on the order and on the size class of c(h) (its power of two)
and are those under which the training tokens, each left out in turn, are most
likely. At the empty history p(x) is (c + 0.1) / (N + 0.1 (V + 1)). For every
history the probabilities add up to one.

The model is as large as the corpus, so it is in no place as a whole. Documents
are tokenised into blocks of a bounded number of tokens. A block sends the hash
of each of its distinct n-grams once, with the number of times it trains on it,
to the part of the hash space it belongs to; that part adds up the blocks and
answers with the total counts in the order of the question. A block then holds
every state and arc its documents can visit, and one pass from left to right
carries the history along and adds up the logarithms (as array steps over all
positions of the block). A frequent n-gram is sent once a block, so there is no
hot key. Shuffled: some six bytes a distinct n-gram of a block, the answers of
about one, and the tokens once.

Hashes have 62 bits; two n-grams with equal hashes would share their counts
(a chance of 1 in 10^3 that there is any such pair among 10^8).

Tokens: lower-case A-Z, words between ASCII white space, then one end. Defined
cases: null text counts as empty (one token, the end); a text longer than a
block continues in the next one with its history; a null id counts as the empty
text for the training split; repeated rows are counted and scored one by one;
without any training text p(x) is uniform over the one unknown word; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.llm.common import whole
from nearfold.sources.scratch import release, stage

ORDER = 2
ADDED = 0.1
BLOCK_TOKENS = 600_000
PART_KEYS = 1 << 19
#: Failure weights that are tried, and size classes of histories.
GRID = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.995, 0.999])
CLASSES = 40
_MIX = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0x632BE59BD9B4E019)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def pack_array(values: np.ndarray) -> bytes:
    """Compressed byte by byte of the values: leading bytes hardly differ."""
    width = values.dtype.itemsize
    return zstandard.compress(values.view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def unpack_array(data: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def small_counts(counts: np.ndarray) -> bytes:
    """Counts as bytes, with those of 255 and more in full behind them."""
    low = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype(np.int64)
    return zstandard.compress(low.tobytes() + large.tobytes(), 1)


def large_counts(data: bytes, n: int) -> np.ndarray:
    raw = zstandard.decompress(data)
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, np.int64, offset=n)
    return counts


class _Places(dict):
    """Word to the order of its first appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


class Block:
    """Tokens of some documents as places in a list of word hashes; 0 is the end."""

    def __init__(self, tokens: np.ndarray, words: np.ndarray, lengths: np.ndarray,
                 context: np.ndarray, trains: np.ndarray, order: int):
        hashes = words[tokens]
        begins = np.cumsum(lengths) - lengths
        #: Place of each token in its segment, and of the segment in the block.
        self.at = np.arange(len(tokens), dtype=np.int32) - np.repeat(begins.astype(np.int32), lengths)
        self.segment = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.counted = self.at >= np.repeat(context, lengths)
        self.trained = self.counted & np.repeat(trains, lengths)
        keys, rolling = [], hashes
        self.where: list[np.ndarray] = []
        for n in range(1, order + 1):
            if n > 1:
                rolling = np.concatenate((rolling[:1], _mixed(rolling[:-1]) + hashes[1:]))
            place = np.flatnonzero(self.at >= n - 1).astype(np.int32)
            keys.append((_mixed(rolling[place] + np.uint64(n)) & ~np.uint64(3)) | np.uint64(n & 3))
            self.where.append(place)
        self.keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        self.inverse = inverse.astype(np.int32)

    def training_counts(self) -> np.ndarray:
        return np.bincount(
            self.inverse[self.trained[np.concatenate(self.where)]], minlength=len(self.keys)
        )

    def spread(self, counts: np.ndarray) -> list[np.ndarray]:
        """Counts of the n-gram that ends at each token, by order; 0 where there is none."""
        out, used = [], 0
        for place in self.where:
            here = np.zeros(len(self.at), counts.dtype)
            here[place] = counts[self.inverse[used : used + len(place)]]
            used += len(place)
            out.append(here)
        return out


def _classes(history: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(history)[1], CLASSES - 1)


def _history(counts: list[np.ndarray], at: np.ndarray, n: int) -> np.ndarray:
    """Count of the ``n - 1`` words before each token; 0 if there are not so many in its text."""
    before = np.concatenate(([0], counts[n - 2][:-1]))
    return np.where(at >= n - 1, before, 0)


def arc_weights(
    counts: list[np.ndarray], at: np.ndarray, total: int, vocabulary: int, weights: np.ndarray, upto: int
) -> np.ndarray:
    """Probability of each token by the histories of up to ``upto - 1`` words."""
    p = (counts[0] + ADDED) / (total + ADDED * (vocabulary + 1))
    for n in range(2, upto + 1):
        history = _history(counts, at, n)
        failure = weights[n, _classes(history)]
        share = np.divide(counts[n - 1], history, out=np.zeros(len(p)), where=history > 0)
        p = np.where(history > 0, (1 - failure) * share + failure * p, p)
    return p


def _tokenise(order: int, block_tokens: int, id_type: pa.DataType, batches: Iterator[pa.RecordBatch]):
    """Batches of (row, id, trains, text) to blocks of about ``block_tokens`` tokens."""
    schema = pa.schema([
        ("tokens", pa.binary()), ("words", pa.binary()), ("n_tokens", pa.int64()),
        ("n_trained", pa.int64()), ("rows", pa.list_(pa.int64())), ("ids", pa.list_(id_type)),
        ("trains", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())),
        ("context", pa.list_(pa.int32())),
    ])
    places, parts, held, about = None, [], 0, []

    def restart() -> None:
        nonlocal places, parts, held, about
        places, parts, held, about = _Places({b" ": 0}), [], 0, []

    def block() -> pa.RecordBatch:
        digest = xxhash.xxh3_64_intdigest
        words = np.fromiter((digest(w) for w in places), np.uint64, len(places))
        words[0] = _END
        rows, ids, trains, lengths, context = (list(x) for x in zip(*about, strict=True))
        trained = sum(n - c for n, c, t in zip(lengths, context, trains, strict=True) if t)
        row = {
            "tokens": pack_array(np.concatenate(parts)), "words": words.tobytes(), "n_tokens": held,
            "n_trained": trained, "rows": rows, "ids": ids, "trains": trains, "lengths": lengths,
            "context": context,
        }
        restart()
        return pa.RecordBatch.from_pylist([row], schema=schema)

    restart()
    for batch in batches:
        for row, key, trains, text in zip(*batch.columns, strict=True):
            words = text.as_py().encode("utf-8", "surrogatepass").lower().split()
            begin = 0
            while begin <= len(words):
                context = min(begin, order - 1)
                room = max(block_tokens - held, order + 1)
                taken = words[begin - context : begin + room]
                begin += room
                values = np.fromiter(map(places.__getitem__, taken), np.int32, len(taken))
                if begin > len(words):
                    values = np.append(values, np.int32(0))
                parts.append(values)
                held += len(values)
                about.append((row.as_py(), key.as_py(), trains.as_py(), len(values), context))
                if held >= block_tokens:
                    yield block()
    if about:
        yield block()


def _block(batch: pa.RecordBatch | pa.Table, i: int, order: int) -> Block:
    column = lambda name: batch.column(name)[i]
    return Block(
        unpack_array(column("tokens").as_py(), np.int32),
        np.frombuffer(column("words").as_py(), np.uint64),
        np.array(column("lengths").as_py(), np.int64), np.array(column("context").as_py(), np.int64),
        np.array(column("trains").as_py(), bool), order,
    )


def counted_blocks(
    docs: DataFrame, training: Column, order: int, id_col: str, text_col: str, block_tokens: int
) -> tuple[DataFrame, int, int]:
    """Blocks with the corpus counts of their n-grams, training tokens and distinct training words."""
    id_type = docs.select(id_col).limit(0).toArrow().schema.field(0).type
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        training.alias("trains"), whole(text_col).alias("text"),
    )
    simple = docs.schema[id_col].dataType.simpleString()
    blocks = rows.mapInArrow(
        lambda batches: _tokenise(order, block_tokens, id_type, batches),
        "tokens binary, words binary, n_tokens long, n_trained long, rows array<long>, "
        f"ids array<{simple}>, trains array<boolean>, lengths array<int>, context array<int>",
    )
    blocks = stage(blocks.withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    size = blocks.agg(F.sum("n_tokens"), F.sum("n_trained")).head()
    part_bits = max(4, int(np.ceil(np.log2(max(1, order * (size[0] or 0) / PART_KEYS)))))
    shift = np.uint64(64 - part_bits)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _block(batch, i, order)
                counts = block.training_counts()
                part = (block.keys >> shift).astype(np.int64)
                bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)] if len(part) else [0]
                ranges = [slice(a, b) for a, b in pairwise(bounds)]
                used = [int(part[r.start]) for r in ranges]
                yield pa.RecordBatch.from_pydict({
                    "part": used, "block": [batch.column("block")[i].as_py()] * len(used),
                    "keys": [pack_array(block.keys[r]) for r in ranges],
                    "counts": [small_counts(counts[r]) for r in ranges],
                })

    def add_up(table: pa.Table) -> pa.Table:
        keys = [unpack_array(k.as_py(), np.uint64) for k in table.column("keys")]
        counts = [
            large_counts(c.as_py(), len(k)) for c, k in zip(table.column("counts"), keys, strict=True)
        ]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
        words = int(((distinct & np.uint64(3) == 1) & (totals > 0)).sum())
        answers, used = [], 0
        for k in keys:
            answers.append(small_counts(totals[inverse[used : used + len(k)]]))
            used += len(k)
        return pa.table({
            "part": table.column("part"), "block": table.column("block"), "n": [len(k) for k in keys],
            "counts": answers, "n_words": [words] + [0] * (len(keys) - 1),
        })

    asked = blocks.mapInArrow(ask, "part long, block long, keys binary, counts binary")
    answered = asked.groupBy("part").applyInArrow(
        add_up, "part long, block long, n long, counts binary, n_words long"
    )
    answered = stage(answered, "lm-answers")
    vocabulary = answered.agg(F.sum("n_words")).head()[0] or 0
    gathered = answered.groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("part", "n", "counts"))).alias("answers")
    )
    joined = stage(blocks.join(gathered.hint("merge"), "block"), "lm-counted")
    release(blocks, answered)
    return joined, size[1] or 0, vocabulary


def _counts(batch: pa.RecordBatch, i: int, block: Block) -> list[np.ndarray]:
    answers = batch.column("answers")[i].as_py()
    counts = [large_counts(a["counts"], a["n"]) for a in answers]
    return block.spread(np.concatenate(counts) if counts else np.empty(0, np.int64))


def failure_weights(blocks: DataFrame, total: int, vocabulary: int, order: int) -> np.ndarray:
    """Weight of the failure arc by order and size class of the history."""
    weights = np.full((order + 1, CLASSES), 1.0)
    for n in range(2, order + 1):
        lower = weights.copy()

        def likelihoods(
            batches: Iterator[pa.RecordBatch], n: int = n, lower: np.ndarray = lower
        ) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((CLASSES, len(GRID)))
            for batch in batches:
                for i in range(batch.num_rows):
                    block = _block(batch, i, order)
                    counts = _counts(batch, i, block)
                    history = _history(counts, block.at, n)
                    use = block.trained & (history > 1)
                    left_out = [np.maximum(c[use] - 1, 0) for c in counts[: n - 1]]
                    # Below the order that is fitted histories keep their counts: only the token is left out.
                    p = (left_out[0] + ADDED) / (total + ADDED * (vocabulary + 1))
                    if n > 2:
                        p = arc_weights(counts, block.at, total, vocabulary, lower, n - 1)[use]
                    share = (counts[n - 1][use] - 1) / (history[use] - 1)
                    size_class = _classes(history[use])
                    del block, counts, history, left_out, use
                    for g, w in enumerate(GRID):
                        sums[:, g] += np.bincount(size_class, np.log((1 - w) * share + w * p), CLASSES)
            yield pa.RecordBatch.from_pydict({"size_class": np.arange(CLASSES), "sums": list(sums)})

        found = (
            blocks.mapInArrow(likelihoods, "size_class long, sums array<double>")
            .select("size_class", F.posexplode("sums").alias("g", "sum"))
            .groupBy("size_class", "g").agg(F.sum("sum").alias("sum"))
        ).toArrow()
        sums = np.zeros((CLASSES, len(GRID)))
        sums[found.column("size_class").to_numpy(), found.column("g").to_numpy()] = found.column("sum")
        best = GRID[sums.argmax(axis=1)]
        seen = sums.any(axis=1)
        # A history seen once cannot be left out: half way between its neighbour and certain failure.
        best[1] = (1 + best[2]) / 2 if seen[2] else 1.0
        seen[1] = True
        weights[n] = np.where(seen, best, best[np.maximum.accumulate(np.where(seen, np.arange(CLASSES), 1))])
    return weights


def score_documents(
    docs: DataFrame,
    training: Column,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)`` of every row, in log10."""
    blocks, total, vocabulary = counted_blocks(docs, training, order, id_col, text_col, block_tokens)
    weights = failure_weights(blocks, total, vocabulary, order)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _block(batch, i, order)
                counts = _counts(batch, i, block)
                n = len(batch.column("rows")[i])
                total_of = lambda x: np.bincount(
                    block.segment[block.counted], x[block.counted], n  # noqa: B023
                )
                base = np.log10(arc_weights(counts, block.at, total, vocabulary, weights, 1))
                full = np.log10(arc_weights(counts, block.at, total, vocabulary, weights, order))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rows")[i].values, batch.column("ids")[i].values,
                        pa.array(total_of(np.ones(len(base))).astype(np.int64)),
                        pa.array(total_of(counts[0] > 0).astype(np.int64)),
                        pa.array(total_of(base)), pa.array(total_of(full)),
                    ],
                    ["row", "id", "n_tokens", "n_known", "base_score", "score"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    scored = blocks.mapInArrow(
        score, f"row long, id {id_type}, n_tokens long, n_known long, base_score double, score double"
    )
    summed = scored.groupBy("row", F.col("id").alias(id_col)).agg(
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    )
    return summed.select(
        id_col, "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
