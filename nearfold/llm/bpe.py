"""BPE encoding and decoding with word ends, in batched numpy merge rounds.

A text is cut at the special tokens, normalised (NFC, white space to one space,
lower case letter by letter) and split into words by the vocabulary's pattern. (Texts with characters newer than Python's Unicode tables are normalised
and split by the tokenizers library, whose tables are newer.) A word's UTF-8 bytes are its first symbols, the last one marked as a word's end.
The symbols of all words that are new to a batch lie in one flat array. In each
round every word merges its pair of lowest rank, at all places at once; ranks are
found by binary search over the sorted keys ``left * 2**16 + right``, and only
pairs beside a merge are looked up again. Words without a pair left leave the
array, so a round costs what is still open.

Two details keep this equal to merging one pair at a time. A pair is merged at
its first place only if what it makes takes part in a merge of lower rank (two
ways to the same token allow that). Runs of one symbol merge from the left. Words
are cut ahead of the rounds between bytes that stand side by side in no token:
no merge can cross there, so a word of any length costs little more than its parts.

Stretches between spaces, and the words they hold, are kept for the next batches, up to
``CACHE_WORDS`` stretches and ``CACHE_BYTES`` characters, then forgotten: the result does not
depend on it. New stretches are normalised and split together, joined by spaces, which
no word holds and which nothing composes with. Nothing is shuffled. The vocabulary is read from ``path`` once a Python worker; every
worker must be able to open it.

Defined cases: null and empty texts have no ids; a null list of ids decodes to
the empty text; ids outside the vocabulary add nothing; special tokens in a text
become their ids; repeated rows are encoded one by one; other columns stay as
they are, as these are column functions; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of text that are taken through the rounds at once (a longer text alone).
SLICE_CHARS = 1 << 20
CACHE_WORDS = 1 << 19
CACHE_BYTES = 1 << 23
_NONE = np.uint32(0xFFFFFFFF)
_SIGMA = "Σ"
_NO_IDS = np.empty(0, np.int32)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class _Index(dict):
    """Word to its number; words that were not there are listed as new."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Vocabulary:
    """Merges, tokens and splitting rule of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, ids = told["model"], told["model"]["vocab"]
        end = model["end_of_word_suffix"]
        self.tokens = [""] * (1 + max([*ids.values(), *(t["id"] for t in told["added_tokens"])]))
        for token, i in ids.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        self.specials = regex.compile(
            f"({'|'.join(map(regex.escape, sorted(self.special, key=len, reverse=True)))})"
        )
        split = next(p for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        #: Words, and the spaces between stretches.
        self.words = regex.compile(f"(?:{pattern})|\\x20")
        self.normalizer = tokenizers.Tokenizer.from_file(path).normalizer
        self.splitter = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern), "removed", True)
        letters = byte_letters()
        #: First symbols: a byte inside a word, and a byte at its end.
        self.inner = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + end] for c in letters], np.int32)
        self._read_merges(model["merges"], ids)

    def _read_merges(self, merges: list, ids: dict[str, int]) -> None:
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left, right, made = (
            np.array(x, np.uint32) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in pairs), strict=True)
        )
        keys = (left << np.uint32(16)) | right
        # Should a pair be listed twice, the later entry holds.
        keys, ranks = np.unique(keys[::-1], return_index=True)
        ranks = (len(made) - 1 - ranks).astype(np.uint32)
        self.keys, self.ranks, self.made = keys, ranks, made.astype(np.int32)
        # Rank of the first merge that takes the token a merge makes.
        first = np.full(len(self.tokens), len(made), np.int64)
        np.minimum.at(first, left, np.arange(len(made)))
        np.minimum.at(first, right, np.arange(len(made)))
        self.alone = first[made] < np.arange(len(made))
        # Neighbours inside tokens: the last symbol of the left part beside the first of the right.
        head, tail = np.arange(len(self.tokens)), np.arange(len(self.tokens))
        self.side = np.zeros((512, 512), bool)
        symbol = np.full(len(self.tokens), -1)
        symbol[self.inner], symbol[self.last] = np.arange(256), np.arange(256, 512)
        for a, b, c in zip(left.tolist(), right.tolist(), made.tolist(), strict=True):
            head[c], tail[c] = head[a], tail[b]
            self.side[symbol[tail[a]], symbol[head[b]]] = True

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of many words, and the word of each, after all merges."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbols), _NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.pair_ranks(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.concatenate(([0], np.flatnonzero(word[1:] != word[:-1]) + 1))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
            open_ = least != _NONE
            if not open_.all():
                done.append((word[~open_], symbols[~open_]))
                symbols, word, rank, least = symbols[open_], word[open_], rank[open_], least[open_]
                if not len(symbols):
                    break
            hit = rank == least
            place = np.arange(len(symbols))
            begins = hit & ~np.concatenate(([False], hit[:-1]))
            run = np.maximum.accumulate(np.where(begins, place, 0))
            at = np.flatnonzero(hit & ((place - run) % 2 == 0))
            first = np.concatenate(([True], word[at][1:] != word[at][:-1]))
            at = at[first | ~self.alone[rank[at]]]
            symbols[at] = self.made[rank[at]]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            # What stood right of the pair now follows the token it made.
            rank[at] = rank[at + 1]
            symbols, word, rank = symbols[kept], word[kept], rank[kept]
            moved = at - np.arange(len(at))
            beside = np.zeros(len(symbols) + 1, bool)  # the last place takes what is left of the first symbol
            beside[moved] = beside[moved - 1] = True
            near = np.flatnonzero(beside[: len(symbols) - 1])
            near = near[word[near] == word[near + 1]]
            rank[near] = self.pair_ranks(symbols[near], symbols[near + 1])
        if not done:
            return symbols, word
        word = np.concatenate([w for w, _ in done])
        order = np.argsort(word, kind="stable")
        return np.concatenate([s for _, s in done])[order], word[order]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids in a row."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(sizes) - 1
        symbol = data.astype(np.int64)
        symbol[ends] += 256
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.side[symbol[:-1], symbol[1:]]
        cut[ends[:-1] + 1] = True
        part = np.cumsum(cut) - 1
        first = np.concatenate((self.inner, self.last))[symbol]
        ids, part_of = self.merge(first, part)
        word_of_part = np.repeat(np.arange(len(raw)), sizes)[np.flatnonzero(cut)]
        return np.bincount(word_of_part[part_of], minlength=len(raw)), ids

    def split(self, stretches: list[str]) -> list[str]:
        """Words of the normalised stretches, with a space between two stretches."""
        text = " ".join(stretches)
        if text.isascii():
            return self.words.findall(text.lower())
        if any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Characters newer than these tables: the library's own tables decide what they are.
            found = []
            for stretch in stretches:
                found.append(" ")
                found.extend(w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(stretch)))
            return found[1:]
        return self.words.findall(normalised(text))


def normalised(text: str) -> str:
    """NFC and lower case of each character by itself; white space, which is in no word, stays."""
    text = unicodedata.normalize("NFC", text)
    # Lower case of a whole text writes a capital sigma at a word's end in another way.
    return "σ".join(part.lower() for part in text.split(_SIGMA))


class _Lists:
    """Lists of ids by number, in one flat array."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts = ids, counts
        self.begins = np.cumsum(counts) - counts

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        begins = np.cumsum(counts) - counts + len(self.ids)
        self.ids = np.concatenate((self.ids, ids))
        self.counts = np.concatenate((self.counts, counts))
        self.begins = np.concatenate((self.begins, begins))

    def take(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the wanted lists in a row, and how many each has."""
        sizes = self.counts[wanted]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[wanted] - ends + sizes, sizes)
        return self.ids[place], sizes


class Encoder:
    """A vocabulary and the stretches between spaces that it has encoded lately."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.token_texts = pa.array(self.vocabulary.tokens, pa.string())
        self._forget()

    def _forget(self) -> None:
        """Only the special tokens are known, each as a stretch of its own."""
        self.index, self.words, self.held = _Index(), _Index(), 0
        for special in self.vocabulary.special:
            self.index[special]
        self.index.new = []
        self.words[" "], self.words.new = 0, []
        self.word_ids = _Lists(_NO_IDS, np.zeros(1, np.int64))
        special = np.fromiter(self.vocabulary.special.values(), np.int32)
        self.stretch_ids = _Lists(special, np.ones(len(special), np.int64))

    def _take(self, stretches: list[str]) -> None:
        """Encodes ``stretches``, which the index has numbered in this order."""
        found = self.vocabulary.split(stretches)
        numbers = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        self.held += sum(map(len, stretches))
        new, self.words.new = self.words.new, []
        if new:
            lengths, ids = self.vocabulary.encode_words(new)
            self.word_ids.add(ids, lengths)
        ids, counts = self.word_ids.take(numbers)
        ends = np.concatenate(([0], np.cumsum(counts)))
        spaces = np.flatnonzero(numbers == 0)  # a space is word 0 and has no ids
        self.stretch_ids.add(ids, np.diff(ends[np.concatenate(([0], spaces, [len(numbers)]))]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids in a row."""
        if len(self.index) > CACHE_WORDS or self.held > CACHE_BYTES:
            self._forget()
        numbers: list[int] = []
        bounds = [0]
        for text in texts:
            for piece in self.vocabulary.specials.split(text) if "<|" in text else (text,):
                # A special token found in a text is known already; a stretch equal to one is one.
                numbers.extend(map(self.index.__getitem__, piece.split(" ")))
            bounds.append(len(numbers))
        new, self.index.new = self.index.new, []
        if new:
            self._take(new)
        ids, counts = self.stretch_ids.take(np.array(numbers, np.int64))
        ends = np.concatenate(([0], np.cumsum(counts)))
        return np.diff(ends[bounds]), ids


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in runs of about ``SLICE_CHARS`` characters; null as empty."""
    run, held = [], 0
    for text in texts:
        run.append(text.as_py() or "")
        held += len(run[-1])
        if held >= SLICE_CHARS:
            yield run
            run, held = [], 0
    if run:
        yield run


def bpe_encode(text: Column | str, path: str) -> Column:
    """``array<int>``: the ids of a text under the vocabulary at ``path``, without added special tokens."""

    @F.arrow_udf("array<int>")
    def encode_batch(texts: pa.Array) -> pa.Array:
        lengths, ids = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for run in slices(texts):
            counts, values = encoder(path).encode(run)
            lengths.append(counts)
            ids.append(values)
        ends = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))

    return encode_batch(F.col(text) if isinstance(text, str) else text)


def bpe_decode(ids: Column | str, path: str) -> Column:
    """The text of ids: their tokens joined by single spaces, special tokens included."""

    @F.arrow_udf("string")
    def decode_batch(lists: pa.Array) -> pa.Array:
        tokens = encoder(path).token_texts
        flat = lists.flatten()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        ids = pc.fill_null(flat, -1).to_numpy()
        known = (ids >= 0) & (ids < len(tokens))
        ends = np.concatenate(([0], np.cumsum(known)))[np.concatenate(([0], np.cumsum(sizes)))]
        kept = tokens.take(pa.array(ids[known]))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), kept), " ")

    return decode_batch(F.col(ids) if isinstance(ids, str) else ids)
