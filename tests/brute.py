"""The definitions in plain Python, for comparison on small inputs."""

import hashlib
import random
from itertools import combinations

PRIME = 2**61 - 1


def normalize(text):
    kept = [c if c.isascii() and c.isalnum() else " " for c in text.lower()]
    return " ".join("".join(kept).split())


def hash31(piece):
    return int.from_bytes(hashlib.md5(piece.encode()).digest()[:4], "little") & 0x7FFFFFFF


def shingles(text, k):
    if len(text) < k:
        return {hash31(text)}
    return {hash31(text[i : i + k]) for i in range(len(text) - k + 1)}


def family(n, seed=42):
    rng = random.Random(seed)
    return [(rng.randint(1, PRIME - 1), rng.randint(0, PRIME - 1)) for _ in range(n)]


def signature(items, n, seed=42):
    return [min(((a * x + b) % PRIME for x in items), default=PRIME) for a, b in family(n, seed)]


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def exact(sets, threshold):
    scored = {(i, j): jaccard(sets[i], sets[j]) for i, j in combinations(sorted(sets), 2)}
    return {pair: score for pair, score in scored.items() if score >= threshold}


def candidates(signatures, bands, rows):
    def share(s, t):
        return any(s[j * rows : (j + 1) * rows] == t[j * rows : (j + 1) * rows] for j in range(bands))

    ids = sorted(signatures)
    return {(i, j) for i, j in combinations(ids, 2) if share(signatures[i], signatures[j])}


def corpus(size=60, seed=7):
    """Random word texts with copies, near copies, empty and tiny texts."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(80)]
    texts = []
    while len(texts) < size:
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.45:
            old = rng.choice(texts).split() or ["x"]
            for _ in range(rng.randint(1, 6)):
                old[rng.randrange(len(old))] = rng.choice(words)
            texts.append(" ".join(old))
        elif kind < 0.52:
            texts.append(rng.choice(["", "ab", "abcd", "É!"]))
        else:
            texts.append(" ".join(rng.choices(words, k=rng.randint(5, 60))))
    return texts
