import re
from collections import Counter, defaultdict

import pytest

from nearfold.llm import collocations as c
from nearfold.llm.collocations import collocations
from tests.llm.helpers import awkward, table

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(rows, least, top=2_000):
    """Every definition word for word, in Python's exact integers."""
    counts, totals = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        needless = set()
        for longer, a in candidates.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    if 100 * a >= 100 * candidates[longer[i : i + k]]:
                        needless.add(longer[i : i + k])
        scores = []
        for p, a in candidates.items():
            if p not in needless:
                cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scores.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scores)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mine(docs, **settings):
    return sorted(tuple(r) for r in collocations(docs, **settings).select(*COLUMNS).collect())


@pytest.mark.parametrize(
    "settings",
    [
        {"sample": 1, "proposed": 1},  # everything proposed: no failure
        {"sample": 10**9},  # nothing proposed: all by the expansion pass
        {"sample": 4, "proposed": 2, "block_tokens": 9_000, "fan": 3},
    ],
)
def test_whole_table_equals_plain(spark, sf_small, settings):
    docs = table(spark, sf_small, "documents")
    want = plain([(r.lang, r.text) for r in docs.collect()], 8)
    assert len(want) > 100 and mine(docs.repartition(3), least=8, **settings) == want


def test_top_and_crowded_bitmap(spark, sf_small, monkeypatch):
    """Phrases that share a bit are counted without need, and the result is the same."""
    monkeypatch.setattr(c, "BITMAP_BITS", 8)
    docs = table(spark, sf_small, "documents")
    want = plain([(r.lang, r.text) for r in docs.collect()], 8, top=20)
    assert mine(docs, least=8, top=20) == want


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert mine(docs, least=2) == plain([(r.lang, r.text) for r in docs.collect()], 2)
    short = docs.where("text is null or length(text) < 1000")
    assert mine(short, least=1, block_tokens=7, fan=2) == plain([(r.lang, r.text) for r in short.collect()], 1)
    assert collocations(docs.limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    a = 4_000_000_000
    phrases = spark.createDataFrame(
        [("en", 1, "x", a), ("en", 1, "y", a + 1), ("en", 2, "x y", a - 7)],
        "lang string, size int, phrase string, f long",
    )
    totals = spark.createDataFrame([("en", 90_000_000_000)], "lang string, n long")
    row = c.scored(phrases, totals).first()
    assert row.score == 1000 * (a - 7) * 90_000_000_000 // (a * (a + 1))


def test_order_of_ties_is_by_utf8_bytes(spark):
    docs = spark.createDataFrame([("en", "ü b. z b. 🙂 b. ￿ b")], "lang string, text string")
    got = [r.phrase for r in collocations(docs, least=1).orderBy("rank").collect()]
    assert got == sorted(got, key=lambda p: p.encode())


def test_rank_by_parts(spark):
    """Ties at the cut, one language with most rows, one with fewer than ``top``."""
    from nearfold.llm.collocations import first_of_each

    rows = [("en", f"p{n}", 100 + n % 3, 1, 1, 1, n % 7) for n in range(500)] + [("fr", "x y", 100, 1, 1, 1, 2)]
    found = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    got = {(r.lang, r.rank, r.phrase) for r in first_of_each(found, 40, 8).collect()}
    expected = set()
    for lang in ("en", "fr"):
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        expected |= {(lang, n + 1, r[1]) for n, r in enumerate(mine[:40])}
    assert got == expected
    assert first_of_each(found.limit(0), 40).count() == 0
