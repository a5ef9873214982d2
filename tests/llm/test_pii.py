import hashlib
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from nearfold.llm.pii import DAYS, FIRST_DAY, KEY, ROUNDS, feistel, luhn_sum, pseudonym, pseudonymize
from tests.llm.helpers import AWKWARD, awkward, table


def plain_feistel(left, right, a, b, tag, key=KEY):
    for i in range(ROUNDS):
        mix = lambda x, m: int(hashlib.sha256(f"{key}|{tag}|{i}|{x}".encode()).hexdigest()[:15], 16) % m  # noqa: B023, E731
        if i % 2 == 0:
            left = (left + mix(right, a)) % a
        else:
            right = (right + mix(left, b)) % b
    return left, right


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def card(digits):
    half = (len(digits) - 2) // 2
    rest = len(digits) - 2 - half
    left, right = plain_feistel(int(digits[1 : 1 + half]), int(digits[1 + half : -1]), 10**half, 10**rest, "card")
    body = f"{digits[0]}{left:0{half}d}{right:0{rest}d}"
    return body + str((10 - luhn(body + "0")) % 10)


def of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r.p for r in df.select(pseudonym(F.col("v")).alias("p")).collect()]


@pytest.mark.parametrize(("a", "b"), [(7, 5), (1, 30), (16, 16)])
def test_network_is_a_permutation(spark, a, b):
    df = spark.range(a * b).select(
        "id", feistel(F.floor(F.col("id") / b), F.col("id") % b, a, b, "k", "t").alias("s")
    )
    got = {r.id: (r.s.l, r.s.r) for r in df.collect()}
    assert len(set(got.values())) == a * b
    assert all(v == plain_feistel(i // b, i % b, a, b, "t", "k") for i, v in got.items())


def test_cards(spark):
    bodies = ["404189497460879", "433716659846439", "000000000000", "37828224631000", "411111111111111111"]
    cards = [b + str((10 - luhn(b + "0")) % 10) for b in bodies]
    got = of(spark, [*cards, "4041 8949 7460 8795", "4041-8949-7460-8795", "4041894974608796"])
    assert got[: len(cards)] == [card(c) for c in cards]
    assert all(luhn(g) == 0 and len(g) == len(c) for g, c in zip(got, cards, strict=False))
    assert got[-3].replace(" ", "") == got[-2].replace("-", "") == card("4041894974608795") and got[-1] is None
    assert spark.range(1).select(luhn_sum(F.lit("79927398713"))).head()[0] % 10 == 0


def test_dates_are_linked_valid_and_distinct(spark):
    first = date.fromisoformat(FIRST_DAY)
    days = [first + timedelta(n) for n in (0, 1, 36_000, 36_524, DAYS[0] * DAYS[1] - 1)]
    got = of(spark, [d.isoformat() for d in days])
    for day, text in zip(days, got, strict=True):
        n = (day - first).days
        left, right = plain_feistel(n // DAYS[1], n % DAYS[1], *DAYS, "date")
        assert text == (first + timedelta(left * DAYS[1] + right)).isoformat()
    same = of(spark, ["2000-02-29", "29.02.2000", "02/29/2000"])
    iso = date.fromisoformat(same[0])
    assert same[1:] == [f"{iso:%d.%m.%Y}", f"{iso:%m/%d/%Y}"]
    turned = of(spark, [f"{d}/05/1999" for d in range(13, 32)])
    assert len(set(turned)) == 19 and all(int(t[:2]) > 12 for t in turned)
    assert of(spark, ["2023-02-29", "1899-12-31", "2023-13-01", "0000-01-01", "31.04.2001"]) == [None] * 5


def test_phones_addresses_and_numbers(spark):
    got = of(spark, ["+1 (988) 555-2485", "988-555-2485", "10.0.0.1", "256.1.1.1", "01.2.3.4", "123-45-6789",
                     "000-12-3456", "A.b@example.com", "a.B@example.com"])
    area = int(got[0][4:7])
    assert got[0][:4] == "+1 (" and 200 <= area <= 999 and got[0][7:9] == ") "
    assert got[0][4:7] + got[0][9:] == got[1].replace("-", "", 1)
    number = (10 << 24) + 1
    left, right = plain_feistel(number >> 16, number & 65535, 65536, 65536, "ip")
    assert got[2] == f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}"
    assert got[3] is None and got[4] is None and got[6] is None
    number = (122 * 99 + 44) * 9999 + 6788
    left, right = plain_feistel(number // 9999, number % 9999, 898 * 99, 9999, "ssn")
    place = left // 99
    assert got[5] == f"{place + 1 + (place >= 665):03d}-{left % 99 + 1:02d}-{right + 1:04d}"
    assert got[7].split("@")[0] == got[8].split("@")[0] and got[7].endswith("@example.com")


def test_equal_values_stay_linked_across_documents(spark):
    docs = spark.createDataFrame(
        [(1, "card 4041894974608795, call +1 (988) 555-2485."), (2, "4041894974608795 and x4041894974608795"),
         (3, "1.2.3.4.5 and 12-31-1999-2000"), (4, "v1.2.3.4")], "doc_id long, text string",
    )
    rows = {r.doc_id: r for r in pseudonymize(docs).collect()}
    new = card("4041894974608795")
    assert new in rows[1].text and rows[2].text == f"{new} and x4041894974608795"
    assert rows[1].pii.card == 1 and rows[1].pii.phone == 1 and "555-2485" not in rows[1].text
    assert rows[3].text == "1.2.3.4.5 and 12-31-1999-2000" and rows[4].text == "v1.2.3.4"
    other = pseudonymize(docs, key="another").where("doc_id = 1").head().text
    assert other != rows[1].text


def test_only_personal_values_change(spark):
    import re

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    new = {r.doc_id: r for r in pseudonymize(docs).collect()}
    changed = 0
    for old in docs.collect():
        row = new[old.doc_id]
        strip = lambda t: re.sub(r"\S*[0-9@]\S*", "#", t)
        assert strip(old.text) == strip(row.text)
        changed += old.text != row.text
        for value in re.findall(r"\b[0-9]{16}\b|\S+@\S+\.com", old.text):
            assert value not in row.text or value.isdigit() and luhn(value)
    assert changed > 20


def test_very_long_runs(spark):
    """Patterns neither run out of stack nor of time on long texts of their own characters."""
    texts = ["a@b" + ".c" * 50_000, "1" * 200_000, "1.2." * 50_000, "x" * 200_000 + "@", "12-34-" * 30_000,
             "4041 8949 7460 8795 " * 5_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pseudonymize(docs).collect()}
    assert [rows[i].text == texts[i] for i in range(6)] == [False, True, True, True, True, False]
    assert rows[0].pii.email == 1 and rows[5].pii.card == 5_000


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = pseudonymize(docs)
    assert out.columns == [c for c in docs.columns if c != "pii"] + ["pii"]
    rows = out.collect()
    assert [r.text for r in rows] == [t for _, t, *_ in AWKWARD] and all(sum(r.pii) == 0 for r in rows)
    assert all(r._replaced == r._doc == r._text == "clash" for r in rows)
    assert pseudonymize(docs.limit(0)).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
