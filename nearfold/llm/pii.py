"""Format-preserving pseudonyms of personal numbers and dates.

Card numbers, telephone numbers, social security numbers, IPv4 addresses and
dates are found, validated (check digit, ranges, calendar) and numbered within
the set of all valid values of their format. A keyed Feistel network permutes
that number, and the permuted number is written in the same format. So equal
values get equal pseudonyms in every document, different values different ones,
and a pseudonym is again a valid value. What fails validation stays as it is.

Addresses of electronic mail are no numbers; their local part is replaced by a
keyed digest, so that they stay linked too.

Only Spark expressions are used; the plan is one narrow pass without a shuffle.
The network mixes two halves of sizes A and B, one after the other, modulo their
own size, which is a permutation of 0 .. A*B-1 for any A and B. Its round
function is SHA-256 over key, format, round and the other half. Where only some
of the numbers of a format are valid, the network is repeated until it hits one.

The key is a parameter; without it pseudonyms cannot be computed or undone.
Defined cases: null text stays null, empty text empty; equal rows get equal
results; other columns are kept, an empty table gives an empty result. Values
are taken left to right; digits glued to letters or to longer numbers are none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.llm.common import woven

KEY = "an example key; pass your own"
ROUNDS = 10

_LEFT, _RIGHT = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: The formats. Repetition is bounded or possessive, so that scanning is linear.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,20}+",
    "card": _LEFT
    + r"(?:[0-9]{13,19}|[0-9]{4}(?<s>[ -])[0-9]{4}\k<s>[0-9]{4}\k<s>[0-9]{4}"
    + r"|[0-9]{4}(?<t>[ -])[0-9]{6}\k<t>[0-9]{5})"
    + _RIGHT,
    "ssn": _LEFT + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _RIGHT,
    "phone": _LEFT
    + r"(?<![0-9][.-])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}"
    + _RIGHT,
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}" + _RIGHT + r"(?!\.[0-9])",
    "date": _LEFT
    + r"(?<![0-9][./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
    + _RIGHT + r"(?![./-][0-9])",
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS.values())
#: Nothing personal is without one of these; most texts are passed by at once.
HINT = "[0-9]{2}|[0-9][.][0-9]|@"

#: Dates that count as personal: 256 * 288 days from here on.
FIRST_DAY = "1900-01-01"
DAYS = (256, 288)


def feistel(left: Column, right: Column, a: Column | int, b: Column | int, key: str, tag: str) -> Column:
    """Keyed permutation of the pairs (l, r) with 0 <= l < a and 0 <= r < b, as a struct."""

    def mix(i: Column, other: Column, modulus: Column | int) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), i.cast("string"), other.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % modulus

    def step(s: Column, i: Column) -> Column:
        return F.struct(
            F.when(i % 2 == 0, (s["l"] + mix(i, s["r"], a)) % a).otherwise(s["l"]).alias("l"),
            F.when(i % 2 == 1, (s["r"] + mix(i, s["l"], b)) % b).otherwise(s["r"]).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _permuted(number: Column, a: int, b: int, key: str, tag: str, use: Callable[[Column], Column]) -> Column:
    """``use`` of the permuted ``number`` below ``a * b`` (under 2^53, so the division is exact)."""
    halves = lambda n: feistel(F.floor(n / b), n % b, a, b, key, tag)
    return _with(_with(number, halves), lambda s: use(s["l"] * b + s["r"]))


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second doubled, beginning before the last place."""
    places = F.sequence(F.lit(1), F.length(digits))
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(turned, i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(places, F.lit(0), add)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _part(value: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(value, pattern, group)


def _card(value: Column, key: str) -> Column:
    """First digit, length and separators stay; the check digit is made anew."""
    powers = F.array(*[F.lit(10**n) for n in range(10)])

    def permute(d: Column) -> Column:
        free = F.length(d) - 2
        left = F.floor(free / 2).cast("int")
        right = free - left
        halves = feistel(
            F.substring(d, F.lit(2), left), F.substring(d, left + 2, right),
            F.element_at(powers, left + 1), F.element_at(powers, right + 1), key, "card",
        )
        body = lambda s: F.concat(
            F.substring(d, 1, 1), F.lpad(s["l"].cast("string"), left, F.lit("0")),
            F.lpad(s["r"].cast("string"), right, F.lit("0")),
        )
        checked = lambda x: F.concat(
            x, ((10 - luhn_sum(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")
        )
        return _with(_with(halves, body), checked)

    gap = F.substring(value, 5, 1)
    grouped = lambda n: (
        F.when(~value.rlike("[ -]"), n)
        .when(F.length(n) == 16, _joined(gap, n, (4, 4, 4, 4)))
        .otherwise(_joined(gap, n, (4, 6, 5)))
    )
    return _with(
        _digits(value),
        lambda d: F.when(
            F.length(d).between(13, 19) & (luhn_sum(d) % 10 == 0), _with(permute(d), grouped)
        ),
    )


def _joined(gap: Column, digits: Column, widths: tuple[int, ...]) -> Column:
    parts, at = [], 1
    for width in widths:
        parts += [gap, F.substring(digits, at, width)]
        at += width
    return F.concat(*parts[1:])


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("long").cast("string"), width, "0")


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, p, n).cast("long") for p, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    number = ((F.when(area < 666, area - 1).otherwise(area - 2)) * 99 + group - 1) * 9999 + serial - 1

    def write(n: Column) -> Column:
        place = F.floor(n / (99 * 9999))
        return F.concat_ws(
            "-", _padded(F.when(place < 665, place + 1).otherwise(place + 2), 3),
            _padded(F.floor(n / 9999) % 99 + 1, 2), _padded(n % 9999 + 1, 4),
        )

    return F.when(valid, _permuted(number, 898 * 99, 9999, key, "ssn", write))


_PHONE = r"^(\+?1?[ .-]?\(?)([2-9][0-9]{2})(\)? ?[.-]?)([2-9][0-9]{2})([ .-])([0-9]{4})$"


def _phone(value: Column, key: str) -> Column:
    part = lambda i: _part(value, _PHONE, i)
    number = ((part(2).cast("long") - 200) * 800 + part(4).cast("long") - 200) * 10000 + part(6).cast("long")

    def write(n: Column) -> Column:
        return F.concat(
            part(1), _padded(F.floor(n / 8_000_000) + 200, 3), part(3),
            _padded(F.floor(n / 10_000) % 800 + 200, 3), part(5), _padded(n % 10_000, 4),
        )

    return F.when(value.rlike(_PHONE), _permuted(number, 80_000, 80_000, key, "phone", write))


def _ip(value: Column, key: str) -> Column:
    octet = [_part(value, r"^([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)$", i).cast("long") for i in (1, 2, 3, 4)]
    valid = (F.greatest(*octet) <= 255) & ~value.rlike(r"(?:^|\.)0[0-9]")
    number = ((octet[0] * 256 + octet[1]) * 256 + octet[2]) * 256 + octet[3]
    write = lambda n: F.concat_ws(".", *[
        (F.floor(n / 256**i) % 256).cast("long").cast("string") for i in (3, 2, 1, 0)
    ])
    return F.when(valid, _permuted(number, 1 << 16, 1 << 16, key, "ip", write))


def _date(value: Column, key: str) -> Column:
    """ISO, d.m.y and m/d/y; with slashes and a first part over 12 it is d/m/y, and stays so."""
    iso, dotted = value.rlike("^[0-9]{4}-"), value.rlike("[.]")
    head, middle = F.substring(value, 1, 2).cast("int"), F.substring(value, 4, 2).cast("int")
    day_first = dotted | (head > 12)
    year = F.when(iso, F.substring(value, 1, 4)).otherwise(F.substring(value, 7, 4)).cast("int")
    month = (
        F.when(iso, F.substring(value, 6, 2).cast("int")).when(day_first, middle).otherwise(head)
    )
    day = F.when(iso, F.substring(value, 9, 2).cast("int")).when(day_first, head).otherwise(middle)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = (
        F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    )
    real = (month >= 1) & (month <= 12) & (day >= 1) & (day <= last) & (year >= 1)
    first = F.to_date(F.lit(FIRST_DAY))
    number = F.datediff(F.when(real, F.make_date(year, month, day)), first).cast("long")
    a, b = DAYS
    again = ~iso & ~dotted & (head > 12)
    once = lambda n: _permuted(n, a, b, key, "date", lambda x: x)
    stays = lambda n: ~again | (F.dayofmonth(F.date_add(first, n.cast("int"))) > 12)
    # Two dates in five have no day over 12: 64 further rounds leave none of them.
    walked = lambda n: F.aggregate(
        F.sequence(F.lit(1), F.lit(64)), once(n), lambda x, _: F.when(stays(x), x).otherwise(once(x))
    )

    def shown(n: Column) -> Column:
        date = F.date_add(first, n.cast("int"))
        return (
            F.when(iso, F.date_format(date, "yyyy-MM-dd"))
            .when(dotted, F.date_format(date, "dd.MM.yyyy"))
            .when(again, F.date_format(date, "dd/MM/yyyy"))
            .otherwise(F.date_format(date, "MM/dd/yyyy"))
        )

    return _with(number, lambda n: F.when((n >= 0) & (n < a * b), _with(walked(n), shown)))


def _email(value: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@"), F.substring_index(value, "@", -1))


def kind_of(value: Column) -> Column:
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), "ip")
        .when(value.rlike(r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})$"), "date")
        .when(value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(F.length(_digits(value)) >= 13, "card")
        .otherwise("phone")
    )


def pseudonym(value: Column, key: str = KEY) -> Column:
    """What stands for a match of ``ANY``; null if it is not valid."""
    makers = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}
    kind = kind_of(value)
    chosen = F.when(F.lit(False), F.lit(""))
    for name, make in makers.items():
        chosen = chosen.when(kind == name, make(value, key))
    return chosen


def pseudonymize(
    docs: DataFrame, key: str = KEY, text_col: str = "text", found_col: str = "pii"
) -> DataFrame:
    """``docs`` with pseudonyms in the text and the number of values of each kind in ``found_col``.

    A column that has the name ``found_col`` already is replaced.
    """
    text = F.col(text_col)
    likely = text.rlike(HINT) & text.rlike(ANY)
    replaced = F.transform(
        F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
        lambda m: F.struct(kind_of(m).alias("kind"), m.alias("old"), pseudonym(m, key).alias("new")),
    )
    none = F.array().cast("array<struct<kind:string,old:string,new:string>>")
    # The row travels as one struct, so that no column of it can clash with ours.
    out = docs.select(
        F.struct("*").alias("_doc"), text.alias("_text"), F.when(likely, replaced).otherwise(none).alias("_replaced")
    )
    count = lambda k: F.size(
        F.filter("_replaced", lambda r: (r["kind"] == k) & r["new"].isNotNull())
    )
    new = woven(F.split("_text", ANY, -1), F.transform("_replaced", lambda r: F.coalesce(r["new"], r["old"])))
    text = F.when(F.size("_replaced") > 0, new).otherwise(F.col("_text"))
    kept = [c for c in docs.columns if c != found_col]
    return out.select(
        *[(text if c == text_col else F.col(f"_doc.`{c}`")).alias(c) for c in kept],
        F.struct(*[count(k).alias(k) for k in KINDS]).alias(found_col),
    )
