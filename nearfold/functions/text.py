"""Scalar text functions: normalisation and excerpts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(text: Column | str) -> Column:
    """Lower-case, keep ``a-z0-9``, turn every other run into one space, strip.

    NULL counts as the empty string. One regular expression does the work of
    replacing and collapsing, as both only ever produce single spaces.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def excerpt(text: Column | str, chars: int = 300) -> Column:
    """First ``chars`` characters on one line, with ``...`` if the text goes on."""
    text = F.col(text) if isinstance(text, str) else text
    head = F.replace(F.substring(text, 1, chars), F.lit("\n"), F.lit(" "))
    # \s in Java is ASCII only unless (?U) asks for Unicode white space.
    stripped = F.regexp_replace(head, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return F.concat(stripped, F.when(F.length(text) > chars, F.lit("...")).otherwise(F.lit("")))
