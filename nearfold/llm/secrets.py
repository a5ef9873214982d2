"""Secrets in texts, told from copied examples by how many owners have them.

Patterns find candidates: values assigned to names like ``password``, access key
ids and long hexadecimal strings. Every candidate is hashed, and over the whole
corpus the distinct repositories and owners of each hash are counted. What many
owners have is a copied example; what belongs to few owners and looks random is
labelled live, and its value becomes a span of its own (kind ``live``).

Only Spark expressions are used. Matches and the pieces of text between them come
from the same pattern, so the running sum of their lengths gives the positions;
it is a window over the candidates of one text, not over texts. Texts are read
once; counting reads ids and hashes only and sums before it shuffles.

Positions are in code points, ends exclusive. Defined cases: null text counts as
empty; null owners and repositories count as one owner and one repository;
repeated rows are scanned one by one; an empty table gives an empty result; other
columns of the input are ignored by :func:`scan_secrets` and kept by
:func:`redact_secrets`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfold.llm.common import sized_hint, whole, woven
from nearfold.sources.scratch import stage

#: Pattern, group of the value, least length of the value.
PATTERNS = {
    "assign": (
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
KINDS = (*PATTERNS, "live")
#: At most so many owners have a live credential, and so many different characters it has at least.
MAX_OWNERS = 2
MIN_CHARACTERS = 6


def _found(kind: str, text: Column) -> Column:
    """Array of (kind, place, value, lengths of the match and of the piece before it) in ``text``."""
    pattern, group, _ = PATTERNS[kind]
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"),
    )
    pieces = F.split(text, pattern, -1)
    rows = F.transform(
        zipped,
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("place"), z["v"].alias("value"),
            F.length(z["m"]).alias("matched"), F.length(F.element_at(pieces, i + 1)).alias("before"),
        ),
    )
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast(
        "array<struct<kind:string,place:int,value:string,matched:int,before:int>>"))


def candidates(
    docs: DataFrame, id_col: str, text_col: str, owner: Column, repo: Column
) -> tuple[DataFrame, DataFrame]:
    """All rows as ``(_row, id)`` and their candidate spans with owner and repository, staged."""
    text = whole(text_col)
    scanned = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
        owner.alias("_owner"), repo.alias("_repo"),
        F.concat(*[_found(kind, text) for kind in PATTERNS]).alias("_found"),
    )
    scanned = stage(scanned, "secret-scan")
    rows = scanned.where(F.size("_found") > 0).select("_row", "_owner", "_repo", F.inline("_found"))
    so_far = Window.partitionBy("_row", "kind").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    end = F.sum(F.col("before") + F.col("matched")).over(so_far)
    least = F.create_map(*[F.lit(x) for kind, (_, _, n) in PATTERNS.items() for x in (kind, n)])
    spans = (
        rows.withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("matched"))
        .where(F.length("value") >= least[F.col("kind")])
    )
    # The hash stands for the value from here on; only the looks of the value go along.
    spans = spans.select(
        "_row", "_owner", "_repo", "kind", "start", "end",
        (F.col("end") - F.length("value")).alias("value_start"),
        F.sha2("value", 256).alias("value_hash"),
        (F.size(F.array_distinct(F.split("value", ""))) >= MIN_CHARACTERS).alias("varied"),
    )
    # A value before a closing quote ends where the match ends, so value_start needs no further search.
    return scanned.select("_row", "_id"), stage(spans, "secret-spans")


def ownership(spans: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """``(value_hash, owners, repos, copied)``: distinct owners and repositories of every hash."""
    unique = spans.select("value_hash", "_owner", "_repo").distinct()
    return unique.groupBy("value_hash").agg(
        F.count_distinct(F.struct("_owner")).alias("owners"),
        F.count_distinct(F.struct("_owner", "_repo")).alias("repos"),
    ).withColumn("copied", F.col("owners") > max_owners)


def _labelled(spans: DataFrame, max_owners: int) -> DataFrame:
    counts = stage(ownership(spans, max_owners), "secret-owners")
    return spans.join(counts.hint("merge"), "value_hash").withColumn(
        "live", ~F.col("copied") & F.col("varied")
    )


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repo: Column | None = None,
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """``(id, found)`` of every row; found: sorted array of (start, rank, kind, end, owners, repos).

    ``rank`` is the place of the kind in ``KINDS``; owners and repos are of the value found.
    """
    rows, spans = candidates(docs, id_col, text_col, *_columns(owner, repo))
    labelled = _labelled(spans, max_owners)

    def span(kind: Column, start: str) -> Column:
        ranks = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
        return F.struct(
            F.col(start).alias("start"), ranks[kind].alias("rank"), kind.alias("kind"),
            F.col("end"), F.col("owners"), F.col("repos"),
        )

    base = labelled.select("_row", span(F.col("kind"), "start").alias("s"))
    live = labelled.where("live").select("_row", span(F.lit("live"), "value_start").alias("s"))
    found = base.union(live).groupBy("_row").agg(F.array_sort(F.collect_set("s")).alias("found"))
    joined = rows.join(found.hint("merge"), "_row", "left")
    empty = F.array().cast(found.schema["found"].dataType)
    return joined.select(F.col("_id").alias(id_col), F.coalesce("found", empty).alias("found"))


def _columns(owner: Column | None, repo: Column | None) -> tuple[Column, Column]:
    """By default the source is the owner and its part in one language the repository."""
    return (
        F.col("source") if owner is None else owner,
        F.concat_ws("/", "source", "lang") if repo is None else repo,
    )


def spans_text(found: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _hide(text: Column, pattern: str, group: int, mark: str) -> Column:
    """``text`` with ``mark`` for the values of ``pattern`` whose hash is in the column ``_live``."""
    matches = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"),
    )
    name = lambda z: F.substring(z["m"], F.lit(1), F.length(z["m"]) - F.length(z["v"]))
    hidden = F.transform(
        matches,
        lambda z: F.when(
            F.array_contains(F.col("_live"), F.sha2(z["v"], 256)), F.concat(name(z), F.lit(mark))
        ).otherwise(z["m"]),
    )
    return woven(F.split(text, pattern, -1), hidden)


def redact_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = "n_chars",
    mark: str = "[SECRET]",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """``docs`` with every value that is live replaced by ``mark`` wherever a pattern finds it.

    The live values of a text are looked up by the id of its row; rows that share
    an id share their values, and so do all rows with a null id. Texts with no live value are not touched or moved:
    the ids of the others are broadcast if they are few.
    """
    rows, spans = candidates(docs, id_col, text_col, *_columns(None, None))
    live = _labelled(spans, max_owners).where("live").select("_row", "value_hash").distinct()
    hashes = live.join(rows.hint("merge"), "_row").groupBy(F.col("_id").alias("_secret_id")).agg(F.collect_set("value_hash").alias("_live"))
    hashes = stage(hashes, "secret-live")
    # The row travels as one struct, so that no column of it can clash with ours.
    joined = docs.select(F.struct("*").alias("_doc"), F.col(text_col).alias("_text")).join(
        sized_hint(hashes), F.col(f"_doc.{id_col}").eqNullSafe(F.col("_secret_id")), "left"
    )
    touched = F.col("_live").isNotNull()
    for pattern, group, _ in PATTERNS.values():
        hidden = touched & F.col("_text").rlike(pattern)
        joined = joined.withColumn(
            "_text", F.when(hidden, _hide(F.col("_text"), pattern, group, mark)).otherwise(F.col("_text"))
        )
    changed = {text_col: F.col("_text")}
    if length_col and length_col in docs.columns:
        length = F.length("_text").cast(docs.schema[length_col].dataType)
        changed[length_col] = F.when(touched, length).otherwise(F.col(f"_doc.{length_col}"))
    return joined.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
