"""Readable reports of a run: duplication audit and example pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.functions import python_fixed
from nearfold.operators.audit import dedup_audit, jaccard_histogram
from nearfold.operators.examples import top_class_pairs, top_pairs
from nearfold.params import Params
from nearfold.plans.near_duplicates import RunSummary, run_near_duplicates

# Rules of a block of the example report.
RULE = "=" * 70
INNER_RULE = "-" * 70


def corpus_audit(docs: DataFrame, params: Params | None = None) -> tuple[DataFrame, DataFrame, RunSummary]:
    """Audit row, histogram and the run behind them; copies are never expanded to pairs."""
    summary = run_near_duplicates(docs, params)
    compact = summary.run.compact
    return dedup_audit(compact, summary.num_docs), jaccard_histogram(compact), summary


def audit_report(audit: DataFrame, histogram: DataFrame, summary: RunSummary) -> DataFrame:
    """``(position, section, key, value)``: settings, results, seconds and histogram."""
    p = summary.run.params
    settings = [
        ("shingle size", p.k), ("signature length", p.num_hashes), ("bands", p.bands),
        ("rows per band", p.rows), ("threshold", p.threshold),
    ]
    results = audit.select(
        F.array(
            _entry("total documents", F.col("total_docs")),
            _entry("confirmed pairs", F.col("total_confirmed_pairs")),
            _entry("documents with a duplicate", F.col("docs_with_at_least_one_duplicate")),
            _entry("percent of documents", python_fixed("pct_docs_with_duplicate", 1)),
            _entry("mean jaccard", python_fixed("mean_jaccard_among_pairs", 4)),
        ).alias("entries")
    )
    spark = audit.sparkSession
    fixed = [("configuration", 0, i, key, str(value)) for i, (key, value) in enumerate(settings)]
    fixed += [
        ("seconds", 2, i, phase, f"{spent:.1f}")
        for i, (phase, spent) in enumerate(summary.seconds.items())
    ]
    schema = "section string, part int, place int, key string, value string"
    stated = spark.createDataFrame(fixed, schema)
    found = results.select(
        F.lit("results").alias("section"), F.lit(1).alias("part"),
        F.posexplode("entries").alias("place", "entry"),
    ).select("section", "part", "place", "entry.key", "entry.value")
    bars = histogram.select(
        F.lit("histogram").alias("section"), F.lit(3).alias("part"),
        F.round(F.col("lo") * 10).cast("int").alias("place"), F.col("bin").alias("key"),
        F.format_string("%d pairs (%s%%)", "pairs", python_fixed("pct", 1)).alias("value"),
    )
    rows = stated.unionByName(found).unionByName(bars)
    position = F.col("part") * 100 + F.col("place")
    return rows.select(position.alias("position"), "section", "key", "value")


def _entry(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))


def report_lines(report: DataFrame) -> DataFrame:
    """``(position, line)`` of an audit report, for the text sink."""
    return report.select("position", F.concat_ws(" | ", "section", "key", "value").alias("line"))


def example_lines(top: DataFrame) -> DataFrame:
    """``(position, line)``: a text block per row of :func:`top_pairs`."""

    def head(end: str) -> Column:
        return F.format_string("[Doc %d]", f"doc_{end}")

    title = F.format_string(
        "Rank #%d | Doc %d vs Doc %d | Jaccard = %s", "rank", "doc_a", "doc_b", "jaccard"
    )
    block = F.array(
        F.lit(RULE), title, F.lit(INNER_RULE), head("a"), F.col("excerpt_a"),
        F.lit(INNER_RULE), head("b"), F.col("excerpt_b"), F.lit(""),
    )
    lines = top.select("rank", F.posexplode(block).alias("place", "line"))
    return lines.select((F.col("rank") * 100 + F.col("place")).alias("position"), "line")


def example_header(summary: RunSummary, shown: int, corpus: str) -> DataFrame:
    """``(position, line)`` of what is known of the run, ahead of all blocks."""
    p = summary.run.params
    facts = {
        "corpus": corpus, "documents": summary.num_docs, "pairs": summary.num_confirmed, "shown": shown,
        "shingle size": p.k, "signature length": p.num_hashes, "bands": p.bands, "rows per band": p.rows,
        "threshold": p.threshold,
    }
    lines = [(i, f"{key}: {value}") for i, (key, value) in enumerate(facts.items())]
    return summary.run.docs.sparkSession.createDataFrame(lines, "position int, line string")


def example_report(
    docs: DataFrame,
    corpus: str,
    params: Params | None = None,
    n: int = 20,
    chars: int = 300,
) -> DataFrame:
    """``(position, line)`` of the whole example report, excerpts from the raw texts."""
    summary = run_near_duplicates(docs, params)
    best = top_class_pairs(summary.run.compact, summary.run.members, n)
    top = top_pairs(best, docs, n, chars)
    shown = min(n, summary.num_confirmed)
    return example_header(summary, shown, corpus).unionByName(example_lines(top))
