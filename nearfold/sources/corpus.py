"""Corpus tables: loading, spreading over tasks, prefixes by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfold.sources.scratch import stage, stage_observed

BINS = 1024
# Rows of a file that an id has room for, as a power of two; 2**23 files remain.
ROW_BITS = 40
# Numbered file names are broadcast up to this many bytes in memory, at so many each.
BROADCAST_BYTES = 1 << 26
FILE_BYTES = 512


def spread(docs: DataFrame, partitions: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """Hash-repartition by id if the scan yields fewer splits than the cluster has slots.

    A large corpus has splits enough and is left alone: no shuffle of the texts.
    """
    wanted = partitions or docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(wanted, id_col) if docs.rdd.getNumPartitions() < wanted else docs


def load_corpus(
    spark: SparkSession,
    path: str,
    id_col: str | None = "doc_id",
    text_col: str = "text",
    fmt: str = "parquet",
    where: Column | None = None,
    **options: str,
) -> DataFrame:
    """``(doc_id BIGINT, text STRING)`` from files of any Spark format.

    ``where`` selects a subset by the source's own columns (a category, a
    language) and reaches the scan. Without an id column each row of Parquet files
    gets one from its file and its position in it (:func:`positioned`): the same
    on every read, under any filter or split size, and nothing is copied. Other
    formats know no positions; there ids come from split and order, and the
    result is staged, so that every later read sees the same ones.
    """
    raw = spark.read.format(fmt).options(**options).load(path)
    text = F.col(text_col).alias("text")
    if id_col is None and fmt == "parquet":
        return positioned(raw, text, where)
    if where is not None:
        raw = raw.where(where)
    if id_col is None:
        return stage(raw.select(F.monotonically_increasing_id().alias("doc_id"), text), "corpus")
    return raw.select(F.col(id_col).cast("bigint").alias("doc_id"), text)


def positioned(raw: DataFrame, text: Column, where: Column | None = None) -> DataFrame:
    """``(doc_id, text)`` of a Parquet scan: the file's number by name, then the row's place in the file.

    Files are numbered over the whole folder, whatever ``where`` leaves of them;
    only footers are read for it. A file added later leaves the ids of files of
    lesser names as they are.
    """
    files = raw.select(F.col("_metadata.file_path").alias("_file")).distinct()
    numbered = files.withColumn("_number", F.row_number().over(Window.orderBy("_file")) - 1)
    numbered, seen = stage_observed(numbered, "files")
    small = seen["rows"] * FILE_BYTES <= BROADCAST_BYTES
    rows = raw if where is None else raw.where(where)
    rows = rows.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"), text
    )
    rows = rows.join(F.broadcast(numbered) if small else numbered.hint("merge"), "_file")
    number = F.shiftleft(F.col("_number").cast("bigint"), ROW_BITS)
    return rows.select((number + F.col("_place")).alias("doc_id"), "text")


def prefix_cutoff(docs: DataFrame, n: int, id_col: str = "doc_id") -> int | None:
    """The n-th smallest id, or None if ``n`` is below 1 or there are no rows.

    Each pass counts ids in at most ``BINS`` equal ranges and narrows down to
    the range that holds the n-th; only that many counts reach the driver, and
    nothing is sorted. Dense ids need the first pass only.
    """
    ids = docs.select(F.col(id_col).alias("id"))
    lo, hi, count = ids.agg(F.min("id"), F.max("id"), F.count("id")).first()
    if n < 1 or not count:
        return None
    if n >= count:
        return hi
    if hi - lo + 1 == count and ids.where(f"id < {lo + n}").count() == n:
        return lo + n - 1
    while True:
        width = max(1, -(-(hi - lo + 1) // BINS))
        part = ids.where(F.col("id").between(lo, hi))
        bins = part.groupBy(F.expr(f"(id - {lo}) div {width}").alias("bin")).count()
        for number, size in sorted((row["bin"], row["count"]) for row in bins.collect()):
            if n <= size:
                break
            n -= size
        lo, hi = lo + number * width, min(hi, lo + (number + 1) * width - 1)
        if width == 1:
            return lo


def prefix_size(total: int, fraction: float) -> int:
    """Documents in a prefix of a fraction: rounded down, at least one."""
    return max(1, int(total * fraction))


def corpus_prefix(
    docs: DataFrame, n: int | None = None, fraction: float | None = None, id_col: str = "doc_id"
) -> DataFrame:
    """First ``n`` documents (or a fraction of all) by ascending id."""
    if (n is None) == (fraction is None):
        raise ValueError("give either n or fraction")
    if n is None:
        n = prefix_size(docs.count(), fraction)
    cutoff = prefix_cutoff(docs, n, id_col)
    return docs.where(F.lit(False) if cutoff is None else F.col(id_col) <= F.lit(cutoff))
