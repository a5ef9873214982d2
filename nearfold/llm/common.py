"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfold.sources.scratch import stage

#: A list of ids is broadcast up to this many rows (16 bytes each in the hash table: 32 MB);
#: above it the join sorts and merges.
BROADCAST_IDS = 2_000_000
#: Tables with lists or texts are broadcast up to this many counted bytes.
BROADCAST_BYTES = 1 << 25


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(id_col: str = "doc_id") -> Column:
    """CRC-32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def whole(text_col: str = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(text_col), F.lit(""))


def woven(pieces: Column, matches: Column) -> Column:
    """Text made of the pieces between matches and what stands for the matches."""
    parts = F.zip_with(pieces, matches, lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))
    return F.array_join(F.flatten(parts), "")


def sized_hint(df: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``df`` hinted to broadcast if its counted rows stay under ``limit``, else to merge.

    ``df`` must be a staged table, so that counting it costs no work upstream.
    """
    return F.broadcast(df) if df.count() <= limit else df.hint("merge")


def byte_hint(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a staged table, hinted to broadcast if its counted bytes stay under ``limit``, else to merge."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(field.name)
        return 8 * F.size(field.name) if isinstance(field.dataType, T.ArrayType) else F.lit(0)

    each = sum((F.greatest(F.coalesce(width(f), F.lit(0)), F.lit(0)) + 16 for f in df.schema), F.lit(0))
    held = df.agg(F.sum(each.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if held <= limit else df.hint("merge")


def drop_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in the staged table ``ids``.

    The few ids that go are named, not the many that stay: up to
    ``BROADCAST_IDS`` of them the texts are not shuffled.
    """
    return docs.join(sized_hint(ids.select(id_col)), id_col, "left_anti").select(*docs.columns)


def globally_ranked(df: DataFrame, order: Sequence[str], name: str, rank: str = "g") -> DataFrame:
    """``df`` with the position ``rank`` of each row in the order of ``order``, from 0.

    One shuffle by range; the last column of ``order`` should tell equal rows
    apart, so that no run of ties lands in one task. Positions within a
    partition are written with the rows; the driver sees one count a partition.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = stage(placed, name)
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).count().collect()
    starts, total = [], 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        starts.append((row["_part"], total))
        total += row["count"]
    schema = T.StructType([T.StructField("_part", T.LongType()), T.StructField("_start", T.LongType())])
    bases = F.broadcast(df.sparkSession.createDataFrame(starts, schema))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(bases, "_part")
        .withColumn(rank, F.col("_start") + within)
        .drop("_part", "_start", "_at")
    )
