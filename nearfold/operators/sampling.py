"""Random document pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.sources.scratch import stage


def indexed_ids(docs: DataFrame) -> DataFrame:
    """``(idx, doc_id)``: ids numbered from 0 in ascending order.

    Ids are range-partitioned and numbered inside their partition; only one
    count per partition passes the driver.
    """
    ranged = docs.select("doc_id").repartitionByRange("doc_id")
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "ids")
    counts = ranged.groupBy("part").count().orderBy("part").collect()
    starts, at = [], 0
    for row in counts:
        starts.append((row["part"], at))
        at += row["count"]
    offsets = docs.sparkSession.createDataFrame(starts, "part int, start bigint")
    rank = F.expr("row_number() over (partition by part order by doc_id)")
    numbered = ranged.withColumn("rank", rank).join(F.broadcast(offsets), "part")
    return numbered.select((F.col("start") + F.col("rank") - 1).alias("idx"), "doc_id")


def draw(number: str, side: str, seed: int) -> Column:
    """60 random-looking bits as a function of the draw number, the side and the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.col(number).cast("string"), F.lit(f":{side}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def sample_pairs(docs: DataFrame, num_pairs: int, seed: int = 42) -> DataFrame:
    """``(draw, doc_a, doc_b)``: ordered pairs of different documents, with replacement.

    The second draw is over the other documents, so no draw is rejected and each
    row depends on its number only. Dense ids are used as they are; others get
    numbered first.
    """
    spark = docs.sparkSession
    low, high, total = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    if total < 2:
        raise ValueError("sampling pairs needs at least two documents")
    first = F.pmod(draw("draw", "a", seed), F.lit(total))
    second = F.pmod(draw("draw", "b", seed), F.lit(total - 1))
    drawn = spark.range(num_pairs).withColumnRenamed("id", "draw")
    drawn = drawn.select("draw", first.alias("i"), second.alias("other"))
    drawn = drawn.withColumn("j", F.col("other") + (F.col("other") >= F.col("i")).cast("int"))
    if high - low + 1 == total:
        return drawn.select(
            "draw", (F.col("i") + low).alias("doc_a"), (F.col("j") + low).alias("doc_b")
        )
    ids = indexed_ids(docs)
    a = ids.withColumnsRenamed({"idx": "i", "doc_id": "doc_a"})
    b = ids.withColumnsRenamed({"idx": "j", "doc_id": "doc_b"})
    return drawn.join(a, "i").join(b, "j").select("draw", "doc_a", "doc_b")
