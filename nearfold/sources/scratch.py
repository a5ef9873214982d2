"""Materialised intermediate tables in the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Masters whose driver and tasks share one machine and one process.
ONE_PROCESS = re.compile(r"local(\[.*\])?")


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="nearfold-")


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    A session in one process (``local``, ``local[n]``) without the setting gets a
    temporary folder of its own, and its settings stay as they are. Elsewhere a
    machine-local folder would be lost with the machine, so there the setting is
    required; that a ``file:`` folder is shared (a network mount) only the user
    can know.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not ONE_PROCESS.fullmatch(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return it as a table scan.

    Later steps then read only the columns they need, know the size of what
    they read, and a lost executor costs no repeated upstream work.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/nearfold-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict[str, int]]:
    """:func:`stage`, and the rows (and other aggregates) seen while writing: no job of their own.

    A measure that saw no row is zero.
    """
    seen = Observation()
    counted = [F.count(F.lit(1)).alias("rows"), *(m.alias(k) for k, m in measures.items())]
    table = stage(df.observe(seen, *counted), name)
    return table, {name: seen.get.get(name) or 0 for name in ("rows", *measures)}


def release(*tables: DataFrame) -> None:
    """Remove the files of staged ``tables``. Nothing that reads them may run any more."""
    for table in tables:
        spark = table.sparkSession
        root = scratch_root(spark)
        folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
        for folder in folders:
            if "/nearfold-" in folder and root.split(":", 1)[-1].lstrip("/") in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
