"""Small Spark helpers shared by the operators of this folder."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared scratch folder and read again.

    Cuts lineage where a table is used several times; every executor and the
    driver can read the copy, so a lost executor costs nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256):
    """Rows that are long (two whole sets each) go to Python so many at a time; for jobs that run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, held)


def estimated_bytes(df: DataFrame) -> int:
    """Input size as the optimizer sees it (file sizes for a scan); no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(df: DataFrame, bytes_per_bucket: int, at_least: int = 8) -> int:
    """How many hash buckets keep each one near bytes_per_bucket; grows with the input."""
    size = min(estimated_bytes(df), 1 << 62)
    return max(at_least, min(math.ceil(size / bytes_per_bucket), 1 << 22))


def row_key(id_col: str, text_col: str) -> Column:
    """Key of a row's (id, text). Rows with equal id and text share it and share their result."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def ship(df: DataFrame) -> None:
    """Give the executors' Python workers this package, once per Spark application.

    Spark's own file distribution carries it, so nothing has to be installed there.
    """
    sc = df.sparkSession.sparkContext
    if getattr(sc, "_package_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "stationlake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._package_shipped = True
