"""Table inspection: column profile (DESCRIBE), file facts, limited scans."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.session import scratch_path


def describe_table(df: DataFrame, partition_columns: list[str] | None = None, counts: bool = False) -> DataFrame:
    """One row per column: name, type, position and partition flag, from the schema alone (no job, no scan); with
    ``counts`` also the number of non-NULL values of each column (see ``column_profile``)."""
    if counts:
        return column_profile(df, partition_columns)
    parts = set(partition_columns or [])
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), i + 1, f.name in parts) for i, f in enumerate(df.schema.fields)],
        "column_name string, data_type string, ordinal_position int, is_partition boolean")


def column_profile(df: DataFrame, partition_columns: list[str] | None = None) -> DataFrame:
    """``describe_table`` with the number of non-NULL values of each column (one aggregation pass over the table)."""
    parts = set(partition_columns or [])
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).cast("long").alias(f"c{i}")
                      for i, f in enumerate(df.schema.fields)])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.lit(i + 1).alias("ordinal_position"), F.lit(f.name in parts).alias("is_partition"),
                 F.col(f"c{i}").alias("non_null_count"))
        for i, f in enumerate(df.schema.fields)])
    return counts.select(F.inline(rows))


def table_files(spark: SparkSession, path: str, partition_columns: list[str]) -> DataFrame:
    """Data files under a partitioned folder: partition columns, path and size. The files are listed, not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(*partition_columns, F.col("path").alias("file_path"), F.col("length").alias("file_size"))


def footer_counts(spark: SparkSession, path: str, schema: T.StructType, partition_columns: list[str]) -> DataFrame:
    """COUNT(*) by partition columns ; under ``footer_settings`` it comes from the footers."""
    return spark.read.schema(schema).parquet(path).groupBy(*partition_columns).agg(F.count(F.lit(1)).alias("row_count"))


@contextmanager
def footer_settings(spark: SparkSession):
    """Session settings under which Parquet counts are answered from footers (the v2 reader with aggregate push-down)."""
    v1, push = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
    held = {k: spark.conf.get(k) for k in (v1, push)}
    spark.conf.set(v1, ",".join(s for s in held[v1].split(",") if s != "parquet"))
    spark.conf.set(push, "true")
    try:
        yield
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def folder_facts(spark: SparkSession, path: str, schema: T.StructType, partition_columns: list[str]) -> DataFrame:
    """Rows, files and bytes of each partition folder: the rows from the Parquet footers, the files from a listing; no
    data column is read. The counts are computed here (a small table in the shared scratch folder), as the settings
    they need hold only here."""
    out = scratch_path(spark, "footer-counts")
    with footer_settings(spark):
        footer_counts(spark, path, schema, partition_columns).write.parquet(out)
    rows = spark.read.parquet(out)
    files = table_files(spark, path, partition_columns).groupBy(*partition_columns).agg(
        F.count("*").alias("file_count"), F.sum("file_size").alias("total_bytes"))
    return rows.join(files, partition_columns)


def scan_limit(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows; with an order it is a distributed top-k
    (TakeOrderedAndProject), without one any ``n`` rows."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def content_fingerprint(df: DataFrame) -> DataFrame:
    """(row_count, order-insensitive sum of row hashes) in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("hash_sum"))
