"""Compaction of partitioned Parquet tables: only partitions with small files are touched.

Which partitions need it, and which files go together, follows from a listing
of file sizes; rows are read from the chosen partitions only. Their rows are
first written and checked in a staging folder beside the table and then replace
the partitions; what a crash interrupts there, the next call repeats from the
staged copy.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators.tables import content_fingerprint
from stationlake.session import scratch_path
from stationlake.sinks.version_log import exists, remove, subfolders

#: Partitions that are staged and replaced together (their folder names are on the driver).
GROUP_PARTITIONS = 500


def small_file_plan(spark: SparkSession, path: str, partition_columns: list[str], target_bytes: int) -> DataFrame:
    """(partition columns, folder, file_name, bin) of the files to merge.

    A partition is chosen if it has two or more files under half the target and
    merging leaves fewer files. Its files are packed in order of their names
    into bins of about ``target_bytes`` by their running size.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(
        *partition_columns, F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("_metadata.file_name").alias("file_name"), "length")
    chosen = listed.groupBy("folder").agg(F.count("*").alias("n"), F.count_if(F.col("length") < target_bytes // 2).alias("small"),
                                          F.sum("length").alias("bytes")) \
        .filter((F.col("small") >= 2) & (F.ceil(F.col("bytes") / target_bytes) < F.col("n"))).select("folder")
    before = Window.partitionBy("folder").orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("length").over(before), F.lit(0))
    return listed.join(chosen, "folder").withColumn("bin", F.floor(filled / target_bytes)).drop("length")


def compact(spark: SparkSession, path: str, schema: T.StructType, partition_columns: list[str],
            target_file_bytes: int = 256 << 20, sort_by: list[str] | None = None) -> dict:
    """Merge the small files of the table at ``path``, partition by partition, in place.

    ``schema``: all columns, partition columns included. ``sort_by``: order of
    the rows in a merged file. Partitions without small files keep their files.
    A writer of the same partitions must not run at the same time. Returns the
    numbers of partitions and files replaced.
    """
    finish_compaction(spark, path, schema, partition_columns)
    chosen = scratch_path(spark, "compaction-plan")  # once: each reading of the listing touches every file
    made = small_file_plan(spark, path, partition_columns, target_file_bytes)
    made.write.parquet(chosen)
    plan = spark.read.schema(made.schema).parquet(chosen)
    folders = [r["folder"] for r in plan.select("folder").distinct().orderBy("folder").collect()]  # names, one a partition
    done = {"path": path, "partitions": len(folders), "files_before": 0, "files_after": 0}
    for i in range(0, len(folders), GROUP_PARTITIONS):
        some = folders[i:i + GROUP_PARTITIONS]
        staging = f"{path}_compaction/{uuid.uuid4().hex[:12]}"
        _stage(spark, path, some, plan.filter(F.col("folder").isin(some)), staging, schema, partition_columns, sort_by)
        done["files_before"] += plan.filter(F.col("folder").isin(some)).count()
        done["files_after"] += plan.filter(F.col("folder").isin(some)).select("folder", "bin").distinct().count()
        finish_compaction(spark, path, schema, partition_columns)
    return done


def _stage(spark: SparkSession, path: str, folders: list[str], plan: DataFrame, staging: str, schema: T.StructType,
           partition_columns: list[str], sort_by: list[str] | None) -> None:
    """Write the merged rows of the folders to the staging folder; mark it when it holds what the folders hold."""
    source = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    bins = plan.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in partition_columns], "file_name", "bin")
    rows = source.select("*", F.col("_metadata.file_name").alias("file_name")).join(bins, [*partition_columns, "file_name"])
    out = rows.repartition(*partition_columns, "bin").sortWithinPartitions(*partition_columns, "bin", *(sort_by or [])).drop("file_name", "bin")
    out.write.mode("overwrite").partitionBy(*partition_columns).parquet(f"{staging}/rows")
    old, new = (content_fingerprint(df.select(*schema.names)).first() for df in (source, spark.read.schema(schema).parquet(f"{staging}/rows")))
    if tuple(old) != tuple(new):
        remove(spark, staging)
        raise RuntimeError(f"compaction changed the content ({old} != {new}); {path} is as it was")
    spark.createDataFrame([(len(folders),)], "partitions int").coalesce(1).write.mode("overwrite").parquet(f"{staging}/checked")


def finish_compaction(spark: SparkSession, path: str, schema: T.StructType, partition_columns: list[str]) -> None:
    """Replace the partitions that a checked staging folder holds (again, if an earlier call was interrupted: the same
    partitions get the same rows) and drop unchecked leftovers. Call it before other writes to the table."""
    for name in subfolders(spark, f"{path}_compaction"):
        staging = f"{path}_compaction/{name}"
        if exists(spark, f"{staging}/checked/_SUCCESS"):
            staged = spark.read.schema(schema).parquet(f"{staging}/rows").withColumn("_f", F.col("_metadata.file_name"))
            (staged.repartition(*partition_columns, "_f").drop("_f").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_columns).parquet(path))
        remove(spark, staging)
