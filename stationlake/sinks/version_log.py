"""The stored form of a versioned table: commits, base and expiry.

Layout of the table's folder:

  log/commit_id=K/       the changes of commit K (key..., values..., op)
  commits/commit_id=K/   one row: when, what, and the rows and files it added
  base/commit_id=R/      the whole state after commit R, written by an expiry
  expiries/              one row an expiry: the oldest commit kept (R), rows and files of its base

A commit is a partitioned write and then its row in ``commits``: until the row
is there, readers do not see it, and a retried commit rewrites its own folders.
An expiry writes the base first and then appends its row to ``expiries``; from
then on readers take the base and later commits only, and what is older is
deleted. Each step can be interrupted: before the row is appended nothing has
changed for readers, after it the rest is deleted by the next expiry. One
writer at a time; readers need none of this to agree.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators import versions as V

COMMIT_SCHEMA = ("parent_id BIGINT, committed_at TIMESTAMP_NTZ, operation STRING, added_rows BIGINT, updated_rows BIGINT, "
                 "deleted_rows BIGINT, added_files BIGINT, deleted_files BIGINT, added_bytes BIGINT, commit_id BIGINT")
EXPIRY_SCHEMA = "oldest_kept BIGINT, base_rows BIGINT, base_files BIGINT, base_bytes BIGINT, expired_at TIMESTAMP_NTZ"


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in path; none if it does not exist."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _folders(spark: SparkSession, path: str) -> list[int]:
    """Commit ids that have a folder under path."""
    return sorted(int(n.split("=", 1)[1]) for n in subfolders(spark, path) if n.startswith("commit_id="))


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, and the partition columns of the folders) of the data files; the files are listed, not opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).drop("content", "modificationTime")


def log_schema(schema: str | T.StructType) -> T.StructType:
    """The table's columns, then op and commit_id."""
    table = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([*table.fields, T.StructField("op", T.StringType()), T.StructField("commit_id", T.LongType())])


def last_expiry(spark: SparkSession, path: str) -> dict | None:
    row = _read(spark, f"{path}/expiries", EXPIRY_SCHEMA).orderBy(F.desc("oldest_kept")).first()
    return row.asDict() if row else None


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """The commits that can be read, with base_rows and base_files at the oldest one kept by an expiry."""
    base = last_expiry(spark, path)
    commits = _read(spark, f"{path}/commits", COMMIT_SCHEMA)
    if base is None:
        return commits.withColumns({"base_rows": F.lit(None).cast("long"), "base_files": F.lit(None).cast("long")})
    oldest = F.col("commit_id") == base["oldest_kept"]
    return commits.filter(F.col("commit_id") >= base["oldest_kept"]).withColumns({
        "parent_id": F.when(~oldest, F.col("parent_id")),
        "base_rows": F.when(oldest, F.lit(base["base_rows"]).cast("long")),
        "base_files": F.when(oldest, F.lit(base["base_files"]).cast("long"))})


def read_changes(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The change log as readers see it: the base (as appends of the oldest commit kept) and the committed changes after it."""
    base = last_expiry(spark, path)
    last = read_commits(spark, path).agg(F.max("commit_id")).first()[0] or 0
    first = base["oldest_kept"] if base else 0
    full = log_schema(schema)
    log = _read(spark, f"{path}/log", full).filter(F.col("commit_id").between(first + 1, last))
    if base is None:
        return log
    kept = _read(spark, f"{path}/base", full).filter(F.col("commit_id") == first)
    return kept.unionByName(log)


def record_commits(spark: SparkSession, path: str, made: DataFrame) -> None:
    """Append the rows of ``commits`` for written log folders. made: (commit_id, parent_id, committed_at, operation).

    Row counts read the ``op`` column of these folders only, file counts are a listing.
    """
    ids = [r[0] for r in made.select("commit_id").collect()]
    log = spark.read.schema("op STRING, commit_id BIGINT").parquet(f"{path}/log").filter(F.col("commit_id").isin(ids))
    rows = log.groupBy("commit_id").agg(*[F.count_if(F.col("op") == op).cast("long").alias(f"{name}_rows")
                                          for op, name in zip(V.OPS, ("added", "updated", "deleted"))])
    files = (file_facts(spark, f"{path}/log").filter(F.col("commit_id").isin(ids)).groupBy(F.col("commit_id").cast("long").alias("commit_id"))
             .agg(F.count("*").alias("added_files"), F.sum("length").alias("added_bytes")))
    out = made.join(rows, "commit_id", "left").join(files, "commit_id", "left").select(
        "parent_id", "committed_at", "operation",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("added_rows", "updated_rows", "deleted_rows", "added_files")],
        F.lit(0).cast("long").alias("deleted_files"), F.coalesce("added_bytes", F.lit(0)).cast("long").alias("added_bytes"),
        F.col("commit_id").cast("long").alias("commit_id"))
    (out.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("commit_id").parquet(f"{path}/commits"))


def last_of_key(batch: DataFrame, key: list[str], seq_col: str) -> DataFrame:
    """One change per key: the last by ``seq_col`` (combined in the map tasks, so a hot key is cheap)."""
    cols = [c for c in batch.columns if c not in (*key, seq_col)]
    last = batch.groupBy(*key).agg(F.max_by(F.struct(*cols), F.col(seq_col)).alias("_r"))
    return last.select(*key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def commit_changes(spark: SparkSession, path: str, batch: DataFrame, key: list[str], operation: str, seq_col: str | None = None,
                   commit_id: int | None = None, committed_at: dt.datetime | None = None) -> int:
    """Add one commit. ``batch``: the key, the values and ``op``; one change a key (with ``seq_col`` the last one
    counts). The batch is computed once, into the commit's log folder; what it holds is checked there, before the
    commit's row makes it visible. Running a commit again under its ``commit_id`` replaces it. Returns the id."""
    if commit_id is None:
        commit_id = (read_commits(spark, path).agg(F.max("commit_id")).first()[0] or 0) + 1
    rows = last_of_key(batch, key, seq_col) if seq_col else batch
    folder = f"{path}/log/commit_id={commit_id}"
    rows.write.mode("overwrite").parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    bad = F.count_if(F.coalesce(~F.col("op").isin(*V.OPS), F.lit(True)))
    if operation == "append":
        bad = F.count_if(F.coalesce(F.col("op") != "append", F.lit(True)))
    checked = written.groupBy(*key).agg(F.count("*").alias("n"), bad.alias("bad")) if key else written.agg(F.lit(1).alias("n"), bad.alias("bad"))
    worst = checked.agg(F.max("n"), F.sum("bad")).first()
    if worst[1]:
        raise ValueError(f"op must be one of {V.OPS}, and 'append' in an append commit")
    if (worst[0] or 0) > 1:
        raise ValueError("a commit may hold one change per key; pass seq_col to order them")
    when = committed_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    made = spark.createDataFrame([(commit_id, commit_id - 1 if commit_id > 1 else None, when, operation)],
                                 "commit_id BIGINT, parent_id BIGINT, committed_at TIMESTAMP_NTZ, operation STRING")
    record_commits(spark, path, made)
    return commit_id


def restore_to(spark: SparkSession, path: str, schema: str | T.StructType, key: list[str], to_commit: int) -> int:
    """Make the latest version equal version ``to_commit`` by one more commit, so the restore can itself be undone.
    Returns its id, or the last commit's when the versions are equal already."""
    last = read_commits(spark, path).agg(F.max("commit_id")).first()[0]
    undo = V.restore_changes(read_changes(spark, path, schema), key, F.lit(int(to_commit)), F.lit(last + 1), F.lit(last)).drop("commit_id")
    folder = f"{path}/log/commit_id={last + 1}"
    undo.write.mode("overwrite").parquet(folder)
    if spark.read.schema(undo.schema).parquet(folder).isEmpty():
        return last  # without a row in commits the empty folder means nothing
    made = spark.createDataFrame([(last + 1, last, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), "restore")],
                                 "commit_id BIGINT, parent_id BIGINT, committed_at TIMESTAMP_NTZ, operation STRING")
    record_commits(spark, path, made)
    return last + 1


# --- expiry -----------------------------------------------------------------------
def expire(spark: SparkSession, path: str, schema: str | T.StructType, key: list[str], older_than: dt.datetime | None = None,
           retain_last: int | None = None) -> int:
    """Expire the versions before ``older_than``, or all but the last ``retain_last``; the latest version always stays.

    Every version from the oldest one kept reads as before; older ones are gone,
    with their folders and their rows in ``commits``. Returns the oldest commit kept.
    """
    sweep(spark, path)  # what an interrupted expiry left behind
    commits = read_commits(spark, path)
    bound = V.oldest_retained_after(commits, older_than) if older_than is not None else V.oldest_of_last(commits, retain_last)
    oldest = spark.range(1).select(bound.alias("b")).first()["b"]
    base = last_expiry(spark, path)
    if oldest is None or oldest <= (base["oldest_kept"] if base else commits.agg(F.min("commit_id")).first()[0]):
        return oldest
    write_base(spark, path, schema, key, oldest)
    mark_expired(spark, path, oldest)
    sweep(spark, path)
    return oldest


def write_base(spark: SparkSession, path: str, schema: str | T.StructType, key: list[str], oldest: int) -> None:
    state = V.as_of(read_changes(spark, path, schema), key, F.lit(oldest).cast("long"), read_commits(spark, path))
    state.withColumn("op", F.lit("append")).hint("rebalance").write.mode("overwrite").parquet(f"{path}/base/commit_id={oldest}")


def mark_expired(spark: SparkSession, path: str, oldest: int) -> None:
    """The step that counts: one appended row, after which readers start from the base."""
    folder = f"{path}/base/commit_id={oldest}"
    rows = spark.read.schema("op STRING").parquet(folder).count()
    files = file_facts(spark, folder).agg(F.count("*"), F.sum("length")).first()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(oldest, rows, files[0], files[1] or 0, now)], EXPIRY_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/expiries")


def sweep(spark: SparkSession, path: str) -> None:
    """Delete what readers no longer see. Commit rows go last, so that a log folder never outlives the row that names it."""
    base = last_expiry(spark, path)
    if base is None:
        return
    for part, last in (("log", base["oldest_kept"]), ("base", base["oldest_kept"] - 1), ("commits", base["oldest_kept"] - 1)):
        for commit in _folders(spark, f"{path}/{part}"):
            if commit <= last:
                remove(spark, f"{path}/{part}/commit_id={commit}")
