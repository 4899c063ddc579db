"""Create tables, append partitioned data, materialize and refresh.

Writers never overwrite a path that the same plan reads: refreshes replace
single partitions (dynamic partition overwrite) and compaction writes to a
new location before switching.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.schemas import (ANNUAL_SCHEMA, OBSERVATION_COLUMNS, OBSERVATIONS_SCHEMA, PARTITION_COLUMNS,
                                 STATION_COLUMNS, STATIONS_SCHEMA)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_database(spark: SparkSession, db: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location}'")


def create_tables(spark: SparkSession, db: str, location: str, recreate: bool = False) -> list[str]:
    """Create ``db.stations`` and ``db.observations`` (partitioned by year,
    month) as managed Parquet tables under ``location``. Existing tables are
    kept unless ``recreate`` is set, which drops them with their rows. Returns
    the table names."""
    create_database(spark, db, location)
    names = []
    for name, schema, parts in (("stations", STATIONS_SCHEMA, None),
                                ("observations", OBSERVATIONS_SCHEMA, PARTITION_COLUMNS)):
        full = f"`{db}`.`{name}`"
        if recreate:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
        if not spark.catalog.tableExists(f"{db}.{name}"):
            part = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
            spark.sql(f"CREATE TABLE {full} ({_ddl(schema)}) USING parquet{part}")
        names.append(f"{db}.{name}")
    return names


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the table's columns in table order with the table's types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append_stations(df: DataFrame, target: str, is_table: bool = False) -> None:
    out = conform(df, STATIONS_SCHEMA)
    if is_table:
        out.write.insertInto(target)
    else:
        out.write.mode("append").parquet(target)


def append_observations(df: DataFrame, target: str, is_table: bool = False,
                        max_records_per_file: int | None = None) -> None:
    """Partitioned append. ``REBALANCE(year, month)`` clusters rows of a
    partition into few files while AQE splits oversized (skewed) months into
    several tasks."""
    if "year" not in df.columns or "month" not in df.columns:
        df = derive_partitions(df)
    out = conform(df, OBSERVATIONS_SCHEMA).hint("rebalance", "year", "month")
    w = out.write
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if is_table:
        w.insertInto(target)
    else:
        w.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(target)


def derive_partitions(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add ``year`` and ``month`` from the date when they are absent."""
    if "year" not in df.columns:
        df = df.withColumn("year", F.year(date_col))
    if "month" not in df.columns:
        df = df.withColumn("month", F.month(date_col))
    return df


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Read a partitioned observations folder under the declared schema
    (partition columns come back last; re-select table order)."""
    return spark.read.schema(OBSERVATIONS_SCHEMA).parquet(path).select(*OBSERVATION_COLUMNS)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATIONS_SCHEMA).parquet(path).select(*STATION_COLUMNS)


def register_files(spark: SparkSession, table: str) -> None:
    """Make partition directories written next to a catalog table visible."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def register_outside(spark: SparkSession, table: str, folder: str,
                     pattern: str = r"year=(\d+)/month=(\d+)/[^/]*$") -> int:
    """Make Parquet files anywhere under ``folder`` rows of a catalog table partitioned by year and month, without a copy.

    Partitions are found from the files' paths: ``pattern`` captures year and
    month. Each becomes a partition with its own location; a folder is
    registered once, and a partition that the table already holds somewhere
    else is an error before anything is registered, as a partition has one
    location. Only paths are read (a listing); the driver sees one row a
    partition folder. Returns the number of new partitions.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
    parts = [F.regexp_extract("path", pattern, i).alias(c) for i, c in enumerate(PARTITION_COLUMNS, 1)]
    found = files.select(*parts, F.regexp_replace("path", "/[^/]*$", "").alias("location")).distinct().collect()
    bad = [r["location"] for r in found if not r["year"]]
    if bad:
        raise ValueError(f"no year and month in {bad[:3]}")
    wanted = {(int(r["year"]), int(r["month"])): r["location"] for r in found}
    if len(wanted) < len(found):
        raise ValueError("a partition's files lie in several folders")
    held = {tuple(int(kv.split("=")[1]) for kv in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = {}
    for key, location in wanted.items():
        if key not in held:
            new[key] = location
        elif _location(spark, table, key) != location.split(":", 1)[-1].replace("//", "/"):
            raise ValueError(f"{table} already holds year={key[0]}, month={key[1]} in another folder")
    for some in _groups(sorted(new.items()), 200):
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(
            f"PARTITION (year={y}, month={m}) LOCATION '{where}'" for (y, m), where in some))
    return len(new)


def _groups(items: list, n: int) -> list[list]:
    return [items[i:i + n] for i in range(0, len(items), n)]


def _location(spark: SparkSession, table: str, key: tuple[int, int]) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (year={key[0]}, month={key[1]})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").split(":", 1)[-1].replace("//", "/")


# --- ordered files -----------------------------------------------------------------
def write_ordered(df: DataFrame, path: str, order: list[str], max_records_per_file: int | None = None) -> None:
    """Write rows so that file order is row order: files in the order of their names, read one after the other, are
    sorted by ``order``. The sort is a range partitioning (sampled bounds over all order columns, so a value of the
    first column that holds much of the data is split by the others); each range is one task's file or files."""
    w = df.orderBy(*order).write
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def read_ordered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of an ordered folder with their ``position`` (from 1) in the whole order. Where a file begins follows from
    the row counts of the files before it (their footers; one row a file)."""
    name = F.col("_metadata.file_name")
    place = [F.regexp_extract(name, r"part-(\d+)", 1).cast("int"), F.expr("try_cast(nullif(regexp_extract(_metadata.file_name, '-c([0-9]+)[.]', 1), '') as int)")]
    files = (spark.read.schema(schema).parquet(path).select(name.alias("_file"), place[0].alias("_p"), place[1].alias("_c"))
             .groupBy("_file", "_p", "_c").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.orderBy("_p", "_c").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = spark.read.schema(schema).parquet(path).select("*", name.alias("_file"), F.col("_metadata.row_index").alias("_at"))
    return rows.join(starts, "_file").select(*schema.names, (F.col("_start") + F.col("_at") + 1).cast("long").alias("position"))


# --- annual table -------------------------------------------------------------------
ANNUAL_SORT = ["country", "state", "station_id", "year"]
# Partition columns lead a file sort: otherwise the writer sorts by them itself and the order inside is lost.
ANNUAL_FILE_SORT = ["year", "country", "state", "station_id"]


def _annual_writer(annual: DataFrame):
    return annual.hint("rebalance", "year").sortWithinPartitions(*ANNUAL_FILE_SORT).write


def materialize_annual(annual: DataFrame, path: str) -> None:
    """Parquet folder partitioned by year, rows sorted inside each
    file by (country, state, station_id) for min/max skipping."""
    _annual_writer(annual).mode("overwrite").partitionBy("year").parquet(path)


def create_annual_table(annual: DataFrame, table: str) -> None:
    """CREATE TABLE .. AS SELECT: the annual summary as a named catalog table, partitioned and sorted as the folder form."""
    _annual_writer(annual).mode("overwrite").format("parquet").partitionBy("year").saveAsTable(table)


def refresh_annual_table(spark: SparkSession, annual: DataFrame, table: str, year: int) -> None:
    """Replace one year of the named table; a year that has no rows any more loses its partition."""
    columns = spark.table(table).columns
    rows = _annual_rows(annual, year).select(*columns)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (year = {int(year)})")
    rows.write.insertInto(table)


def _annual_rows(annual: DataFrame, year: int) -> DataFrame:
    return annual.filter(F.col("year") == year).hint("rebalance").sortWithinPartitions(*ANNUAL_FILE_SORT)


def refresh_annual(annual: DataFrame, path: str, as_of: dt.date | None = None,
                   mode: str = "replace", year: int | None = None) -> int:
    """Recompute one year (``year``, or the year before ``as_of``, default
    today) and replace only that ``year`` partition, also when no row is left in
    it. ``mode='append'`` reproduces a plain INSERT. Returns the refreshed
    year. Build ``annual`` from observations already filtered on their
    ``year`` partition column, so the scan is pruned to that year (see
    ``plans.jobs.daily_run``)."""
    if year is None:
        year = (as_of or dt.date.today()).year - 1
    rows = _annual_rows(annual, year).drop("year")
    rows.write.mode("append" if mode == "append" else "overwrite").parquet(f"{path}/year={year}")
    return year


def read_annual(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.schema(ANNUAL_SCHEMA).parquet(path).select(*columns)
