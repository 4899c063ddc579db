"""JOB-1: the daily run as one Spark application.

load stations -> load observations -> data-quality counts -> refresh the
annual table -> (optional) compaction. Every step is a Spark job over the
whole input; the driver only sees paths, years, commit ids and counts.

Layout under ``warehouse`` (a shared folder):
  stations/load_id=/              station tables, one a run date
  observations/load_id=/year=/month=/
                                  observation table; a load belongs to its source and replaces
                                  the years of it that it loads, other sources stay
  rejects/source=/load_id=/       rejected lines with their reason
  annual/year=/                   annual summary table
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators import quality as Q
from stationlake.operators import summaries as S
from stationlake.plans.maintenance import compact as compact_table
from stationlake.plans.maintenance import finish_compaction
from stationlake.schemas import OBSERVATION_COLUMNS, PARTITION_COLUMNS
from stationlake.session import scratch_path
from stationlake.sinks import tables as SK
from stationlake.sinks.version_log import exists
from stationlake.sources import fixed_width as FW
from stationlake.sources import observations_csv as OC


#: Columns of the stored observations, the load they belong to first.
LOADED_SCHEMA = T.StructType([T.StructField("load_id", T.StringType()), *SK.OBSERVATIONS_SCHEMA.fields])
LOADED_PARTITIONS = ["load_id", *PARTITION_COLUMNS]
STORED_STATIONS_SCHEMA = T.StructType([T.StructField("load_id", T.StringType()), *SK.STATIONS_SCHEMA.fields])


def write_rejects(rejects: DataFrame, warehouse: str, source: str, load_id: str) -> None:
    (rejects.select("raw_line", "reject_reason", F.lit(source).alias("source"), F.lit(load_id).alias("load_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source", "load_id").parquet(f"{warehouse}/rejects"))


def load_stations(spark: SparkSession, path: str, warehouse: str, load_id: str) -> str:
    parsed = FW.read_stations_fixed_width(spark, path)
    target = f"{warehouse}/stations/load_id={load_id}"
    FW.accepted(parsed).write.mode("overwrite").parquet(target)
    write_rejects(FW.rejects(parsed), warehouse, "stations", load_id)
    return target


def source_load_id(path: str) -> str:
    """Load id of a source, whichever of its years are loaded."""
    return hashlib.sha256(path.encode()).hexdigest()[:16]


def load_observations(spark: SparkSession, path: str, warehouse: str, load_id: str | None = None,
                      stations: DataFrame | None = None, year: int | None = None,
                      on_bad_value: str = "reject") -> str:
    """Load one source; ``year``: only that year's rows. Replaces what the source had loaded before (of that year, or
    all of it), also by nothing. The files are parsed once, into a staged table split by outcome; both results and the
    check of ``on_bad_value="fail"`` are taken from there. Returns the load id."""
    load_id = load_id or source_load_id(path)
    finish_compaction(spark, f"{warehouse}/observations", LOADED_SCHEMA, LOADED_PARTITIONS)
    staged = scratch_path(spark, "parsed")
    rejected = F.col("reject_reason").isNotNull()
    (OC.read_observations_csv(spark, path, stations=stations)
     .select(*OBSERVATION_COLUMNS, F.when(rejected, F.col("raw_line")).alias("raw_line"), "reject_reason",
             F.when(rejected, "rejected").otherwise("accepted").alias("outcome"))
     .write.partitionBy("outcome").parquet(staged))
    parsed = spark.read.schema(T.StructType([*SK.OBSERVATIONS_SCHEMA.fields, T.StructField("raw_line", T.StringType()),
                                             T.StructField("reject_reason", T.StringType()), T.StructField("outcome", T.StringType())])).parquet(staged)
    rejects = parsed.filter(F.col("outcome") == "rejected")
    OC.check_values(rejects, on_bad_value)
    out = SK.conform(parsed.filter(F.col("outcome") == "accepted"), SK.OBSERVATIONS_SCHEMA)
    target = f"{warehouse}/observations/load_id={load_id}"
    if year is None:
        out.hint("rebalance", *PARTITION_COLUMNS).write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(target)
    else:
        (out.filter(F.col("year") == year).drop("year").hint("rebalance", "month").write.mode("overwrite")
         .partitionBy("month").parquet(f"{target}/year={int(year)}"))
    write_rejects(rejects, warehouse, "observations", load_id)
    return load_id


def daily_run(spark: SparkSession, stations_path: str, observations_path: str, warehouse: str,
              run_date: dt.date, filter_stations: bool = False, year: int | None = None, all_years: bool = False,
              stations_only: bool = False, on_bad_value: str = "reject", compact: bool = False,
              exact_scale: int | None = None) -> dict:
    """The daily run. ``year``: the observation year to load (default: the year
    before ``run_date``; ``all_years``: every year of the files);
    ``stations_only``: load the stations and stop. The data-quality counts are
    computed before the refresh. Refreshed are the loaded year and the year
    before the run, or the whole annual table after a load of all years.
    ``compact``: merge the small files of both tables in place; the next run
    reads the merged files."""
    st_path = load_stations(spark, stations_path, warehouse, run_date.isoformat())
    if stations_only:
        return {"stations": st_path, "rejects": f"{warehouse}/rejects"}
    stations = SK.read_stations(spark, st_path)
    wanted = None if all_years else (year or run_date.year - 1)
    load_observations(spark, observations_path, warehouse, year=wanted,
                      stations=stations if filter_stations else None, on_bad_value=on_bad_value)
    obs_path = f"{warehouse}/observations"
    obs = SK.read_observations(spark, obs_path)
    dq = Q.dq_row_counts(stations, obs, run_date)
    dq = spark.createDataFrame(dq.collect(), dq.schema)  # counted here, before the refresh; one row a table

    def annual_of(o):
        daily = S.daily_summary(o, stations, keep_partitions=True)
        return S.annual_summary(S.monthly_summary(daily, exact_scale=exact_scale), exact_scale=exact_scale)

    annual_path = f"{warehouse}/annual"
    if wanted is None or not exists(spark, annual_path):
        SK.materialize_annual(annual_of(obs), annual_path)
    else:
        for y in sorted({wanted, run_date.year - 1}):
            # Filter on the partition column so only that year's folders are read;
            # a filter on the summary's year reaches the scan only as year(date).
            SK.refresh_annual(annual_of(obs.filter(F.col("year") == y)), annual_path, year=y)
    result = {"stations": st_path, "observations": obs_path, "annual": annual_path,
              "rejects": f"{warehouse}/rejects", "dq": dq}
    if compact:
        result["compacted"] = [
            compact_table(spark, obs_path, LOADED_SCHEMA, LOADED_PARTITIONS, sort_by=["station_id", "date"]),
            compact_table(spark, f"{warehouse}/stations", STORED_STATIONS_SCHEMA, ["load_id"], sort_by=["station_id"])]
    return result
