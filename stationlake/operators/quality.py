"""Data-quality counts: rows per table for a run date, rows per month,
rejected rows by reason."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.plans.pruning import date_equals


def dq_row_counts(stations: DataFrame, observations: DataFrame, run_date: dt.date) -> DataFrame:
    """('stations', all rows) UNION ALL ('observations', rows of the run date).
    The date predicate also carries year/month predicates so a partitioned
    observations table is pruned to one directory."""
    s = stations.agg(F.count(F.lit(1)).cast("long").alias("row_count")) \
        .select(F.lit("stations").alias("table_name"), "row_count")
    o = observations.filter(date_equals(run_date)) \
        .agg(F.count(F.lit(1)).cast("long").alias("row_count")) \
        .select(F.lit("observations").alias("table_name"), "row_count")
    return s.unionByName(o)


def month_distribution(observations: DataFrame) -> DataFrame:
    """Rows per (year, month)."""
    return observations.groupBy("year", "month").agg(F.count(F.lit(1)).cast("long").alias("row_count"))


def reject_report(*rejects: tuple[str, DataFrame]) -> DataFrame:
    """Rejected rows by (source, reason). Each input carries ``reject_reason``."""
    out = None
    for source, df in rejects:
        r = df.groupBy("reject_reason").agg(F.count(F.lit(1)).cast("long").alias("row_count")) \
            .select(F.lit(source).alias("source"), "reject_reason", "row_count")
        out = r if out is None else out.unionByName(r)
    return out
