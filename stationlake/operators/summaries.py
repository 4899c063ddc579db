"""Daily pivot, monthly and annual summaries, anomaly against a baseline.

``exact_scale``: when set, sums and averages are computed over
DECIMAL(38, scale) and cast back to DOUBLE, so the result does not depend on
the order in which partial sums are merged (useful when comparing engines).
Without it they are plain ``sum`` / ``avg``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.schemas import DAILY_COLUMNS, PIVOT_ELEMENTS

STATION_ATTRS = ["station_name", "country", "state", "latitude", "longitude"]


def _sum(c: Column, exact_scale: int | None) -> Column:
    if exact_scale is None:
        return F.sum(c)
    return F.sum(c.cast(f"decimal(38,{exact_scale})")).cast("double")


def _avg(c: Column, exact_scale: int | None) -> Column:
    if exact_scale is None:
        return F.avg(c)
    return _sum(c, exact_scale) / F.count(c)


def _partition_cols(df: DataFrame) -> list[str]:
    return [c for c in ("year", "month") if c in df.columns]


def daily_pivot(observations: DataFrame, keep_partitions: bool = False) -> DataFrame:
    """One row per (station_id, date): MAX of each pivoted element.

    ``keep_partitions``: also group by the table's ``year`` / ``month``
    partition columns. They are functions of ``date`` (PRJ-2), so the groups
    are the same, but later filters on the summaries' year/month then reach
    the scan as partition filters instead of as ``year(date)``."""
    obs = observations.filter(F.col("element").isin(PIVOT_ELEMENTS))
    aggs = [F.max(F.when(F.col("element") == e, F.col("value"))).alias(DAILY_COLUMNS[e])
            for e in PIVOT_ELEMENTS]
    extra = _partition_cols(observations) if keep_partitions else []
    return obs.groupBy("station_id", "date", *extra).agg(*aggs)


def daily_summary(observations: DataFrame, stations: DataFrame, keep_partitions: bool = False) -> DataFrame:
    """Daily pivot joined (inner) to station attributes (``keep_partitions``:
    see ``daily_pivot``)."""
    t = daily_pivot(observations, keep_partitions)
    s = stations.select("station_id", F.col("name").alias("station_name"), "latitude",
                        "longitude", "elevation", "country", "state")
    return t.join(s, "station_id")


#: Orders of the ordered forms. They are total as far as a station has one set of attributes, and a station with
#: many rows is split over range partitions by the later columns.
MONTHLY_ORDER = ["station_id", "year", "month"]
ANOMALY_ORDER = ["year", "month", "station_id"]


def monthly_summary(daily: DataFrame, exact_scale: int | None = None, ordered: bool = False) -> DataFrame:
    """Monthly averages / extremes / totals per station from the daily rows
    that have a max, min or precipitation value. Uses the daily rows'
    ``year`` / ``month`` columns when present (partition pruning), else
    derives them from ``date``. ``ordered``: by station, year and month
    (range partitions; ``sinks.tables.write_ordered`` keeps the order in files)."""
    d = daily.filter(F.col("max_temp_celsius").isNotNull() | F.col("min_temp_celsius").isNotNull()
                     | F.col("precipitation_mm").isNotNull())
    year = F.col("year") if "year" in daily.columns else F.year("date")
    month = F.col("month") if "month" in daily.columns else F.month("date")
    out = d.groupBy(
        "station_id", "station_name", "country", "state", "latitude", "longitude",
        year.alias("year"), month.alias("month"),
    ).agg(
        _avg(F.col("max_temp_celsius"), exact_scale).alias("avg_max_temp"),
        _avg(F.col("min_temp_celsius"), exact_scale).alias("avg_min_temp"),
        _avg(F.col("avg_temp_celsius"), exact_scale).alias("avg_temp"),
        F.max("max_temp_celsius").alias("highest_max_temp"),
        F.min("min_temp_celsius").alias("lowest_min_temp"),
        _sum(F.col("precipitation_mm"), exact_scale).alias("total_precipitation"),
        F.count("date").cast("long").alias("days_in_month"),
    )
    return out.orderBy(*MONTHLY_ORDER) if ordered else out


def annual_summary(monthly: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Annual rollup: average of monthly averages, extremes, totals."""
    avg_scale = None if exact_scale is None else exact_scale + 2
    return monthly.groupBy("station_id", "station_name", "country", "state", "latitude",
                           "longitude", "year").agg(
        _avg(F.col("avg_max_temp"), avg_scale).alias("yearly_avg_max_temp"),
        _avg(F.col("avg_min_temp"), avg_scale).alias("yearly_avg_min_temp"),
        _avg(F.col("avg_temp"), avg_scale).alias("yearly_avg_temp"),
        F.max("highest_max_temp").alias("yearly_highest_max_temp"),
        F.min("lowest_min_temp").alias("yearly_lowest_min_temp"),
        _sum(F.col("total_precipitation"), exact_scale).alias("yearly_total_precipitation"),
        F.sum("days_in_month").cast("long").alias("days_with_data"),
    )


ANNUAL_COLUMNS = ["station_id", "station_name", "country", "state", "latitude", "longitude", "year",
                  "yearly_avg_max_temp", "yearly_avg_min_temp", "yearly_avg_temp",
                  "yearly_highest_max_temp", "yearly_lowest_min_temp",
                  "yearly_total_precipitation", "days_with_data"]


def temp_anomaly(monthly: DataFrame, baseline_from: int, baseline_to: int, report_from: int,
                 exact_scale: int | None = None, ordered: bool = False) -> DataFrame:
    """Monthly average temperature minus the station's baseline mean for the
    same calendar month over [baseline_from, baseline_to].

    The baseline has one row per (station, month), at most 12 a station; AQE
    measures it and broadcasts it when it is small. ``ordered``: by year,
    month and station."""
    avg_scale = None if exact_scale is None else exact_scale + 2
    base = (monthly.filter(F.col("year").between(baseline_from, baseline_to))
            .groupBy("station_id", "month")
            .agg(_avg(F.col("avg_temp"), avg_scale).alias("baseline_temp")))
    cur = monthly.filter(F.col("year") >= report_from)
    j = cur.join(base, ["station_id", "month"])
    out = j.select("year", "month", "station_id", "station_name", "country", "state", "latitude",
                   "longitude", "avg_temp", "baseline_temp",
                   (F.col("avg_temp") - F.col("baseline_temp")).alias("temp_anomaly"))
    return out.orderBy(*ANOMALY_ORDER) if ordered else out


def register_views(spark, observations: DataFrame, stations: DataFrame, exact_scale: int | None = None,
                   prefix: str = "") -> tuple[str, str]:
    """CREATE OR REPLACE the daily and monthly summary views (session temp
    views) over the given tables; SQL users can then query them by name and
    Catalyst inlines them into each query. Returns the two view names."""
    from stationlake.schemas import DAILY_VIEW, MONTHLY_VIEW
    daily_name, monthly_name = prefix + DAILY_VIEW, prefix + MONTHLY_VIEW
    daily_summary(observations, stations).createOrReplaceTempView(daily_name)
    monthly_summary(daily_summary(observations, stations, keep_partitions=True),
                    exact_scale=exact_scale).createOrReplaceTempView(monthly_name)
    return daily_name, monthly_name
