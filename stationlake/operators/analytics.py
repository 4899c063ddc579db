"""Analytics over the monthly summary: trends, grid, year-over-year,
latest vs history, temperature-precipitation relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.operators.summaries import _avg


def temp_trend(monthly: DataFrame, by: list[str] | None = None, exact_scale: int | None = None) -> DataFrame:
    """Average monthly temperature over time per place (default: country)."""
    by = by or ["country"]
    return monthly.groupBy(*by, "year", "month").agg(
        _avg(F.col("avg_temp"), exact_scale).alias("avg_temp"),
        F.count("avg_temp").cast("long").alias("station_months"),
    )


def region_grid(monthly: DataFrame, cell_degrees: float = 10.0, exact_scale: int | None = None) -> DataFrame:
    """Temperature per latitude/longitude grid cell and year."""
    g = float(cell_degrees)
    cells = monthly.withColumn("grid_lat", (F.floor(F.col("latitude") / g) * g).cast("double")) \
                   .withColumn("grid_lon", (F.floor(F.col("longitude") / g) * g).cast("double"))
    return cells.groupBy("grid_lat", "grid_lon", "year").agg(
        _avg(F.col("avg_temp"), exact_scale).alias("avg_temp"),
        F.max("highest_max_temp").alias("highest_max_temp"),
        F.min("lowest_min_temp").alias("lowest_min_temp"),
        F.count(F.lit(1)).cast("long").alias("station_months"),
    )


def precip_year_over_year(monthly: DataFrame) -> DataFrame:
    """Monthly precipitation against the same month of the previous year.

    One pass over the monthly summary: ``lag`` within (station_id, month)
    ordered by year, kept only when that row is exactly the year before.
    Each window group holds one row per year, so it stays small however
    large a station is.
    """
    w = Window.partitionBy("station_id", "month").orderBy("year")
    m = monthly.select("station_id", "year", "month", "total_precipitation")
    prev_year, prev_val = F.lag("year").over(w), F.lag("total_precipitation").over(w)
    out = m.select("station_id", "year", "month", "total_precipitation",
                   F.when(prev_year == F.col("year") - 1, prev_val).alias("prev_year_precipitation"))
    return out.withColumn("precipitation_change",
                          F.col("total_precipitation") - F.col("prev_year_precipitation"))


def current_vs_history(monthly: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Latest monthly temperature of each station against the mean of the
    same calendar month in earlier years.

    One pass: a running (earlier-years) mean within (station_id, month),
    then the latest month per station with ``max_by`` (aggregated partially
    before the shuffle)."""
    m = monthly.filter(F.col("avg_temp").isNotNull()).select("station_id", "year", "month", "avg_temp")
    earlier = Window.partitionBy("station_id", "month").orderBy("year") \
        .rowsBetween(Window.unboundedPreceding, -1)
    t = F.col("avg_temp") if exact_scale is None else F.col("avg_temp").cast(f"decimal(38,{exact_scale})")
    total = F.sum(t).over(earlier)
    total = total if exact_scale is None else total.cast("double")
    h = m.select("station_id", "year", "month", "avg_temp",
                 (total / F.count("avg_temp").over(earlier)).alias("historical_avg_temp"))
    latest = h.groupBy("station_id").agg(
        F.max_by(F.struct("year", "month", "avg_temp", "historical_avg_temp"),
                 F.col("year") * 100 + F.col("month")).alias("l"))
    return latest.select("station_id", F.col("l.year").alias("year"), F.col("l.month").alias("month"),
                         F.col("l.avg_temp").alias("latest_avg_temp"), F.col("l.historical_avg_temp"),
                         (F.col("l.avg_temp") - F.col("l.historical_avg_temp")).alias("difference"))


def temp_precip_corr(monthly: DataFrame, digits: int | None = None) -> DataFrame:
    """Per station: correlation and regression slope of precipitation on the
    mean maximum temperature, over months with both values."""
    m = monthly.filter(F.col("avg_max_temp").isNotNull() & F.col("total_precipitation").isNotNull())
    out = m.groupBy("station_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_months"),
        F.corr("avg_max_temp", "total_precipitation").alias("temp_precip_corr"),
        F.regr_slope("total_precipitation", "avg_max_temp").alias("precip_per_degree"),
    )
    if digits is not None:
        out = out.withColumn("temp_precip_corr", F.round("temp_precip_corr", digits)) \
                 .withColumn("precip_per_degree", F.round("precip_per_degree", digits))
    return out
