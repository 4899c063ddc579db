"""Table schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

STATIONS_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("first_year", T.IntegerType()),
    T.StructField("last_year", T.IntegerType()),
])

OBSERVATIONS_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("element", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("measurement_flag", T.StringType()),
    T.StructField("quality_flag", T.StringType()),
    T.StructField("source_flag", T.StringType()),
    T.StructField("observation_time", T.TimestampNTZType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

ANNUAL_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("station_id", "station_name", "country", "state")]
    + [T.StructField(c, T.DoubleType()) for c in ("latitude", "longitude")] + [T.StructField("year", T.IntegerType())]
    + [T.StructField(f"yearly_{c}", T.DoubleType()) for c in ("avg_max_temp", "avg_min_temp", "avg_temp", "highest_max_temp",
                                                              "lowest_min_temp", "total_precipitation")]
    + [T.StructField("days_with_data", T.LongType())])

STATION_COLUMNS = [f.name for f in STATIONS_SCHEMA.fields]
OBSERVATION_COLUMNS = [f.name for f in OBSERVATIONS_SCHEMA.fields]
PARTITION_COLUMNS = ["year", "month"]

# Fixed values (must equal the reference's for the same results) --------------
# Elements kept by the daily pivot, in output order.
PIVOT_ELEMENTS = ["TMAX", "TMIN", "TAVG", "PRCP", "SNOW", "SNWD"]
# Elements stored in tenths in the batch files and divided by 10 on load.
TENTHS_ELEMENTS = ["TMIN", "TMAX", "TAVG", "PRCP"]
# Minimum length of a station line and of an observation row.
STATION_LINE_MIN_LENGTH = 85
OBSERVATION_MIN_FIELDS = 8
# Station file layout: (column, start offset 0-based, end offset exclusive, type).
STATION_LAYOUT = [
    ("station_id", 0, 11, "string"),
    ("latitude", 12, 20, "double"),
    ("longitude", 21, 30, "double"),
    ("elevation", 31, 37, "double"),
    ("country", 38, 40, "string"),
    ("name", 41, 71, "string"),
    ("state", 71, 73, "string"),
    ("first_year", 74, 78, "int"),
    ("last_year", 79, 83, "int"),
]
# The state is kept only for this country; other stations get ''.
STATE_COUNTRY = "US"
# Required message fields, in the order they are checked.
MESSAGE_REQUIRED_FIELDS = ["station_id", "date", "element", "value"]
# Default rows returned by the time-travel query helper.
# View names of the daily and monthly summaries.
DAILY_VIEW = "daily_weather_summary"
MONTHLY_VIEW = "monthly_climate_summary"
# End fixed values ------------------------------------------------------------

DAILY_COLUMNS = {
    "TMAX": "max_temp_celsius",
    "TMIN": "min_temp_celsius",
    "TAVG": "avg_temp_celsius",
    "PRCP": "precipitation_mm",
    "SNOW": "snowfall_mm",
    "SNWD": "snow_depth_mm",
}

MESSAGE_FIELDS_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("element", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("measurement_flag", T.StringType()),
    T.StructField("quality_flag", T.StringType()),
    T.StructField("source_flag", T.StringType()),
    T.StructField("observation_time", T.StringType()),
])

COMMITS_SCHEMA = T.StructType([
    T.StructField("commit_id", T.LongType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("committed_at", T.TimestampNTZType()),
    T.StructField("operation", T.StringType()),
])
