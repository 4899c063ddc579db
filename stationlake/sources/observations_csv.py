"""Gzip CSV observation files -> observations (SRC-2), rejects kept.

Each line has 8 positional fields: station_id, date (YYYYMMDD), element,
value, measurement flag, quality flag, source flag, observation time.
Lines with fewer fields are rejected, extra fields are ignored and double
quotes are honoured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions.parse import (csv_field_count, empty_to_null, observation_time_batch,
                                         parse_number, parse_yyyymmdd, scale_units)
from stationlake.functions.frames import freeze
from stationlake.operators.joins import semi_join_stations
from stationlake.schemas import OBSERVATION_COLUMNS, OBSERVATION_MIN_FIELDS

FIELDS = ["station_id", "date_text", "element", "value_text", "measurement_flag",
          "quality_flag", "source_flag", "time_text"]
CSV_SCHEMA = ", ".join(f"{f} STRING" for f in FIELDS)


def read_observation_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with their file, block and read position. The position is
    taken right after the scan, before any shuffle, so it follows file order.

    A gzip file is read by one task. When there are fewer files than cores, the
    raw lines are dealt out by (file, position) before anything is parsed.
    """
    files = spark.read.text(path)
    lines = files.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    cores = spark.sparkContext.defaultParallelism
    if len(files.inputFiles()) < cores:
        lines = lines.repartition(cores, "_file", "_block", "_row")
    return lines


def parse_observation_lines(lines: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Observation columns plus ``reject_reason`` (NULL when accepted):
    ``too_few_fields``, ``invalid_date`` or ``invalid_value``, first wins.
    ``stations``: keep lines whose station is one of these only (left semi
    join on the first field, before anything else of the line is typed).

    Built in stages: the CSV record, then the typed date and value and the
    reason, and these alone are fixed below a filter (``freeze``); scaling,
    times and flags are computed from them above it, where a reader that does
    not want them leaves them out.
    """
    keep = [c for c in ("_file", "_block", "_row") if c in lines.columns]
    line = F.col("value")
    rec = lines.select(line.alias("raw_line"), *keep, F.from_csv(line, CSV_SCHEMA, {"mode": "PERMISSIVE", "escape": '"'}).alias("_rec"))
    if stations is not None:
        rec = semi_join_stations(rec.withColumn("station_id", F.coalesce("_rec.station_id", F.lit(""))), stations)
    fields = rec.select("raw_line", *keep, csv_field_count(F.col("raw_line")).alias("_n"),
                        *[F.coalesce(F.col(f"_rec.{name}"), F.lit("")).alias(name) for name in FIELDS])
    typed = fields.select("*", parse_yyyymmdd(F.col("date_text")).alias("date"),
                          parse_number(F.col("value_text"), "double", blank_as_zero=False).alias("_raw_value"))
    reason = (F.when(F.col("_n") < OBSERVATION_MIN_FIELDS, "too_few_fields")
              .when(F.col("date").isNull(), "invalid_date")
              .when(F.col("_raw_value").isNull(), "invalid_value"))
    fixed = freeze(typed.select(*[c for c in typed.columns if c not in ("_n", "value_text")], reason.alias("reject_reason")))
    date = F.col("date")
    return fixed.select(
        "station_id", "date", "element",
        scale_units(F.col("element"), F.col("_raw_value")).alias("value"),
        empty_to_null(F.col("measurement_flag")).alias("measurement_flag"),
        empty_to_null(F.col("quality_flag")).alias("quality_flag"),
        empty_to_null(F.col("source_flag")).alias("source_flag"),
        observation_time_batch(date, F.col("time_text")).alias("observation_time"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        "date_text", "time_text",
        "reject_reason",
        "raw_line",
        *keep,
    )


def accepted(parsed: DataFrame, keep_position: bool = False) -> DataFrame:
    extra = [c for c in ("_file", "_block", "_row") if keep_position and c in parsed.columns]
    return parsed.filter(F.col("reject_reason").isNull()).select(*OBSERVATION_COLUMNS, *extra)


def rejects(parsed: DataFrame) -> DataFrame:
    extra = [c for c in ("_file",) if c in parsed.columns]
    return parsed.filter(F.col("reject_reason").isNotNull()).select("raw_line", "reject_reason", *extra)


def check_values(parsed: DataFrame, on_bad_value: str = "reject") -> None:
    """``on_bad_value='fail'``: raise before anything is written when any row
    has a non-numeric value (one bounded job)."""
    if on_bad_value == "fail" and \
            parsed.filter(F.col("reject_reason") == "invalid_value").limit(1).count() > 0:
        raise ValueError("observation file has a non-numeric value")


def read_observations_csv(spark: SparkSession, path: str, stations: DataFrame | None = None,
                          on_bad_value: str = "reject") -> DataFrame:
    """Parsed lines; with ``stations`` only those of loaded stations."""
    parsed = parse_observation_lines(read_observation_lines(spark, path), stations)
    check_values(parsed, on_bad_value)
    return parsed
