"""Fixed-width station file -> stations (SRC-1), with rejected lines kept.

The layout is data: a list of (column, start, end, type) with 0-based,
end-exclusive character offsets (``schemas.STATION_LAYOUT``), so a corrected
layout needs no code change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions.parse import parse_number, strip_ws
from stationlake.functions.frames import freeze
from stationlake.schemas import (STATE_COUNTRY, STATION_COLUMNS, STATION_LAYOUT,
                                 STATION_LINE_MIN_LENGTH)

REPLACEMENT_CHAR = "�"


def read_station_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("_file"))


def parse_station_lines(lines: DataFrame, layout=STATION_LAYOUT,
                        min_length: int = STATION_LINE_MIN_LENGTH) -> DataFrame:
    """Typed station columns plus ``reject_reason`` (NULL when accepted).

    Rules, first failure wins: undecodable text; line shorter than
    ``min_length``; a latitude/longitude/elevation that is not a number;
    a first/last year that is not an integer. Blank numbers read as 0.
    """
    line = F.col("value")
    cols, num_ok, int_ok = {}, [], []
    for name, start, end, typ in layout:
        raw = strip_ws(F.substring(line, start + 1, end - start))
        if typ == "string":
            cols[name] = raw
        else:
            to = "double" if typ == "double" else "int"
            cols[name] = parse_number(F.substring(line, start + 1, end - start), to)
            (num_ok if to == "double" else int_ok).append(cols[name].isNotNull())
    if "state" in cols and "country" in cols:
        cols["state"] = F.when(cols["country"] == STATE_COUNTRY, cols["state"]).otherwise(F.lit(""))

    def all_of(conds):
        out = F.lit(True)
        for c in conds:
            out = out & c
        return out

    reason = (F.when(F.instr(line, REPLACEMENT_CHAR) > 0, "invalid_encoding")
              .when(F.length(line) < min_length, "short_line")
              .when(~all_of(num_ok), "invalid_number")
              .when(~all_of(int_ok), "invalid_year"))
    out_cols = [cols[c].alias(c) for c in STATION_COLUMNS if c in cols]
    extra = [F.col("_file")] if "_file" in lines.columns else []
    return freeze(lines.select(*out_cols, reason.alias("reject_reason"), line.alias("raw_line"), *extra))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).select(*STATION_COLUMNS)


def rejects(parsed: DataFrame) -> DataFrame:
    extra = ["_file"] if "_file" in parsed.columns else []
    return parsed.filter(F.col("reject_reason").isNotNull()).select("raw_line", "reject_reason", *extra)


def read_stations_fixed_width(spark: SparkSession, path: str, layout=STATION_LAYOUT) -> DataFrame:
    return parse_station_lines(read_station_lines(spark, path), layout)
