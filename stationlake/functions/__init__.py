"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from stationlake.functions.parse import (  # noqa: F401
    strip_ws, parse_number, parse_yyyymmdd, observation_time_batch,
    observation_time_stream, scale_units, empty_to_null, csv_field_count,
)
