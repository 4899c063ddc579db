"""Join helpers. Sizes are left to the optimizer and AQE, which measure a side
before they broadcast it and split skewed partitions of a shuffle join."""

from __future__ import annotations

from pyspark.sql import DataFrame


def semi_join_stations(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Keep observations whose station was loaded (left semi on station_id)."""
    return observations.join(stations.select("station_id").distinct(), "station_id", "left_semi")
