"""stationlake: daily station observations as Spark DataFrame / SQL jobs.

Every operator is a function from DataFrames to a DataFrame, written with
built-in ``pyspark.sql.functions`` so Catalyst plans it and the work runs in
whole-stage codegen on the executors.
"""

from stationlake.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
