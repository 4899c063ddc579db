"""Stream queue events from a landing folder into a message log.

``readStream`` of JSON-lines queue events -> one row per record ->
validation columns -> ``foreachBatch``: the micro-batch is written once,
partitioned by (year, month, stream_id, batch_id, outcome), with dynamic
partition overwrite. A replayed batch (``foreachBatch`` is at-least-once)
rewrites exactly its own partitions, so the log holds each message once; batch
ids start at 0 for every checkpoint, so the stream's own identity stands beside
them and streams into one log do not meet. Reads of a month prune to that
month's folders (dead letters without a date sit under the default
partition). Accepted observations and dead letters are two pruned views of the
same log. With ``observations_path`` the accepted rows also go to the
observations table the summaries read, as load ``stream-<stream_id>-<batch_id>``:
a replayed batch replaces its own load and the rows of other loads stay. The job
is stateless; the checkpoint only tracks which files were consumed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationlake.schemas import OBSERVATION_COLUMNS, OBSERVATIONS_SCHEMA, PARTITION_COLUMNS
from stationlake.sinks.tables import conform
from stationlake.sinks.version_log import exists
from stationlake.sources.messages import batch_status, queue_records, validate_messages

LOG_COLUMNS = ["event_id", "message_id", *OBSERVATION_COLUMNS, "observation_time_text", "envelope", "body",
               "reject_reason"]


LOG_PARTITIONS = ["year", "month", "stream_id", "batch_id", "outcome"]
LOG_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("message_id", T.StringType()),
    *[f for f in OBSERVATIONS_SCHEMA.fields if f.name not in PARTITION_COLUMNS],
    T.StructField("observation_time_text", T.StringType()), T.StructField("envelope", T.BooleanType()),
    T.StructField("body", T.StringType()), T.StructField("reject_reason", T.StringType()),
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField("stream_id", T.StringType()),
    T.StructField("batch_id", T.LongType()), T.StructField("outcome", T.StringType())])


def stream_identity(checkpoint: str) -> str:
    """A stream is its checkpoint: the same across restarts, another for another stream."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def write_batch(batch: DataFrame, batch_id: int, log_path: str, observations_path: str | None = None,
                stream_id: str = "single") -> None:
    """Write one micro-batch to the log and, if asked, its accepted rows to the observations. The batch is validated
    once; both sinks take their rows from the kept result."""
    v = validate_messages(batch.filter(F.col("event_kind") != "empty"))
    out = v.select(*LOG_COLUMNS, F.lit(stream_id).alias("stream_id"), F.lit(batch_id).cast("long").alias("batch_id"),
                   F.when(F.col("reject_reason").isNull(), "accepted").otherwise("dead_letter").alias("outcome")).persist()
    try:
        (out.hint("rebalance", "year", "month", "outcome").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*LOG_PARTITIONS).parquet(log_path))
        if observations_path is not None:
            rows = out.filter(F.col("outcome") == "accepted")
            (conform(rows, OBSERVATIONS_SCHEMA).hint("rebalance", *PARTITION_COLUMNS).write.mode("overwrite")
             .partitionBy(*PARTITION_COLUMNS).parquet(f"{observations_path}/load_id=stream-{stream_id}-{batch_id}"))
    finally:
        out.unpersist()


def start_ingest(spark: SparkSession, source_dir: str, log_path: str, checkpoint: str,
                 max_files_per_trigger: int | None = None, available_now: bool = True,
                 processing_time: str | None = None, clean_source: str | None = None,
                 observations_path: str | None = None, stream_id: str | None = None) -> StreamingQuery:
    """``stream_id``: the stream's name in log and loads (default: from its checkpoint)."""
    name = stream_id or stream_identity(checkpoint)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:  # "delete" or "archive": drop consumed input files
        reader = reader.option("cleanSource", clean_source)
    records = queue_records(reader.load(source_dir))
    w = records.writeStream.foreachBatch(lambda df, bid: write_batch(df, bid, log_path, observations_path, name)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The message log under its declared schema; empty before the first batch."""
    if not exists(spark, log_path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(log_path)


def accepted_observations(spark: SparkSession, log_path: str) -> DataFrame:
    return read_log(spark, log_path).filter(F.col("outcome") == "accepted").select("message_id",
                                                                                   *OBSERVATION_COLUMNS)


def dead_letters(spark: SparkSession, log_path: str) -> DataFrame:
    return read_log(spark, log_path).filter(F.col("outcome") == "dead_letter") \
        .select("stream_id", "batch_id", "message_id", "body", "reject_reason")


def micro_batch_status(spark: SparkSession, log_path: str) -> DataFrame:
    return batch_status(read_log(spark, log_path), "stream_id", "batch_id")
