"""Message sources: JSON documents in files (SRC-4), queue events with
``Records[].body`` (SRC-5), envelopes (SRC-6); validation to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions.messages import (BATCH_FAILED_STATUS, BATCH_OK_MESSAGE, BATCH_OK_STATUS,
                                            BATCH_PARTIAL_MESSAGE, decode_envelope, envelope_data, field_columns,
                                            message_columns, status_code, status_message, type_columns)
from stationlake.functions.frames import freeze
from stationlake.schemas import OBSERVATION_COLUMNS

#: Begins each document of a JSON text sequence (RFC 7464); a JSON document never begins with it.
RECORD_MARK = "\x1e"
QUEUE_EVENT_SCHEMA = "eventId STRING, Records ARRAY<STRUCT<messageId: STRING, body: STRING>>"


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    """Each file holds one JSON document (it may span lines), or many as a JSON
    text sequence (each begins with RECORD_MARK): a message, an envelope or a
    queue event; queue events are split into their records. What is neither
    event nor envelope is judged as a message (kind ``message``)."""
    whole = F.col("value")
    several = F.slice(F.split(whole, RECORD_MARK, -1), 2, F.length(whole) + 1)  # before the first mark is nothing
    documents = F.when(whole.startswith(RECORD_MARK), several).otherwise(F.array(whole))
    records = queue_records(spark.read.text(path, wholetext=True).select(F.explode(documents).alias("value")))
    kind = F.when(F.col("event_kind") == "invalid", "message").otherwise(F.col("event_kind"))
    return records.withColumn("event_kind", kind)


def queue_records(events: DataFrame, line_col: str = "value") -> DataFrame:
    """Events (one JSON object per line) -> ``event_id, event_kind,
    message_id, body``. ``event_kind``: ``queue``, a row per record (a record
    without body has a NULL body and fails); ``empty``, the one row of a queue
    event without records; ``direct``, an envelope ``{"message": {"data": ..}}``
    that is its own message; ``invalid``, any other line. ``event_id``: the
    event's ``eventId``, else a hash of the line."""
    line = F.col(line_col)
    event = events.select(line.alias("_line"), F.from_json(line, QUEUE_EVENT_SCHEMA).alias("_e"))
    kind = (F.when(F.size("_e.Records") > 0, "queue").when(F.col("_e.Records").isNotNull(), "empty")
            .when(envelope_data("_line").isNotNull(), "direct").otherwise("invalid"))
    rows = event.select("_line", F.coalesce(F.col("_e.eventId"), F.sha2("_line", 256)).alias("event_id"),
                        kind.alias("event_kind"), F.explode_outer("_e.Records").alias("r"))
    return rows.select("event_id", "event_kind", F.col("r.messageId").alias("message_id"),
                       F.when(F.col("event_kind").isin("direct", "invalid"), F.col("_line"))
                       .otherwise(F.col("r.body")).alias("body"))


def read_queue_events(spark: SparkSession, path: str) -> DataFrame:
    return queue_records(spark.read.text(path))


def validate_messages(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """Add typed observation columns, ``envelope`` flag, ``reject_reason``.
    Rows of ``queue_records`` follow their ``event_kind``: only a direct
    message may be an envelope, and a line of no known form is rejected."""
    base = list(messages.columns)
    kinds = "event_kind" in base
    # Parse the body once; only an envelope's decoded text is parsed again.
    first = messages.select(*base, F.try_parse_json(F.col(body_col)).alias("_v0"))
    data = F.try_variant_get("_v0", "$.message.data", "string")
    if kinds:
        data = F.when(F.col("event_kind") == "direct", data)
    env = first.select(*base, "_v0", data.alias("_data"))
    parsed = env.select(*base, F.col("_data").isNotNull().alias("envelope"),
                        F.when(F.col("_data").isNotNull(),
                               F.try_parse_json(decode_envelope(F.col(body_col), F.col("_data"))))
                        .otherwise(F.col("_v0")).alias("_v"))
    typed = parsed.select("*", *[c.alias(k) for k, c in type_columns().items()])
    fields = typed.select("*", *[c.alias(k) for k, c in field_columns().items()])
    derived = message_columns()
    reason = derived.pop("reject_reason")
    if kinds:
        reason = F.when(F.col("event_kind") == "invalid", "invalid_event_format").otherwise(reason)
    out = [*base, "envelope", "station_id", "date", "element", "value", "measurement_flag", "quality_flag",
           "source_flag", "observation_time_text"]
    # A filter on reject_reason would otherwise be pushed below these
    # projections and inline the whole validation tree, JSON parse included.
    # What follows from the typed fields is computed above, where it can be left out.
    fixed = freeze(fields.select(*out, reason.alias("reject_reason")))
    return fixed.select(*out, *[c.alias(k) for k, c in derived.items()], "reject_reason")


def accepted(validated: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).select(*(extra or []), *OBSERVATION_COLUMNS)


def dead_letters(validated: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNotNull()).select(*(extra or []), "body", "reject_reason")


def message_status(validated: DataFrame, id_col: str = "message_id") -> DataFrame:
    """Single-message outcome: 200 stored, 400 rejected, 500 failed to store."""
    return validated.select(id_col, "reject_reason", status_code("reject_reason").alias("status_code"),
                            status_message("reject_reason").alias("status_message"))


def batch_status(validated: DataFrame, *batch_cols: str) -> DataFrame:
    """Per event: processed / failed counts and the outcome. A queue event:
    500 when something failed and nothing was processed, else 200 (an empty
    event too); a direct message or a line of no known form: its own outcome."""
    kind = F.col("event_kind") if "event_kind" in validated.columns else F.lit("queue")
    alone = kind.isin("direct", "invalid", "message")
    agg = validated.groupBy(*batch_cols).agg(
        F.count_if(F.col("reject_reason").isNull() & (kind != "empty")).cast("long").alias("processed"),
        F.count_if(F.col("reject_reason").isNotNull() & (kind != "empty")).cast("long").alias("failed"),
        F.max(F.when(alone, status_code("reject_reason"))).alias("_code"),
        F.max(F.when(alone, status_message("reject_reason"))).alias("_message"))
    return agg.select(
        *batch_cols, "processed", "failed",
        F.coalesce("_code", F.when((F.col("failed") > 0) & (F.col("processed") == 0), BATCH_FAILED_STATUS)
                   .otherwise(BATCH_OK_STATUS)).alias("status_code"),
        F.coalesce("_message", F.when(F.col("failed") > 0, F.format_string(BATCH_PARTIAL_MESSAGE, "processed", "failed"))
                   .otherwise(F.format_string(BATCH_OK_MESSAGE, "processed"))).alias("status_message"))
