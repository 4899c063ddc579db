"""JSON sensor messages: envelope decoding, validation reason, status.

Validation follows the reference's rules and their order; presence, JSON
null and type are told apart with VARIANT (``try_parse_json`` +
``schema_of_variant``), which ``from_json`` cannot do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlake.functions.parse import NUMBER_PATTERN, observation_time_stream, stream_time_invalid
from stationlake.schemas import MESSAGE_REQUIRED_FIELDS

NUMERIC_TYPES = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*|BOOLEAN)$"
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"

# Outcome of each reason on the single-message path -------------
# 400 = rejected by validation, 500 = failed while storing; valid -> 200.
STATUS_BY_REASON = {
    "invalid_json": (400, "Error: Invalid JSON in message"),
    "invalid_event_format": (400, "Invalid event format"),
    "not_an_object": (400, "Error: Invalid message format or data"),
    "missing_station_id": (400, "Error: Invalid message format or data"),
    "missing_date": (400, "Error: Invalid message format or data"),
    "missing_element": (400, "Error: Invalid message format or data"),
    "missing_value": (400, "Error: Invalid message format or data"),
    "station_id_not_string": (400, "Error: Invalid message format or data"),
    "element_not_string": (400, "Error: Invalid message format or data"),
    "value_not_numeric": (400, "Error: Invalid message format or data"),
    "invalid_date": (400, "Error: Invalid message format or data"),
    "scalar_message": (500, "Error processing message"),
    "value_wrong_type": (500, "Error processing message"),
    "date_not_string": (500, "Error processing message"),
    "invalid_observation_time": (500, "Error processing message"),
}
SUCCESS = (200, "Success")
# Outcome of a queue event (batch of records).
BATCH_FAILED_STATUS = 500          # something failed and nothing was processed
BATCH_OK_STATUS = 200
BATCH_PARTIAL_MESSAGE = "Processed %d messages, failed %d"
BATCH_OK_MESSAGE = "Successfully processed %d messages"
# End fixed values ------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def envelope_data(body) -> Column:
    return F.try_variant_get(F.try_parse_json(_c(body)), "$.message.data", "string")


def decode_envelope(body, data=None) -> Column:
    """``{"message": {"data": d}}`` -> d decoded from base64 when it is valid
    base64 of UTF-8 text, else d as is; any other body is returned unchanged.
    ``data``: the already extracted ``message.data`` column, if any."""
    b = _c(body)
    data = envelope_data(b) if data is None else _c(data)
    raw = F.try_to_binary(data, F.lit("base64"))
    decoded = F.when(F.is_valid_utf8(raw), F.decode(raw, "UTF-8"))
    return F.when(data.isNotNull(), F.coalesce(decoded, data)).otherwise(b)


def _type(v: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def type_columns(v="_v") -> dict[str, Column]:
    """Stage 1 (after the VARIANT ``_v`` is parsed once): JSON type names of the document and of the required fields
    (NULL = absent, VOID = JSON null)."""
    v = _c(v)
    out = {"_t_top": F.schema_of_variant(v)}
    for f in MESSAGE_REQUIRED_FIELDS:
        out[f"_t_{f}"] = _type(v, f)
    return out


def field_columns(v="_v") -> dict[str, Column]:
    """Stage 2: typed message fields. Expects ``_v`` and stage 1."""
    v = _c(v)
    t_value, t_date = F.col("_t_value"), F.col("_t_date")
    value_str = F.try_variant_get(v, "$.value", "string")
    date_str = F.try_variant_get(v, "$.date", "string")
    return {
        "station_id": F.try_variant_get(v, "$.station_id", "string"),
        "date": F.when(t_date == "STRING",
                       F.when(date_str.rlike(DATE_PATTERN), F.try_to_date(date_str, "yyyy-M-d"))),
        "element": F.try_variant_get(v, "$.element", "string"),
        "value": (F.when(t_value == "STRING",
                         F.when(value_str.rlike(NUMBER_PATTERN), F.trim(value_str)).try_cast("double"))
                  .otherwise(F.try_variant_get(v, "$.value", "double"))),
        "measurement_flag": F.try_variant_get(v, "$.measurement_flag", "string"),
        "quality_flag": F.try_variant_get(v, "$.quality_flag", "string"),
        "source_flag": F.try_variant_get(v, "$.source_flag", "string"),
        "observation_time_text": F.try_variant_get(v, "$.observation_time", "string"),
    }


def message_columns() -> dict[str, Column]:
    """Stage 3: derived columns and ``reject_reason`` (NULL = accepted), in
    the reference's order of checks. Expects stages 1 and 2."""
    top = F.col("_t_top")
    types = {f: F.col(f"_t_{f}") for f in MESSAGE_REQUIRED_FIELDS}
    date, value, time_str = F.col("date"), F.col("value"), F.col("observation_time_text")
    reason = F.when(F.col("_v").isNull(), "invalid_json").when(
        top.rlike(r"^(STRING|ARRAY)"), "not_an_object").when(~top.startswith("OBJECT"), "scalar_message")
    for f in MESSAGE_REQUIRED_FIELDS:
        reason = reason.when(types[f].isNull(), f"missing_{f}")
    reason = (reason
              .when(types["station_id"] != "STRING", "station_id_not_string")
              .when(types["element"] != "STRING", "element_not_string")
              .when((types["value"] == "STRING") & value.isNull(), "value_not_numeric")
              .when(~types["value"].rlike(NUMERIC_TYPES) & (types["value"] != "STRING"), "value_wrong_type")
              .when((types["date"] == "STRING") & date.isNull(), "invalid_date")
              .when(types["date"] != "STRING", "date_not_string")
              .when(stream_time_invalid(date, time_str), "invalid_observation_time"))
    return {
        "observation_time": observation_time_stream(date, time_str),
        "year": F.year(date),
        "month": F.month(date),
        "reject_reason": reason,
    }


def status_code(reason) -> Column:
    r = _c(reason)
    out = F.when(r.isNull(), F.lit(SUCCESS[0]))
    for k, (code, _) in STATUS_BY_REASON.items():
        out = out.when(r == k, F.lit(code))
    return out.otherwise(F.lit(500))


def status_message(reason) -> Column:
    r = _c(reason)
    out = F.when(r.isNull(), F.lit(SUCCESS[1]))
    for k, (_, msg) in STATUS_BY_REASON.items():
        out = out.when(r == k, F.lit(msg))
    return out.otherwise(F.lit("Error processing message"))
