"""Message validation outcomes, one row per rule."""

import base64
import json

import pytest

from stationlake.sources import messages as M

GOOD = {"station_id": "XK07", "date": "2021-11-23", "element": "TMIN", "value": -4.25,
        "measurement_flag": "", "quality_flag": "", "source_flag": "", "observation_time": "06:10"}


def msg(**changes):
    m = dict(GOOD)
    for k, v in changes.items():
        if v is ...:
            m.pop(k)
        else:
            m[k] = v
    return json.dumps(m)


CASES = [
    (msg(), None, 200),
    ("{bad json", "invalid_json", 400),
    (json.dumps([GOOD]), "not_an_object", 400),
    ("12", "scalar_message", 500),
    (msg(station_id=...), "missing_station_id", 400),
    (msg(value=...), "missing_value", 400),
    (msg(station_id=12), "station_id_not_string", 400),
    (msg(element=1), "element_not_string", 400),
    (msg(value="abc"), "value_not_numeric", 400),
    (msg(value=None), "value_wrong_type", 500),
    (msg(value=[1]), "value_wrong_type", 500),
    (msg(value="12.5"), None, 200),
    (msg(value=True), None, 200),
    (msg(date="2021/11/23"), "invalid_date", 400),
    (msg(date="2021-11-3"), None, 200),
    (msg(date=20211123), "date_not_string", 500),
    (msg(observation_time=""), None, 200),
    (msg(observation_time="2400"), "invalid_observation_time", 500),
    (json.dumps({"message": {"data": base64.b64encode(msg().encode()).decode()}}), None, 200),
    (json.dumps({"message": {"data": msg()}}), None, 200),
]


@pytest.mark.parametrize("body,reason,code", CASES)
def test_validation(spark, body, reason, code):
    df = spark.createDataFrame([("m1", body)], "message_id string, body string")
    r = M.message_status(M.validate_messages(df)).first()
    assert (r["reject_reason"], r["status_code"]) == (reason, code)


def test_values_and_flags(spark):
    df = spark.createDataFrame([("a", msg(value="12.5")), ("b", msg(value=True))], "message_id string, body string")
    rows = {r["message_id"]: r for r in M.validate_messages(df).collect()}
    assert rows["a"]["value"] == 12.5 and rows["b"]["value"] == 1.0
    assert rows["a"]["quality_flag"] == ""  # streamed flags are kept as sent


def test_batch_status(spark):
    bodies = [("e1", "m1", msg()), ("e1", "m2", "{bad"), ("e2", "m3", "{bad"), ("e3", "m4", msg())]
    df = spark.createDataFrame(bodies, "event string, message_id string, body string")
    out = {r["event"]: r for r in M.batch_status(M.validate_messages(df), "event").collect()}
    assert (out["e1"]["status_code"], out["e1"]["status_message"]) == (200, "Processed 1 messages, failed 1")
    assert out["e2"]["status_code"] == 500
    assert out["e3"]["status_message"] == "Successfully processed 1 messages"


def test_queue_records(spark):
    ev = json.dumps({"Records": [{"messageId": "1", "body": msg()}, {"messageId": "2", "body": "{x"}]})
    recs = M.queue_records(spark.createDataFrame([(ev,), ("not an event",)], "value string"))
    v = {r["message_id"]: r["reject_reason"] for r in M.validate_messages(recs).collect()}
    assert v == {"1": None, "2": "invalid_json", None: "invalid_event_format"}


def test_event_outcomes(spark):
    envelope = json.dumps({"message": {"data": base64.b64encode(msg().encode()).decode()}})
    lines = {
        "empty": json.dumps({"eventId": "empty", "Records": []}),
        "nobody": json.dumps({"eventId": "nobody", "Records": [{"messageId": "1"}]}),
        "inside": json.dumps({"eventId": "inside", "Records": [{"messageId": "1", "body": envelope}, {"messageId": "2", "body": msg()}]}),
        "late": json.dumps({"eventId": "late", "Records": [{"messageId": "1", "body": msg(observation_time="25:00")}]}),
        "direct": envelope, "bare": msg(), "text": "no json",
    }
    v = M.validate_messages(M.queue_records(spark.createDataFrame([(x,) for x in lines.values()], "value string")))
    import hashlib
    names = {hashlib.sha256(x.encode()).hexdigest(): k for k, x in lines.items()}
    got = {names.get(r["event_id"], r["event_id"]): (r["processed"], r["failed"], r["status_code"], r["status_message"])
           for r in M.batch_status(v, "event_id").collect()}
    assert got == {
        "empty": (0, 0, 200, "Successfully processed 0 messages"), "nobody": (0, 1, 500, "Processed 0 messages, failed 1"),
        "inside": (1, 1, 200, "Processed 1 messages, failed 1"), "late": (0, 1, 500, "Processed 0 messages, failed 1"),
        "direct": (1, 0, 200, "Success"), "bare": (0, 1, 400, "Invalid event format"), "text": (0, 1, 400, "Invalid event format")}


def test_files_hold_a_message_an_envelope_or_an_event(spark, tmp_path):
    """A file's content is judged as the message; only lines of a queue have to be events."""
    event = json.dumps({"Records": [{"messageId": "a", "body": msg()}, {"messageId": "b"}]})
    docs = {"plain": msg(), "pretty": json.dumps(GOOD, indent=2), "broken": "{bad", "missing": msg(value=...), "array": json.dumps([GOOD]),
            "envelope": json.dumps({"message": {"data": base64.b64encode(msg().encode()).decode()}}), "event": event, "none": '{"Records": []}'}
    for name, text in docs.items():
        (tmp_path / f"{name}.json").write_text(text)
    v = M.validate_messages(M.read_message_files(spark, str(tmp_path)))
    got = [(r["event_kind"], r["reject_reason"]) for r in v.collect() if r["event_kind"] != "empty"]
    assert [k for k, _ in got].count("message") == 5
    assert sorted(x for _, x in got if x) == ["invalid_json", "invalid_json", "missing_value", "not_an_object"]
    assert M.accepted(v).count() == 4  # plain, pretty, the envelope, the event's first record
    status = {r["event_id"]: r for r in M.batch_status(v, "event_id").collect()}
    assert sorted(r["status_code"] for r in status.values()) == [200, 200, 200, 200, 200, 400, 400, 400]
