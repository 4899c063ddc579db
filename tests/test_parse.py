"""Table-driven tests of the parsing rules (one row per quirk)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationlake.functions.parse import (observation_time_batch, observation_time_stream, parse_number,
                                         parse_yyyymmdd, scale_units, strip_ws)
from stationlake.sources import fixed_width as FW
from stationlake.sources import observations_csv as OC


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("20220115", dt.date(2022, 1, 15)),
    ("2022011", dt.date(2022, 1, 1)),        # short day reads as day 1
    ("20220115XYZ", dt.date(2022, 1, 15)),   # trailing text ignored
    ("20221315", None),                      # month 13
    ("20220230", None),                      # no such day
    ("2022", None),
    ("abcd0101", None),
    ("", None),
])
def test_dates(spark, text, expected):
    assert one(spark, parse_yyyymmdd(F.col("x")), text) == expected


@pytest.mark.parametrize("time,expected", [
    ("0700", dt.datetime(2022, 1, 15, 7, 0)),
    ("07:30", dt.datetime(2022, 1, 15, 7, 30)),
    ("07", dt.datetime(2022, 1, 15, 7, 0)),
    ("2400", dt.datetime(2022, 1, 16, 0, 0)),   # midnight rolls to the next day
    ("700", None), ("7", None), ("24:00", None), ("2460", None), ("9999", None), ("xx", None), ("", None),
])
def test_batch_observation_time(spark, time, expected):
    df = spark.createDataFrame([(dt.date(2022, 1, 15), time)], "d date, t string")
    assert df.select(observation_time_batch("d", "t").alias("r")).first()["r"] == expected


@pytest.mark.parametrize("time,expected", [
    ("07:30", dt.datetime(2024, 1, 5, 7, 30)),
    ("07:30:15", dt.datetime(2024, 1, 5, 7, 30, 15)),
    ("", None), (None, None), ("2400", None), ("0700", None), ("15", None), ("25:00", None),
])
def test_stream_observation_time(spark, time, expected):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), time)], "d date, t string")
    assert df.select(observation_time_stream("d", "t").alias("r")).first()["r"] == expected


@pytest.mark.parametrize("text,to,expected", [
    ("12.5", "double", 12.5), ("  -3 ", "double", -3.0), ("", "double", 0.0), ("1e3", "double", 1000.0),
    ("12.5d", "double", None), ("1_0", "double", None), ("x", "double", None),
    ("1995", "int", 1995), ("", "int", 0), ("HCN", "int", None), ("19.5", "int", None),
])
def test_numbers(spark, text, to, expected):
    assert one(spark, parse_number(F.col("x"), to), text) == expected


@pytest.mark.parametrize("time,hour,minute,second", [
    ("07:00:05", 7, 0, 5), ("7:00", 7, 0, 0), ("7:5", 7, 5, 0), ("23:59:59", 23, 59, 59)])
def test_batch_times_of_one_or_two_digits(spark, time, hour, minute, second):
    df = spark.createDataFrame([(dt.date(2022, 1, 15), time)], "d date, t string")
    assert df.select(observation_time_batch("d", "t").alias("r")).first()["r"] == dt.datetime(2022, 1, 15, hour, minute, second)


def test_unreadable_stream_time_is_invalid(spark):
    from stationlake.functions.parse import stream_time_invalid
    df = spark.createDataFrame([(dt.date(2022, 1, 15), t) for t in ("25:00", "x", "07:00", "", None)], "d date, t string")
    assert [r[0] for r in df.select(stream_time_invalid("d", "t")).collect()] == [True, True, False, False, False]


def test_quoted_fields(spark):
    from stationlake.sources.observations_csv import parse_observation_lines
    lines = ['"A""B",20200101,"TM,AX",1.5,m,q,s,', '"x\\",20200101,TMAX,2,"q,r",,,']
    got = parse_observation_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.station_id, r.element, r.measurement_flag, r.reject_reason) for r in got] == [
        ('A"B', "TM,AX", "m", None), ("x\\", "TMAX", "q,r", None)]


def test_strip_removes_all_whitespace(spark):
    assert one(spark, strip_ws(F.col("x")), "\t ab c \n") == "ab c"


@pytest.mark.parametrize("element,value,expected", [
    ("TMAX", 215.0, 21.5), ("TMIN", -12.0, -1.2), ("TAVG", 100.0, 10.0), ("PRCP", 5.0, 0.5),
    ("SNOW", 5.0, 5.0), ("SNWD", 7.0, 7.0), ("WT01", 1.0, 1.0),
])
def test_scale_units(spark, element, value, expected):
    df = spark.createDataFrame([(element, value)], "e string, v double")
    assert df.select(scale_units("e", "v").alias("r")).first()["r"] == pytest.approx(expected)


def station_line(sid="XKT00031415", lat="40.7789", lon="-73.9692", elev="39.6", country="US",
                 name="NEW YORK CNTRL PK TWR", state="NY", first="1869", last="2023"):
    line = (f"{sid:<11} {lat:>8} {lon:>9} {elev:>6} {country:<2} {name:<30}{state:<2} {first:<4} {last:<4}")
    return f"{line:<85}"


@pytest.mark.parametrize("line,reason,row", [
    (station_line(), None, ("XKT00031415", "NEW YORK CNTRL PK TWR", 40.7789, -73.9692, 39.6, "US", "NY", 1869, 2023)),
    (station_line(country="CA", state="ON"), None,
     ("XKT00031415", "NEW YORK CNTRL PK TWR", 40.7789, -73.9692, 39.6, "CA", "", 1869, 2023)),
    (station_line(elev=""), None, ("XKT00031415", "NEW YORK CNTRL PK TWR", 40.7789, -73.9692, 0.0, "US", "NY", 1869, 2023)),
    (station_line()[:84], "short_line", None),
    (station_line(lat="x"), "invalid_number", None),
    (station_line(first="HCN"), "invalid_year", None),
    (station_line(name="BAD � NAME"), "invalid_encoding", None),
])
def test_station_lines(spark, line, reason, row):
    parsed = FW.parse_station_lines(spark.createDataFrame([(line,)], "value string"))
    r = parsed.first()
    assert r["reject_reason"] == reason
    if row is not None:
        assert tuple(FW.accepted(parsed).first()) == row
    assert FW.accepted(parsed).count() + FW.rejects(parsed).count() == 1


@pytest.mark.parametrize("line,reason,value,time", [
    ("USW1,20220115,TMAX,215,,,S,0700", None, 21.5, dt.datetime(2022, 1, 15, 7)),
    ("USW1,20220115,SNOW,5,,,S,", None, 5.0, None),
    ("USW1,20220115,TMAX,215,,,S,0700,EXTRA", None, 21.5, dt.datetime(2022, 1, 15, 7)),
    ('"USW1",20220115,TMAX,215,,,S,2400', None, 21.5, dt.datetime(2022, 1, 16)),
    ('USW1,20220115,TMAX,215,"a,b",,S,07:30', None, 21.5, dt.datetime(2022, 1, 15, 7, 30)),
    ("USW1,20220115,TMAX,215,,,S", "too_few_fields", None, None),
    ('USW1,20220115,TMAX,"2,1",,,S', "too_few_fields", None, None),
    ("USW1,20221315,TMAX,215,,,S,", "invalid_date", None, None),
    ("USW1,20220115,TMAX,abc,,,S,", "invalid_value", None, None),
])
def test_observation_lines(spark, line, reason, value, time):
    parsed = OC.parse_observation_lines(spark.createDataFrame([(line,)], "value string")).first()
    assert parsed["reject_reason"] == reason
    if reason is None:
        assert parsed["station_id"] == "USW1"
        assert parsed["value"] == pytest.approx(value)
        assert parsed["observation_time"] == time
        assert parsed["measurement_flag"] is None or parsed["measurement_flag"] == "a,b"


def test_bad_value_fail_mode(spark):
    parsed = OC.parse_observation_lines(spark.createDataFrame([("USW1,20220115,TMAX,abc,,,S,",)], "value string"))
    with pytest.raises(ValueError):
        OC.check_values(parsed, "fail")
    OC.check_values(parsed, "reject")
