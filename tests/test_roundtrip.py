"""parse(render(row)) == row for station lines and observation lines."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stationlake.sources import fixed_width as FW
from stationlake.sources import observations_csv as OC

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
ident = st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", min_size=1, max_size=11)
name = st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ ", min_size=1, max_size=30).map(str.strip).filter(bool)


@st.composite
def station(draw):
    return (draw(ident), draw(name),
            round(draw(st.floats(-90, 90)), 4), round(draw(st.floats(-180, 180)), 4),
            round(draw(st.floats(-400, 9000)), 1), draw(st.sampled_from(["US", "CA", "MX", "FR"])),
            draw(st.sampled_from(["NY", "TX", "ON", ""])), draw(st.integers(1800, 2024)),
            draw(st.integers(1800, 2024)))


def render(r):
    sid, nm, lat, lon, elev, country, state, first, last = r
    line = (f"{sid:<11} {lat:>8.4f} {lon:>9.4f} {elev:>6.1f} {country:<2} {nm:<30}{state:<2} "
            f"{first:<4} {last:<4}")
    return f"{line:<85}"


@SETTINGS
@given(st.lists(station(), min_size=1, max_size=20))
def test_station_roundtrip(spark, rows):
    df = spark.createDataFrame([(render(r),) for r in rows], "value string")
    got = sorted(tuple(x) for x in FW.accepted(FW.parse_station_lines(df)).collect())
    want = sorted((sid, nm, lat, lon, elev, c, s if c == "US" else "", f, la)
                  for sid, nm, lat, lon, elev, c, s, f, la in rows)
    assert got == want


@st.composite
def observation(draw):
    day = draw(st.dates(dt.date(1900, 1, 1), dt.date(2030, 12, 31)))
    element = draw(st.sampled_from(["TMAX", "TMIN", "TAVG", "PRCP", "SNOW", "SNWD", "WT01"]))
    value = draw(st.integers(-999, 9999))
    hh, mm = draw(st.integers(0, 23)), draw(st.integers(0, 59))
    qflag = draw(st.sampled_from(["", "I", "X"]))
    return draw(ident), day, element, value, qflag, hh, mm


@SETTINGS
@given(st.lists(observation(), min_size=1, max_size=20))
def test_observation_roundtrip(spark, rows):
    lines = [(f"{sid},{day:%Y%m%d},{el},{v},,{q},S,{hh:02d}{mm:02d}",) for sid, day, el, v, q, hh, mm in rows]
    acc = OC.accepted(OC.parse_observation_lines(spark.createDataFrame(lines, "value string")))
    got = sorted((r["station_id"], r["date"], r["element"], r["value"], r["quality_flag"], r["observation_time"])
                 for r in acc.collect())
    want = sorted((sid, day, el, v / 10.0 if el in ("TMAX", "TMIN", "TAVG", "PRCP") else float(v), q or None,
                   dt.datetime(day.year, day.month, day.day, hh, mm)) for sid, day, el, v, q, hh, mm in rows)
    assert got == want
