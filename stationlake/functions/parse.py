"""Parsing columns for station lines, observation rows and message fields.

Each function returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlake.schemas import TENTHS_ELEMENTS

# A number as Python's float() reads it: optional sign, digits with an
# optional fraction or a bare fraction, optional exponent, surrounding
# whitespace; plus nan / inf / infinity in any case.
NUMBER_PATTERN = (r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
                  r"|(?i:nan|inf|infinity))\s*$")
INT_PATTERN = r"^\s*[+-]?\d+\s*$"
# Observation time shapes accepted after a date: HHmm, HH, H:m and H:m:s.
TIME_PATTERNS = {
    "hhmm": r"^([01]\d|2[0-3])[0-5]\d$",
    "hh_colon_mm": r"^([01]\d|2[0-3]):[0-5]\d$",
    "hh": r"^([01]\d|2[0-3])$",
    "parts": r"^\d{1,2}:[0-5]?\d(:[0-5]?\d)?$",  # one or two digits each, seconds if given
}
# Streamed times are cast together with the date: HH:mm or HH:mm:ss.
STREAM_TIME_PATTERN = r"^\s*\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?\s*$"
# Splits a CSV line at commas outside double quotes.
CSV_SPLIT_PATTERN = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of any kind (not only spaces)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def empty_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def parse_number(c, to: str = "double", blank_as_zero: bool = True) -> Column:
    """Text to double/int. Blank -> 0 (when asked); anything else that is not
    a number -> NULL."""
    t = strip_ws(c)
    pattern = NUMBER_PATTERN if to == "double" else INT_PATTERN
    if blank_as_zero:
        t = F.when(t == "", F.lit("0")).otherwise(t)
    return F.when(t.rlike(pattern), strip_ws(t)).try_cast(to)


def _int_slice(t: Column, pos: int, length: int) -> Column:
    s = F.substring(t, pos, length)
    return F.when(s.rlike(INT_PATTERN), F.trim(s)).try_cast("int")


def parse_yyyymmdd(c) -> Column:
    """YYYYMMDD text to DATE by slicing [0:4], [4:6], [6:8]; trailing text is
    ignored and a short day such as ``2022011`` reads as day 1. Built from
    integers (``try_make_timestamp_ntz``), not by formatting and re-parsing
    text; an impossible date is NULL."""
    t = _c(c)
    y, m, d = _int_slice(t, 1, 4), _int_slice(t, 5, 2), _int_slice(t, 7, 2)
    ts = F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0))
    return F.when(y >= 1, ts.cast("date"))


def observation_time_batch(date_col, time_col) -> Column:
    """Observation time of a batch row as TIMESTAMP_NTZ.

    ``2400`` is midnight of the next day; ``HHmm``, ``HH``, ``H:m`` and
    ``H:m:s`` (one or two digits) are read on the row's date; anything else
    (and empty) is NULL, row kept.
    """
    d, t = _c(date_col), _c(time_col)
    day = F.date_format(d, "yyyy-MM-dd")
    hhmm = F.concat(F.substring(t, 1, 2), F.lit(":"), F.substring(t, 3, 2))
    ts = (F.when(t == "2400", F.date_add(d, 1).cast("timestamp_ntz"))
          .when(t.rlike(TIME_PATTERNS["hhmm"]),
                F.to_timestamp_ntz(F.concat_ws(" ", day, hhmm), F.lit("yyyy-MM-dd HH:mm")))
          .when(t.rlike(TIME_PATTERNS["hh_colon_mm"]),
                F.to_timestamp_ntz(F.concat_ws(" ", day, t), F.lit("yyyy-MM-dd HH:mm")))
          .when(t.rlike(TIME_PATTERNS["parts"]), F.try_make_timestamp_ntz(
              F.year(d), F.month(d), F.dayofmonth(d), *[F.coalesce(F.get(F.split(t, ":"), F.lit(i)).try_cast("int"), F.lit(0))
                                                       for i in range(3)]))
          .when(t.rlike(TIME_PATTERNS["hh"]),
                F.to_timestamp_ntz(F.concat_ws(" ", day, t), F.lit("yyyy-MM-dd HH"))))
    return F.when(d.isNotNull(), ts)


def observation_time_stream(date_col, time_col) -> Column:
    """Streamed observation time: '' or NULL -> NULL; otherwise ``date time``
    must cast to a timestamp, else NULL (the caller marks the row failed)."""
    d, t = _c(date_col), _c(time_col)
    return F.when(t.isNull() | (t == ""), F.lit(None).cast("timestamp_ntz")).otherwise(
        F.when(t.rlike(STREAM_TIME_PATTERN),
               F.concat_ws(" ", F.date_format(d, "yyyy-MM-dd"), F.trim(t)).try_cast("timestamp_ntz")))


def stream_time_invalid(date_col, time_col) -> Column:
    """True when a streamed time is present but cannot be read (``25:00`` too)."""
    t = _c(time_col)
    return t.isNotNull() & (t != "") & observation_time_stream(date_col, time_col).isNull()


def scale_units(element_col, value_col) -> Column:
    """Tenths to units for TMIN/TMAX/TAVG/PRCP; other elements unchanged."""
    return F.when(_c(element_col).isin(TENTHS_ELEMENTS), _c(value_col) / 10.0).otherwise(_c(value_col))


def csv_field_count(line_col) -> Column:
    """Number of CSV fields, honouring double quotes. The quote-aware split is
    quadratic in line length, so it runs only on lines that contain a quote."""
    line = _c(line_col)
    return F.when(F.instr(line, '"') > 0,
                  F.size(F.split(line, CSV_SPLIT_PATTERN, -1))).otherwise(
        F.size(F.split(line, ",", -1)))
