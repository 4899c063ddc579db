"""Date predicates that also name the year/month partition columns.

A Parquet table partitioned by (year, month) is not pruned by a predicate on
``date`` alone: the date filter is pushed into the file reader but every
directory is still listed and opened. Adding the implied year/month
predicates lets Spark prune directories (``PartitionFilters`` in the plan).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(x) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x))


def _ym(d: dt.date) -> int:
    return d.year * 100 + d.month


def _ym_col() -> Column:
    return F.col("year") * 100 + F.col("month")


def date_equals(day, date_col: str = "date") -> Column:
    d = _d(day)
    return (F.col(date_col) == F.lit(d)) & (F.col("year") == d.year) & (F.col("month") == d.month)


def date_between(lo, hi, date_col: str = "date") -> Column:
    a, b = _d(lo), _d(hi)
    return (F.col(date_col).between(F.lit(a), F.lit(b)) & F.col("year").between(a.year, b.year)
            & _ym_col().between(_ym(a), _ym(b)))


def date_before(day, inclusive: bool = False, date_col: str = "date") -> Column:
    d = _d(day)
    c = F.col(date_col) <= F.lit(d) if inclusive else F.col(date_col) < F.lit(d)
    return c & (F.col("year") <= d.year) & (_ym_col() <= _ym(d))


def date_after(day, inclusive: bool = False, date_col: str = "date") -> Column:
    d = _d(day)
    c = F.col(date_col) >= F.lit(d) if inclusive else F.col(date_col) > F.lit(d)
    return c & (F.col("year") >= d.year) & (_ym_col() >= _ym(d))
