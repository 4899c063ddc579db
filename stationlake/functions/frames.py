"""Plan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def freeze(df: DataFrame) -> DataFrame:
    """Stop filters from being pushed below ``df``'s projections.

    Catalyst pushes a filter through a projection by substituting the
    projected expressions into the condition. For parse-then-validate
    projections that duplicates the parsing in the predicate (once per
    reference). A one-row ``inline`` (a Generate node) is deterministic,
    code-generated and costs nothing, but filters that use its output stay
    above it.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
