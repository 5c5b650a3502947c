"""Plan-shaping helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add ``expr`` as column ``name`` behind a one-row generator.

    Catalyst pushes a filter through projections by inlining the projected expressions, so a
    filter on a parsed value would evaluate the parser a second time below the projection.  A
    ``Generate`` node stops that: filters on ``name`` stay above it, filters on the input columns
    still pass below it, and ``explode_outer`` adds no inferred filter of its own.
    """
    return df.select("*", F.explode_outer(F.array(expr)).alias(name))
