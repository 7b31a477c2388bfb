"""Columns that are costly to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever uses it.

    The optimizer copies a projected expression into the filters above it, and an expression built
    on another holds it as often as it names it. A column generated from a list of one stays as it
    is.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(column)).alias(name))
