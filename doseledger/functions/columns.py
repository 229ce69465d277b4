"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or replace a column that later filters and columns reuse instead of computing it again.

    The optimizer copies a plain column's expression into every filter above it, but not a
    generator's; an outer explode of one value gives one row per row. The value is a column of its
    own below the generator, where it is compiled.
    """
    held = f"__{name}"
    kept = [c for c in df.columns if c != name]
    return (
        df.withColumn(held, value)
        .select(*kept, held, F.explode_outer(F.array(held)).alias(name))
        .drop(held)
    )
