"""One-row results used beside every row of another frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def scalar_fields(one_row: DataFrame) -> dict[str, Column]:
    """Fields of a one-row frame as scalar-subquery columns (one subquery)."""
    names = one_row.columns
    packed = one_row.select(F.struct(*names).alias("packed")).scalar()
    return {n: packed.getField(n) for n in names}


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row without a join."""
    return df.select("*", *[c.alias(n) for n, c in scalar_fields(one_row).items()])
