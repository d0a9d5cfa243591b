"""Comparison with the previous available period of the same entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def with_previous(df: DataFrame, order: list[str], previous: dict[str, str], partition: tuple[str, ...] = ()) -> DataFrame:
    """Add ``{new name: column}`` holding the value of the previous row.

    The previous row is the last period that exists, not the last on the
    calendar.  A group holds one row per period, so it stays small.
    """
    over = Window.partitionBy(*partition).orderBy(*order)
    return df.select("*", *[F.lag(c).over(over).alias(n) for n, c in previous.items()])
