"""Pareto / ABC analysis over entities of any number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import dbl, fine, pct
from ventaria.operators.ordering import number_rows
from ventaria.operators.scalars import attach
from ventaria.session import settle

# Class limits and milestones, in percent.
CLASS_LIMITS = (("A", 80), ("B", 95))
LAST_CLASS = "C"
MILESTONES = (50, 80, 95)


def abc_class(cumulative: Column) -> Column:
    out = F.lit(LAST_CLASS)
    for label, limit in reversed(CLASS_LIMITS):
        out = F.when(cumulative <= limit, label).otherwise(out)
    return out


def cumulate(
    df: DataFrame, measure: str, unique: str, *, position: str, share: str,
    cumulative: str, running: str | None = None, by_share: bool = False,
) -> DataFrame:
    """Largest first: position, share of the total and cumulative share.

    By default the measure itself is accumulated; ``by_share`` accumulates the
    shares instead.  Both use exact fixed-point sums.
    """
    base = settle(df)
    base = attach(base, base.agg(F.sum(measure).alias("_total")))
    base = base.select("*", pct(measure, "_total").alias(share))
    source = "_piece" if by_share else measure
    if by_share:
        base = base.select("*", fine(share).alias("_piece"))
    out = number_rows(base, f"{measure} desc, {unique}", position=position,
                      running=(source, running or "_running"))
    run = F.col(running or "_running")
    return out.select("*", (dbl(run) if by_share else pct(run, "_total")).alias(cumulative))


def milestones(df: DataFrame, cumulative: str, position: str, names: list[str]) -> list[Column]:
    """How many of the largest members reach 50, 80 and 95 percent."""
    return [
        F.min(F.when(F.col(cumulative) >= limit, F.col(position))).alias(name)
        for limit, name in zip(MILESTONES, names)
    ]
