"""Position of each entity against the mean of all entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import mean_of, mean_of_fine
from ventaria.operators.scalars import attach
from ventaria.session import settle

# Published labels.
NO_SALES = "Ventas desconocidas"
NO_MARGIN = "Sin margen comparable"


def quadrant_label(size_word: str, unknown_sales: bool) -> Column:
    """'Alto volumen - Baja rentabilidad' and its three siblings."""
    big = F.col("total_sales") >= F.col("sales_benchmark")
    small = F.col("total_sales") < F.col("sales_benchmark")
    good = F.col("comparable_profit_margin_percentage") >= F.col("margin_benchmark")
    bad = F.col("comparable_profit_margin_percentage") < F.col("margin_benchmark")
    out = F.when(F.col("total_sales").isNull(), NO_SALES) if unknown_sales else None
    no_margin = F.col("comparable_profit_margin_percentage").isNull()
    out = out.when(no_margin, NO_MARGIN) if out is not None else F.when(no_margin, NO_MARGIN)
    return (
        out.when(big & good, f"Alto {size_word} - Alta rentabilidad")
        .when(big & bad, f"Alto {size_word} - Baja rentabilidad")
        .when(small & good, f"Bajo {size_word} - Alta rentabilidad")
        .otherwise(f"Bajo {size_word} - Baja rentabilidad")
    )


def against_mean(df: DataFrame, known_sales_only: bool = False) -> DataFrame:
    """Add sales_benchmark, margin_benchmark and the distance to both."""
    base = settle(df)
    reference = base.where(F.col("total_sales").isNotNull()) if known_sales_only else base
    out = attach(base, reference.agg(
        mean_of("total_sales").alias("sales_benchmark"),
        mean_of_fine("comparable_profit_margin_percentage").alias("margin_benchmark"),
    ))
    return out.select(
        "*",
        (F.col("total_sales").cast("double") - F.col("sales_benchmark")).alias("sales_vs_benchmark"),
        (F.col("comparable_profit_margin_percentage") - F.col("margin_benchmark")).alias("margin_vs_benchmark_points"),
    )


def profile_order(profile: str, size_word: str) -> Column:
    """Sort rank of the quadrant labels: problem groups first."""
    order = [f"Alto {size_word} - Baja rentabilidad", f"Alto {size_word} - Alta rentabilidad",
             f"Bajo {size_word} - Baja rentabilidad", f"Bajo {size_word} - Alta rentabilidad", NO_MARGIN]
    out = F.lit(len(order) + 1)
    for place in range(len(order), 0, -1):
        out = F.when(F.col(profile) == order[place - 1], place).otherwise(out)
    return out
