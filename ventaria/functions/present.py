"""Report layout: choose, derive, round and name the output columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from ventaria.functions.expressions import sql_pct

_LOSS_LINES = sql_pct("loss_making_lines", "total_order_lines - unknown_profit_lines")
DERIVED = {
    **{f"{m}_coverage_percentage": sql_pct(f"total_order_lines - unknown_{m}_lines", "total_order_lines")
       for m in ("sales", "quantity", "profit")},
    "known_loss_making_line_percentage": _LOSS_LINES,
    "known_loss_line_percentage": _LOSS_LINES,
    "complete_loss_making_order_percentage":
        sql_pct("complete_loss_making_orders", "total_orders - orders_with_unknown_profit"),
    "average_discount_percentage": "(average_line_discount * 100)",
    "average_discount": "average_line_discount",
    **{f"{part}_percentage": sql_pct(f"{part}_orders", "total_orders")
       for part in ("same_day", "one_two_day", "three_four_day", "five_seven_day",
                    "two_day_or_less", "eight_plus_day", "unknown_ship_mode")},
}
COUNTS = {"known_profit_lines": "total_order_lines - unknown_profit_lines"}

_FOUR_DIGITS = {"average_line_discount", "average_discount"}


def derive(df: DataFrame, *names: str) -> DataFrame:
    """Add shared derived measures that later steps (ranks, filters) refer to."""
    return df.selectExpr("*", *[f"{DERIVED[n]} AS {n}" for n in names if n not in df.columns])


def present(df: DataFrame, layout: str) -> DataFrame:
    """Project ``layout``: blank separated names, ``name:4`` for other rounding.

    Decimal and double columns are rounded (two digits unless told otherwise)
    and returned as double; all other columns pass through.
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for item in layout.split():
        name, _, digits = item.partition(":")
        places = int(digits) if digits else (4 if name in _FOUR_DIGITS else 2)
        if name in schema:
            numeric = isinstance(schema[name], (DecimalType, DoubleType, FloatType))
            out.append(f"double(round({name}, {places})) AS {name}" if numeric else name)
        elif name in COUNTS:
            out.append(f"{COUNTS[name]} AS {name}")
        else:
            out.append(f"double(round({DERIVED[name]}, {places})) AS {name}")
    return df.selectExpr(*out)
