"""Measures of the two grains (order line, order), defined once.

Every measure is stored as sums, minima and maxima only, so it can be merged
from partial groups.  Ratios are formed from the sums at the very end.
Unused measures are dropped by the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import sql_pct, sql_ratio, sql_spread

# name, merge function, value per row
LINE_PARTS = [
    ("total_order_lines", "sum", "1"),
    ("total_sales", "sum", "sales"),
    ("total_quantity", "sum", "quantity"),
    ("total_profit", "sum", "profit"),
    ("discount_sum", "sum", "discount"),
    ("discount_lines", "sum", "if(discount IS NOT NULL, 1, 0)"),
    ("comparable_sales", "sum", "if(profit IS NOT NULL, sales, NULL)"),
    ("comparable_profit", "sum", "if(sales IS NOT NULL, profit, NULL)"),
    ("unit_sales", "sum", "if(quantity IS NOT NULL, sales, NULL)"),
    ("unit_quantity", "sum", "if(sales IS NOT NULL, quantity, NULL)"),
    ("loss_making_lines", "sum", "if(profit < 0, 1, 0)"),
    ("unknown_sales_lines", "sum", "if(sales IS NULL, 1, 0)"),
    ("unknown_quantity_lines", "sum", "if(quantity IS NULL, 1, 0)"),
    ("unknown_profit_lines", "sum", "if(profit IS NULL, 1, 0)"),
    ("first_order_date", "min", "order_date"),
    ("last_order_date", "max", "order_date"),
]

_BOTH_KNOWN = "unknown_sales_lines = 0 AND unknown_profit_lines = 0"
ORDER_PARTS = [
    ("total_orders", "sum", "1"),
    ("total_order_lines", "sum", "total_order_lines"),
    ("total_product_references", "sum", "distinct_products"),
    ("total_sales", "sum", "total_sales"),
    ("total_quantity", "sum", "total_quantity"),
    ("total_profit", "sum", "total_profit"),
    ("complete_sales", "sum", "if(unknown_sales_lines = 0, total_sales, NULL)"),
    ("complete_sales_orders", "sum", "if(unknown_sales_lines = 0, 1, 0)"),
    ("complete_profit", "sum", "if(unknown_profit_lines = 0, total_profit, NULL)"),
    ("complete_profit_orders", "sum", "if(unknown_profit_lines = 0, 1, 0)"),
    ("comparable_sales", "sum", f"if({_BOTH_KNOWN}, total_sales, NULL)"),
    ("comparable_profit", "sum", f"if({_BOTH_KNOWN}, total_profit, NULL)"),
    ("unknown_sales_lines", "sum", "unknown_sales_lines"),
    ("unknown_quantity_lines", "sum", "unknown_quantity_lines"),
    ("unknown_profit_lines", "sum", "unknown_profit_lines"),
    ("orders_with_unknown_sales", "sum", "if(unknown_sales_lines > 0, 1, 0)"),
    ("orders_with_unknown_quantity", "sum", "if(unknown_quantity_lines > 0, 1, 0)"),
    ("orders_with_unknown_profit", "sum", "if(unknown_profit_lines > 0, 1, 0)"),
    ("unknown_ship_mode_orders", "sum", "if(ship_mode IS NULL, 1, 0)"),
    ("complete_loss_making_orders", "sum", "if(unknown_profit_lines = 0 AND total_profit < 0, 1, 0)"),
    ("shipping_days_sum", "sum", "bigint(shipping_days)"),
    ("shipping_days_squares", "sum", "bigint(shipping_days) * shipping_days"),
    ("minimum_shipping_days", "min", "shipping_days"),
    ("maximum_shipping_days", "max", "shipping_days"),
    ("same_day_orders", "sum", "if(shipping_days = 0, 1, 0)"),
    ("one_two_day_orders", "sum", "if(shipping_days BETWEEN 1 AND 2, 1, 0)"),
    ("three_four_day_orders", "sum", "if(shipping_days BETWEEN 3 AND 4, 1, 0)"),
    ("five_seven_day_orders", "sum", "if(shipping_days BETWEEN 5 AND 7, 1, 0)"),
    ("two_day_or_less_orders", "sum", "if(shipping_days <= 2, 1, 0)"),
    ("eight_plus_day_orders", "sum", "if(shipping_days >= 8, 1, 0)"),
    ("first_order_date", "min", "order_date"),
    ("last_order_date", "max", "order_date"),
]

_KNOWN_LINES = "total_order_lines - unknown_{}_lines"
LINE_RATIOS = {
    "average_line_discount": sql_ratio("discount_sum", "discount_lines"),
    "comparable_profit_margin_percentage": sql_pct("comparable_profit", "comparable_sales"),
    "comparable_average_unit_sales": sql_ratio("unit_sales", "unit_quantity"),
    "average_known_line_sales": sql_ratio("total_sales", _KNOWN_LINES.format("sales")),
    "average_known_line_profit": sql_ratio("total_profit", _KNOWN_LINES.format("profit")),
}
ORDER_RATIOS = {
    "average_complete_order_value": sql_ratio("complete_sales", "complete_sales_orders"),
    "average_complete_order_profit": sql_ratio("complete_profit", "complete_profit_orders"),
    "comparable_profit_margin_percentage": sql_pct("comparable_profit", "comparable_sales"),
    "average_shipping_days": sql_ratio("shipping_days_sum", "total_orders"),
    "shipping_days_stddev": sql_spread("total_orders", "shipping_days_sum", "shipping_days_squares"),
    "profit_margin_percentage": sql_pct("total_profit", "total_sales"),
    "purchase_span_days": "date_diff(last_order_date, first_order_date)",
}


def fold(parts) -> list[Column]:
    return [F.expr(f"{how}({value}) AS {name}") for name, how, value in parts]


def refold(parts) -> list[Column]:
    """Merge already folded groups."""
    return [F.expr(f"{how}({name}) AS {name}") for name, how, _ in parts]


def available(parts, df: DataFrame):
    """Leave out the dates when the rows were not joined to their orders."""
    return [p for p in parts if p[2] != "order_date" or "order_date" in df.columns]


def finish(df: DataFrame, ratios: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{text} AS {name}" for name, text in ratios.items()])


def line_rollup(detail: DataFrame, keys: list[str], parties: bool = True) -> DataFrame:
    """Line measures per ``keys``; with ``parties`` also orders and customers.

    An order belongs to one customer, so distinct orders and customers come from
    three nested groupings (order, customer, key).  Each step shrinks the rows
    before the next shuffle and a heavy key is spread over its orders, where
    several COUNT(DISTINCT) in one grouping would multiply the fact rows.
    """
    parts = available(LINE_PARTS, detail)
    if not parties:
        return finish(detail.groupBy(*keys).agg(*fold(parts)), LINE_RATIOS)
    per_order = detail.groupBy(*keys, "order_key", "customer_id").agg(*fold(parts))
    per_customer = per_order.groupBy(*keys, "customer_id").agg(
        *refold(parts), F.count(F.lit(1)).alias("total_orders")
    )
    per_key = per_customer.groupBy(*keys).agg(
        *refold(parts),
        F.sum("total_orders").alias("total_orders"),
        F.count(F.lit(1)).alias("distinct_customers"),
    )
    return finish(per_key, LINE_RATIOS)


def roll_up(per_part: DataFrame, members: DataFrame, on: str, keys: list[str]) -> DataFrame:
    """Fold lines per ``on`` first and attach its attributes to the few results."""
    parts = available(LINE_PARTS, per_part)
    folded = per_part.groupBy(on).agg(*fold(parts)).join(members, on)
    return finish(folded.groupBy(*keys).agg(*refold(parts)), LINE_RATIOS)


def order_rollup(
    orders: DataFrame, keys: list[str], distinct: dict[str, list[str]] | None = None
) -> DataFrame:
    """Order measures per ``keys``; ``distinct`` adds distinct counts.

    One distinct count is left to Spark's two-step plan.  For several, the rows
    are first folded to one per combination of the counted columns, so the row
    expansion Spark needs then works on that smaller set.
    """
    parts = ORDER_PARTS
    distinct = {"distinct_customers": ["customer_id"]} if distinct is None else distinct
    counts = [F.count_distinct(*[F.col(c) for c in cols]).alias(name)
              for name, cols in distinct.items()]
    if len(distinct) > 1:
        counted = list(dict.fromkeys(c for cols in distinct.values() for c in cols))
        extra = [c for c in counted if c not in keys]
        folded = orders.groupBy(*keys, *extra).agg(*fold(parts))
        return finish(folded.groupBy(*keys).agg(*refold(parts), *counts), ORDER_RATIOS)
    return finish(orders.groupBy(*keys).agg(*fold(parts), *counts), ORDER_RATIOS)

