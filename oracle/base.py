"""Building blocks of the check statements (DuckDB dialect)."""

from __future__ import annotations

import re

ADAPTER = """
li AS (
  SELECT l_orderkey AS order_key, l_partkey AS product_key, l_orderkey * 8 + l_linenumber AS source_row_id,
         l_orderkey, l_partkey, l_suppkey, l_quantity,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS price,
         CAST(CAST(l_discount AS DECIMAL(4,2)) * 6 AS DECIMAL(4,2)) AS discount
  FROM lineitem),
lines AS (
  SELECT order_key, product_key, source_row_id, discount,
         CASE WHEN (l_orderkey + l_partkey) % 23 <> 0 THEN CAST(price * (1 - discount) AS DECIMAL(15,6)) END AS sales,
         CASE WHEN (l_partkey + l_suppkey) % 29 <> 0 THEN CAST(l_quantity AS INTEGER) END AS quantity,
         CASE WHEN (l_orderkey + l_suppkey) % 19 <> 0 THEN CAST(price * (1 - discount) - price * 0.70 AS DECIMAL(15,6)) END AS profit
  FROM li),
headers AS (
  SELECT o_orderkey AS order_key, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 11 AS INTEGER) AS ship_date,
         CAST(o_orderkey % 11 AS INTEGER) AS shipping_days,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
              WHEN '3-MEDIUM' THEN 'Second Class' WHEN '5-LOW' THEN 'Standard Class' END AS ship_mode,
         CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
         n_name AS country, n_name || '_S' || CAST((c_custkey + o_orderkey) % 12 % 4 AS VARCHAR) AS state,
         n_name || '_C' || CAST((c_custkey + o_orderkey) % 12 AS VARCHAR) AS city,
         CAST(n_nationkey * 100 + (c_custkey + o_orderkey) % 12 AS VARCHAR) AS postal_code, r_name AS region
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey),
products AS (
  SELECT p_partkey AS product_key, p_name AS product_id, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
         p_type AS category, p_brand AS sub_category FROM part),
detail AS (
  SELECT source_row_id AS order_detail_key, source_row_id, h.*, p.*, sales, quantity, discount, profit
  FROM lines JOIN headers h USING (order_key) JOIN products p USING (product_key)),
vos AS (
  SELECT order_key, order_id, order_date, CAST(year(order_date) AS INTEGER) AS order_year,
         CAST(month(order_date) AS INTEGER) AS order_month, strftime(order_date, '%Y-%m') AS order_year_month,
         ship_date, shipping_days, ship_mode, customer_id, customer_name, segment, country, state, city, postal_code, region,
         COUNT(*) AS total_order_lines, COUNT(DISTINCT product_key) AS distinct_products,
         SUM(sales) AS total_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
         CAST(SUM(discount) AS DOUBLE) / COUNT(discount) AS average_line_discount, SUM(profit) AS total_profit,
         COUNT(*) - COUNT(sales) AS unknown_sales_lines, COUNT(*) - COUNT(quantity) AS unknown_quantity_lines,
         COUNT(*) - COUNT(profit) AS unknown_profit_lines
  FROM detail GROUP BY ALL)
"""


def q(body: str, *ctes: str) -> str:
    """Complete statement: adapter CTEs, further CTEs, final select."""
    return "WITH " + ",\n".join([ADAPTER.strip(), *[c.strip() for c in ctes]]) + "\n" + body.strip()


def r(expr: str, digits: int = 2) -> str:
    """Decimal half-up rounding of a double by its shortest text, as double."""
    return f"CAST(ROUND(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


def rd(expr: str, digits: int = 2) -> str:
    """Rounding of an exact decimal, as double."""
    return f"CAST(ROUND({expr}, {digits}) AS DOUBLE)"


def d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def pct(n: str, m: str) -> str:
    return f"(CAST(100 AS DOUBLE) * CAST(({n}) AS DOUBLE) / NULLIF(CAST(({m}) AS DOUBLE), 0))"


def ratio(n: str, m: str) -> str:
    return f"(CAST(({n}) AS DOUBLE) / NULLIF(CAST(({m}) AS DOUBLE), 0))"


def growth(now: str, before: str) -> str:
    return pct(f"{now} - {before}", before)


def fine(expr: str) -> str:
    return f"CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(28,12))"


def mean(expr: str) -> str:
    return f"(CAST(SUM({expr}) AS DOUBLE) / COUNT({expr}))"


def mean_fine(expr: str) -> str:
    return f"(CAST(SUM({fine(expr)}) AS DOUBLE) / COUNT({expr}))"


def n_if(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


SPREAD = ("sqrt(CAST(COUNT(*) * SUM(CAST(shipping_days AS HUGEINT) * shipping_days) "
          "- SUM(shipping_days) * SUM(shipping_days) AS DOUBLE)) / COUNT(*)")

COMPLETE = "unknown_sales_lines = 0 AND unknown_profit_lines = 0"

# name -> aggregate over order rows
ORDER_AGG = {
    "total_orders": "COUNT(*)",
    "distinct_customers": "COUNT(DISTINCT customer_id)",
    "total_order_lines": big("SUM(total_order_lines)"),
    "total_product_references": big("SUM(distinct_products)"),
    "total_sales": "SUM(total_sales)",
    "total_quantity": big("SUM(total_quantity)"),
    "total_profit": "SUM(total_profit)",
    "average_complete_order_value": "CAST(SUM(total_sales) FILTER (WHERE unknown_sales_lines = 0) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE unknown_sales_lines = 0), 0)",
    "average_complete_order_profit": "CAST(SUM(total_profit) FILTER (WHERE unknown_profit_lines = 0) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE unknown_profit_lines = 0), 0)",
    "comparable_profit_margin_percentage": pct(f"SUM(total_profit) FILTER (WHERE {COMPLETE})", f"SUM(total_sales) FILTER (WHERE {COMPLETE})"),
    "profit_margin_percentage": pct("SUM(total_profit)", "SUM(total_sales)"),
    "average_shipping_days": "CAST(SUM(shipping_days) AS DOUBLE) / COUNT(*)",
    "minimum_shipping_days": "MIN(shipping_days)",
    "maximum_shipping_days": "MAX(shipping_days)",
    "shipping_days_stddev": SPREAD,
    "unknown_sales_lines": big("SUM(unknown_sales_lines)"),
    "unknown_quantity_lines": big("SUM(unknown_quantity_lines)"),
    "unknown_profit_lines": big("SUM(unknown_profit_lines)"),
    "orders_with_unknown_sales": n_if("unknown_sales_lines > 0"),
    "orders_with_unknown_quantity": n_if("unknown_quantity_lines > 0"),
    "orders_with_unknown_profit": n_if("unknown_profit_lines > 0"),
    "unknown_ship_mode_orders": n_if("ship_mode IS NULL"),
    "complete_loss_making_orders": n_if("unknown_profit_lines = 0 AND total_profit < 0"),
    "same_day_orders": n_if("shipping_days = 0"),
    "one_two_day_orders": n_if("shipping_days BETWEEN 1 AND 2"),
    "three_four_day_orders": n_if("shipping_days BETWEEN 3 AND 4"),
    "five_seven_day_orders": n_if("shipping_days BETWEEN 5 AND 7"),
    "two_day_or_less_orders": n_if("shipping_days <= 2"),
    "eight_plus_day_orders": n_if("shipping_days >= 8"),
    "first_order_date": "MIN(order_date)",
    "last_order_date": "MAX(order_date)",
    "purchase_span_days": "CAST(MAX(order_date) - MIN(order_date) AS INTEGER)",
}

BOTH = "sales IS NOT NULL AND profit IS NOT NULL"
UNIT = "sales IS NOT NULL AND quantity IS NOT NULL"

# name -> aggregate over order lines
LINE_AGG = {
    "total_order_lines": "COUNT(*)",
    "total_orders": "COUNT(DISTINCT order_key)",
    "distinct_customers": "COUNT(DISTINCT customer_id)",
    "distinct_products": "COUNT(DISTINCT product_key)",
    "distinct_subcategories": "COUNT(DISTINCT sub_category)",
    "total_sales": "SUM(sales)",
    "total_quantity": big("SUM(quantity)"),
    "total_profit": "SUM(profit)",
    "average_line_discount": "CAST(SUM(discount) AS DOUBLE) / COUNT(discount)",
    "average_known_line_sales": "CAST(SUM(sales) AS DOUBLE) / NULLIF(COUNT(sales), 0)",
    "average_known_line_profit": "CAST(SUM(profit) AS DOUBLE) / NULLIF(COUNT(profit), 0)",
    "comparable_profit_margin_percentage": pct(f"SUM(profit) FILTER (WHERE {BOTH})", f"SUM(sales) FILTER (WHERE {BOTH})"),
    "comparable_average_unit_sales": ratio(f"SUM(sales) FILTER (WHERE {UNIT})", f"SUM(quantity) FILTER (WHERE {UNIT})"),
    "loss_making_lines": n_if("profit < 0"),
    "unknown_sales_lines": "COUNT(*) - COUNT(sales)",
    "unknown_quantity_lines": "COUNT(*) - COUNT(quantity)",
    "unknown_profit_lines": "COUNT(*) - COUNT(profit)",
    "first_order_date": "MIN(order_date)",
    "last_order_date": "MAX(order_date)",
}


def _rollup(table: str, keys: str, aggs: dict[str, str], extra: str, where: str) -> str:
    named = re.findall(r" AS (\w+)(?:, |$)", keys)
    plain = [k for k in re.sub(r"(CASE|CAST|COALESCE|month).* AS \w+", "", keys).split(", ") if k.strip()]
    group = ", ".join(plain + named)
    inner = f"SELECT *{', ' + keys if ' AS ' in keys else ''} FROM {table}{' WHERE ' + where if where else ''}"
    head = ", ".join([group] if group else []) + (", " if group else "")
    body = ", ".join([f"{v} AS {k}" for k, v in aggs.items()] + ([extra] if extra else []))
    return f"SELECT {head}{body} FROM ({inner}) t" + (f" GROUP BY {group}" if group else "")


def orders_by(keys: str, extra: str = "", where: str = "", table: str = "vos") -> str:
    """Order measures per key list (expressions as 'expr AS name')."""
    return _rollup(table, keys, ORDER_AGG, extra, where)


def lines_by(keys: str, extra: str = "", where: str = "", table: str = "detail") -> str:
    return _rollup(table, keys, LINE_AGG, extra, where)


DERIVED = {
    "sales_coverage_percentage": pct("total_order_lines - unknown_sales_lines", "total_order_lines"),
    "quantity_coverage_percentage": pct("total_order_lines - unknown_quantity_lines", "total_order_lines"),
    "profit_coverage_percentage": pct("total_order_lines - unknown_profit_lines", "total_order_lines"),
    "known_loss_making_line_percentage": pct("loss_making_lines", "total_order_lines - unknown_profit_lines"),
    "known_loss_line_percentage": pct("loss_making_lines", "total_order_lines - unknown_profit_lines"),
    "complete_loss_making_order_percentage": pct("complete_loss_making_orders", "total_orders - orders_with_unknown_profit"),
    "average_discount_percentage": "average_line_discount * 100",
    "average_discount": "average_line_discount",
    **{f"{p}_percentage": pct(f"{p}_orders", "total_orders")
       for p in ("same_day", "one_two_day", "three_four_day", "five_seven_day", "two_day_or_less",
                 "eight_plus_day", "unknown_ship_mode")},
}
EXACT = {"total_sales", "total_profit", "cumulative_sales", "known_loss_amount", "minimum_sales", "maximum_sales",
         "minimum_profit", "maximum_profit", "previous_year_sales", "previous_year_profit", "current_year_sales",
         "current_year_profit", "profit_change", "year_over_year_profit_change", "yoy_profit_absolute_change",
         "month_over_month_profit_change", "total_negative_profit", "total_known_loss_amount"}
ROUNDED = re.compile(
    r"^average_|_percentage$|_points$|_benchmark$|_stddev$|_stddev_change$|_days_change$|^global_|^current_margin|_margin$|_vs_|_above_|"
    r"_average_days$|comparable_average|^ship_mode_average|_share$|_total$|average_shipping_days_change")
NOT_ROUNDED = {"global_orders", "global_order_lines", "global_quantity", "average_order_value_rank",
               "global_sales_rank", "global_profit_rank", "global_margin_rank",
               "average_sales_rank", "average_profit_rank", "average_orders_rank", "profitability_vs_sales"}
FOUR = {"average_line_discount", "average_discount"}


def pick(layout: str, have: tuple[str, ...] = ()) -> str:
    """Select list for a layout; names in ``have`` exist and hide the derived form."""
    out = []
    for item in layout.split():
        name, _, digits = item.partition(":")
        n = int(digits) if digits else (4 if name in FOUR else 2)
        if name == "known_profit_lines":
            out.append(f"total_order_lines - unknown_profit_lines AS {name}")
        elif name in DERIVED and name not in have:
            out.append(f"{r(DERIVED[name], n)} AS {name}")
        elif name in EXACT:
            out.append(f"{rd(name, n)} AS {name}")
        elif name not in NOT_ROUNDED and (digits or ROUNDED.search(name)):
            out.append(f"{r(name, n)} AS {name}")
        else:
            out.append(name)
    return ", ".join(out)
