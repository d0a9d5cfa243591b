"""Check statements: views, business, category and product reports."""

from __future__ import annotations

from oracle.base import (BOTH, big, d, fine, growth, lines_by, mean, mean_fine, n_if, orders_by, pct, pick, q, r, ratio, rd)
from ventaria.plans.layouts import LAYOUTS as L

MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
MONTH_KEYS = "order_year, order_month, order_year_month"
PRODUCT = "product_key, product_id, product_name, category, sub_category"
PLACE = "region, country, state, city"
YEAR = "CAST(year(order_date) AS INTEGER) AS order_year"
DESC = "DESC NULLS LAST"
ASC = "ASC NULLS FIRST"

MONTH = f"mp AS ({orders_by(MONTH_KEYS)})"
CAT = f"cp AS ({lines_by('category')})"
SUBCAT = f"sp AS ({lines_by('category, sub_category')})"
PROD = f"pp AS ({lines_by(PRODUCT)})"

OVERVIEW = f"""bo AS (SELECT *, (SELECT COUNT(*) FROM products) AS total_products,
  (SELECT COUNT(DISTINCT category) FROM products) AS total_categories,
  (SELECT COUNT(*) FROM (SELECT DISTINCT category, sub_category FROM products)) AS total_subcategories,
  (SELECT COUNT(*) FROM (SELECT DISTINCT region, country, state, city, postal_code FROM headers)) AS total_locations,
  (SELECT COUNT(*) FROM region) AS total_regions, distinct_customers AS total_customers,
  CAST(last_order_date - first_order_date + 1 AS INTEGER) AS analysis_period_days,
  {ratio('total_orders', 'distinct_customers')} AS average_orders_per_customer,
  unknown_ship_mode_orders AS orders_with_unknown_ship_mode
  FROM ({orders_by('')}))"""

CUST = f"""cu AS ({orders_by('customer_id, customer_name, segment',
  "COUNT(DISTINCT (country, state, city, postal_code, region)) FILTER (WHERE country IS NOT NULL AND state IS NOT NULL AND city IS NOT NULL AND postal_code IS NOT NULL AND region IS NOT NULL) AS distinct_locations")})"""
CITY = f"gp AS ({orders_by(PLACE, 'COUNT(DISTINCT postal_code) AS distinct_postal_codes')})"
MODE = "COALESCE(ship_mode, 'Unknown') AS mode_name, CASE WHEN ship_mode IS NULL THEN 1 ELSE 0 END AS is_unknown"
SHIP = f"sm AS (SELECT *, mode_name AS ship_mode, is_unknown AS is_unknown_ship_mode FROM ({orders_by(MODE)}))"

SQL: dict[str, str] = {}

SQL["view_sales_detail"] = q(
    "SELECT order_detail_key, source_row_id, order_key, order_id, order_date, ship_date, shipping_days, ship_mode, customer_id, "
    "customer_name, segment, country, state, city, postal_code, region, product_key, product_id, product_name, category, "
    "sub_category, CAST(sales AS DOUBLE) AS sales, quantity, CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit FROM detail")
for name, table, cte in (
    ("view_order_summary", "vos", None), ("view_monthly_performance", "mp", MONTH), ("view_subcategory_performance", "sp", SUBCAT),
    ("view_customer_performance", "cu", CUST), ("view_geographic_performance", "gp", CITY), ("view_product_performance", "pp", PROD),
    ("view_segment_performance", "sg", f"sg AS ({orders_by('segment')})"), ("view_category_performance", "cp", CAT),
    ("view_ship_mode_performance", "sm", SHIP), ("view_business_overview", "bo", OVERVIEW),
):
    SQL[name] = q(f"SELECT {pick(L[name])} FROM {table}", *([cte] if cte else []))

SQL["executive_kpis"] = q(f"SELECT {pick(L['executive_kpis'])} FROM bo", OVERVIEW)


def lagged(table: str, order: str, cols: dict[str, str], part: str = "") -> str:
    over = f"OVER ({'PARTITION BY ' + part + ' ' if part else ''}ORDER BY {order})"
    return f"SELECT *, {', '.join(f'LAG({c}) {over} AS {n}' for n, c in cols.items())} FROM {table}"


PREV = {"o": "total_orders", "c": "distinct_customers", "s": "total_sales", "p": "total_profit"}


def grow(prefix: str) -> str:
    return (f"{growth('total_orders', 'o')} AS {prefix}_order_growth_percentage, {growth('distinct_customers', 'c')} AS {prefix}_customer_growth_percentage, "
            f"{growth('total_sales', 's')} AS {prefix}_sales_growth_percentage, total_profit - p AS {prefix}_profit_change")


SQL["annual_performance"] = q(
    f"SELECT {pick(L['annual_performance'])} FROM (SELECT *, {grow('year_over_year')} FROM b)",
    f"a AS ({orders_by('order_year')})", f"b AS ({lagged('a', 'order_year', PREV)})")
SQL["monthly_growth"] = q(
    f"SELECT {pick(L['monthly_growth'])} FROM (SELECT *, {grow('month_over_month')} FROM b)",
    MONTH, f"b AS ({lagged('mp', 'order_year, order_month', PREV)})")
SQL["year_range"] = q("SELECT MIN(order_year) AS first_year, MAX(order_year) AS last_year, COUNT(DISTINCT order_year) AS total_years FROM vos")
SQL["annual_conservation"] = q("""
SELECT w.o AS orders_summary, y.o AS orders_annual, y.o - w.o AS order_difference, w.l AS lines_summary, y.l AS lines_annual,
 y.l - w.l AS line_difference, CAST(w.s AS DOUBLE) AS sales_summary, CAST(y.s AS DOUBLE) AS sales_annual, CAST(y.s - w.s AS DOUBLE) AS sales_difference,
 w.q AS quantity_summary, y.q AS quantity_annual, y.q - w.q AS quantity_difference, CAST(w.p AS DOUBLE) AS profit_summary,
 CAST(y.p AS DOUBLE) AS profit_annual, CAST(y.p - w.p AS DOUBLE) AS profit_difference FROM w, y""",
    "w AS (SELECT COUNT(*) o, CAST(SUM(total_order_lines) AS BIGINT) l, SUM(total_sales) s, CAST(SUM(total_quantity) AS BIGINT) q, SUM(total_profit) p FROM vos)",
    "g AS (SELECT order_year, COUNT(*) o, SUM(total_order_lines) l, SUM(total_sales) s, SUM(total_quantity) q, SUM(total_profit) p FROM vos GROUP BY 1)",
    "y AS (SELECT CAST(SUM(o) AS BIGINT) o, CAST(SUM(l) AS BIGINT) l, SUM(s) s, CAST(SUM(q) AS BIGINT) q, SUM(p) p FROM g)")
SQL["month_range"] = q("SELECT MIN(order_year_month) AS first_month, MAX(order_year_month) AS last_month, COUNT(*) AS total_months FROM mp", MONTH)
SQL["repeated_months"] = q("SELECT order_year, order_month, COUNT(*) AS total_records FROM mp GROUP BY 1, 2 HAVING COUNT(*) > 1", MONTH)


def ranks(table: str, specs: dict[str, str], parts: dict[str, str] | None = None) -> str:
    parts = parts or {}
    cols = []
    for name, order in specs.items():
        col, way = order.split()
        p = f"PARTITION BY {parts[name]} " if name in parts else ""
        cols.append(f"DENSE_RANK() OVER ({p}ORDER BY {col} {DESC if way == 'desc' else ASC}) AS {name}")
    return f"SELECT *, {', '.join(cols)} FROM {table}"


SQL["month_ranking"] = q(f"SELECT {pick(L['month_ranking'])} FROM k", MONTH, "k AS (" + ranks("mp", {
    "sales_rank_best": "total_sales desc", "sales_rank_worst": "total_sales asc", "profit_rank_best": "total_profit desc",
    "profit_rank_worst": "total_profit asc", "order_rank_best": "total_orders desc", "order_rank_worst": "total_orders asc"}) + ")")
for name, order in (("top_months_by_sales", f"total_sales {DESC}"), ("top_months_by_profit", f"total_profit {DESC}"), ("bottom_months_by_profit", f"total_profit {ASC}")):
    SQL[name] = q(f"SELECT {pick(L[name])} FROM (SELECT * FROM mp ORDER BY {order}, order_year_month LIMIT 5)", MONTH)

SEASON = f"""se AS (SELECT order_month, {MONTHS}[order_month] AS month_name, COUNT(*) AS observed_periods, COUNT(DISTINCT order_year) AS observed_years,
 {mean('total_orders')} AS average_orders, {mean('distinct_customers')} AS average_distinct_customers, {mean('total_sales')} AS average_sales,
 {mean('total_quantity')} AS average_quantity, {mean('total_profit')} AS average_profit, {mean_fine('average_complete_order_value')} AS average_complete_order_value,
 MIN(total_sales) AS minimum_sales, MAX(total_sales) AS maximum_sales, MIN(total_profit) AS minimum_profit, MAX(total_profit) AS maximum_profit,
 {mean_fine(pct('total_order_lines - unknown_sales_lines', 'total_order_lines'))} AS average_sales_coverage_percentage,
 {mean_fine(pct('total_order_lines - unknown_profit_lines', 'total_order_lines'))} AS average_profit_coverage_percentage FROM mp GROUP BY order_month)"""
SQL["seasonality"] = q(f"SELECT {pick(L['seasonality'])} FROM k", MONTH, SEASON, "k AS (" + ranks("se", {
    "average_sales_rank": "average_sales desc", "average_profit_rank": "average_profit desc", "average_orders_rank": "average_orders desc"}) + ")")
SQL["calendar_months"] = q("SELECT COUNT(DISTINCT order_month) AS distinct_months, MIN(order_month) AS first_month, MAX(order_month) AS last_month FROM vos")
SQL["seasonal_coverage"] = q(f"SELECT order_month, {MONTHS}[order_month] AS month_name, COUNT(DISTINCT order_year) AS observed_years FROM mp GROUP BY order_month", MONTH)
SQL["months_by_average_sales"] = q(f"SELECT {pick(L['months_by_average_sales'])} FROM se", MONTH, SEASON)

# ---- category
SQL["category_comparison"] = q(f"SELECT {pick(L['category_comparison'])} FROM k", CAT, "k AS (" + ranks(
    f"(SELECT *, {pct('total_sales', 'SUM(total_sales) OVER ()')} AS sales_share_percentage, {pct('total_quantity', 'SUM(total_quantity) OVER ()')} AS quantity_share_percentage, "
    f"{pct('total_order_lines', 'SUM(total_order_lines) OVER ()')} AS order_line_share_percentage FROM cp)",
    {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc"}) + ")")


def share_total(n: str, m: str) -> str:
    return f"CAST(ROUND(CAST(CAST({100} * ({ratio(n, m)}) AS VARCHAR) AS DECIMAL(38,15)), 2) AS DOUBLE)"


SQL["category_share_totals"] = q(
    f"SELECT {share_total('SUM(total_sales)', '(SELECT SUM(sales) FROM detail)')} AS sales_share_total, "
    f"{share_total('SUM(total_quantity)', '(SELECT SUM(quantity) FROM detail)')} AS quantity_share_total, "
    f"{share_total('SUM(total_order_lines)', '(SELECT COUNT(*) FROM detail)')} AS order_line_share_total FROM cp", CAT)
SQL["category_rank_gap"] = q(
    f"SELECT {pick(L['category_rank_gap'])} FROM (SELECT *, profit_rank - sales_rank AS sales_profit_rank_gap, CASE WHEN profit_rank < sales_rank THEN 'Rentabilidad superior al volumen' "
    "WHEN profit_rank > sales_rank THEN 'Rentabilidad inferior al volumen' ELSE 'Rentabilidad alineada con ventas' END AS profitability_vs_sales FROM k)",
    CAT, "k AS (" + ranks("cp", {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc"}) + ")")
SQL["category_by_margin"] = q(f"SELECT {pick(L['category_by_margin'])} FROM cp", CAT)
BAND = ("CASE WHEN discount = 0 THEN 'Sin descuento' WHEN discount <= 0.10 THEN '01 - 10%' WHEN discount <= 0.20 THEN '11 - 20%' "
        "WHEN discount <= 0.30 THEN '21 - 30%' WHEN discount <= 0.50 THEN '31 - 50%' ELSE 'Más de 50%' END AS discount_range")
SQL["category_discount_bands"] = q(f"SELECT {pick(L['category_discount_bands'])} FROM ({lines_by('category, ' + BAND)})")
SQL["category_loss_discounts"] = q(
    f"SELECT category, {d('discount')} AS discount, COUNT(*) AS total_order_lines, {rd('SUM(sales)')} AS total_sales, {rd('SUM(profit)')} AS total_profit, "
    f"{r(mean('profit'))} AS average_known_profit, {n_if('profit < 0')} AS loss_making_lines FROM detail GROUP BY category, detail.discount HAVING SUM(profit) < 0")
YOY = {"o": "total_orders", "s": "total_sales", "p": "total_profit", "m": "comparable_profit_margin_percentage"}


def yearly(keys: str, part: str) -> str:
    rows = f"({lines_by(keys + ', ' + YEAR)})"
    return (f"SELECT *, {growth('total_orders', 'o')} AS year_over_year_order_growth_percentage, {growth('total_sales', 's')} AS year_over_year_sales_growth_percentage, "
            f"total_profit - p AS year_over_year_profit_change, comparable_profit_margin_percentage - m AS year_over_year_margin_change_points, "
            f"s AS previous_year_sales, p AS previous_year_profit, m AS previous_year_margin, total_sales AS current_year_sales, total_profit AS current_year_profit, "
            f"comparable_profit_margin_percentage AS current_year_margin, comparable_profit_margin_percentage AS current_margin, "
            f"{growth('total_sales', 's')} AS sales_growth_percentage, total_profit - p AS profit_change, comparable_profit_margin_percentage - m AS margin_change_points "
            f"FROM ({lagged(rows, 'order_year', YOY, part)})")


SQL["category_yearly"] = q(f"SELECT {pick(L['category_yearly'])} FROM y", f"y AS ({yearly('category', 'category')})")
for name, keys in (("category_year_coverage", "category"), ("subcategory_year_coverage", "category, sub_category")):
    SQL[name] = q(f"SELECT {keys}, CAST(MIN(year(order_date)) AS INTEGER) AS first_year, CAST(MAX(year(order_date)) AS INTEGER) AS last_year, COUNT(DISTINCT year(order_date)) AS observed_years FROM detail GROUP BY {keys}")
SQL["category_year_combinations"] = q("SELECT COUNT(*) AS category_year_combinations FROM (SELECT DISTINCT category, year(order_date) FROM detail)")

# ---- sub-category
SQL["subcategory_comparison"] = q(f"SELECT {pick(L['subcategory_comparison'])} FROM (SELECT *, global_profit_rank - global_sales_rank AS sales_profit_rank_gap FROM k)", SUBCAT, "k AS (" + ranks(
    f"(SELECT *, {pct('total_sales', 'SUM(total_sales) OVER ()')} AS global_sales_share_percentage, {pct('total_profit', 'SUM(total_profit) OVER ()')} AS global_profit_share_percentage, "
    f"{pct('total_sales', 'SUM(total_sales) OVER (PARTITION BY category)')} AS category_sales_share_percentage FROM sp)",
    {"global_sales_rank": "total_sales desc", "global_profit_rank": "total_profit desc", "global_margin_rank": "comparable_profit_margin_percentage desc",
     "category_sales_rank": "total_sales desc"}, {"category_sales_rank": "category"}) + ")")
SQL["subcategory_count_check"] = q(
    "SELECT m AS subcategories_model, a AS subcategories_analysed, a - m AS difference FROM (SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT category, sub_category FROM products)) AS m, (SELECT COUNT(*) FROM sp) AS a)", SUBCAT)
SQL["subcategory_share_check"] = q(
    f"SELECT category, CAST(ROUND(SUM({fine('s')}), 2) AS DOUBLE) AS category_sales_share_total FROM (SELECT category, {pct('total_sales', 'SUM(total_sales) OVER (PARTITION BY category)')} AS s FROM sp) GROUP BY category", SUBCAT)
SQL["subcategory_share_total"] = q(f"SELECT {share_total('SUM(total_sales)', '(SELECT SUM(sales) FROM detail)')} AS total_sales_share_percentage FROM sp", SUBCAT)


def quadrant(table: str, word: str, label: str, unknown: bool, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    first = "WHEN total_sales IS NULL THEN 'Ventas desconocidas' " if unknown else ""
    m = "comparable_profit_margin_percentage"
    return (f"SELECT *, {d('total_sales')} - sales_benchmark AS sales_vs_benchmark, {m} - margin_benchmark AS margin_vs_benchmark_points, CASE {first}WHEN {m} IS NULL THEN 'Sin margen comparable' "
            f"WHEN {d('total_sales')} >= sales_benchmark AND {m} >= margin_benchmark THEN 'Alto {word} - Alta rentabilidad' "
            f"WHEN {d('total_sales')} >= sales_benchmark AND {m} < margin_benchmark THEN 'Alto {word} - Baja rentabilidad' "
            f"WHEN {d('total_sales')} < sales_benchmark AND {m} >= margin_benchmark THEN 'Bajo {word} - Alta rentabilidad' "
            f"ELSE 'Bajo {word} - Baja rentabilidad' END AS {label} FROM {table}, "
            f"(SELECT {mean('total_sales')} AS sales_benchmark, {mean_fine(m)} AS margin_benchmark FROM {table}{w})")


LOW = f"{d('total_sales')} >= sales_benchmark AND comparable_profit_margin_percentage < margin_benchmark"
RISK = ("CASE WHEN total_profit < 0 THEN 'Beneficio acumulado negativo' WHEN comparable_profit_margin_percentage < 0 THEN 'Margen comparable negativo' "
        "WHEN loss_making_lines > 0 THEN 'Presenta líneas con pérdidas' ELSE 'Sin pérdidas conocidas' END")
SQ = f"sq AS ({quadrant('sp', 'volumen', 'performance_profile', False)})"
SQL["subcategory_quadrant"] = q(f"SELECT {pick(L['subcategory_quadrant'])} FROM sq", SUBCAT, SQ)
SQL["subcategory_high_volume_low_margin"] = q(f"SELECT {pick(L['subcategory_high_volume_low_margin'])} FROM sq WHERE {LOW}", SUBCAT, SQ)
SQL["subcategory_quadrant_distribution"] = q("SELECT performance_profile, COUNT(*) AS total_subcategories FROM sq GROUP BY 1", SUBCAT, SQ)


def pareto(table: str, key: str) -> str:
    w = f"ORDER BY total_sales {DESC}, {key}"
    return (f"SELECT *, {pct('total_sales', 'tot')} AS sales_share_percentage, {pct('cumulative_sales', 'tot')} AS cumulative_sales_percentage, "
            f"CASE WHEN {pct('cumulative_sales', 'tot')} <= 80 THEN 'A' WHEN {pct('cumulative_sales', 'tot')} <= 95 THEN 'B' ELSE 'C' END AS abc_classification FROM "
            f"(SELECT *, ROW_NUMBER() OVER ({w}) AS sales_position, SUM(total_sales) OVER () AS tot, "
            f"SUM(total_sales) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_sales FROM {table})")


def reach(col: str, pos: str, names: str) -> str:
    return ", ".join(f"MIN(CASE WHEN {col} >= {m} THEN {pos} END) AS {names.format(m)}" for m in (50, 80, 95))


SPAR = f"par AS ({pareto('sp', 'sub_category, category')})"
PPAR = f"par AS ({pareto('pp', 'product_key')})"
SQL["subcategory_pareto"] = q(f"SELECT {pick(L['subcategory_pareto'])} FROM par", SUBCAT, SPAR)
SQL["subcategory_milestones"] = q(f"SELECT {reach('cumulative_sales_percentage', 'sales_position', 'subcategories_for_{}_percent')} FROM par", SUBCAT, SPAR)
LOSSPCT = pct("loss_making_lines", "total_order_lines - unknown_profit_lines")
SQL["subcategory_risk"] = q(f"SELECT {pick(L['subcategory_risk'])} FROM (SELECT *, {RISK} AS risk_status FROM k)", SUBCAT, "k AS (" + ranks(
    f"(SELECT *, {LOSSPCT} AS lp FROM sp)", {"lowest_profit_rank": "total_profit asc", "loss_frequency_rank": "lp desc"}) + ")")
SQL["subcategory_negative_profit"] = q(f"SELECT {pick(L['subcategory_negative_profit'])} FROM sp WHERE total_profit < 0", SUBCAT)
SQL["subcategory_top_loss_lines"] = q(f"SELECT {pick(L['subcategory_top_loss_lines'])} FROM (SELECT * FROM sp WHERE total_order_lines - unknown_profit_lines > 0 ORDER BY {LOSSPCT} {DESC}, loss_making_lines DESC, sub_category, category LIMIT 5)", SUBCAT)
SUBY = f"y AS ({yearly('category, sub_category', 'category, sub_category')})"
DROP = "total_sales > previous_year_sales AND comparable_profit_margin_percentage < previous_year_margin"
SQL["subcategory_yearly"] = q(f"SELECT {pick(L['subcategory_yearly'])} FROM y", SUBY)
SQL["subcategory_growth_margin_drop"] = q(f"SELECT {pick(L['subcategory_growth_margin_drop'])} FROM y WHERE {DROP}", SUBY)

# ---- product
SQL["product_ranking"] = q(f"SELECT {pick(L['product_ranking'])} FROM (SELECT *, global_profit_rank - global_sales_rank AS sales_profit_rank_gap FROM k)", PROD, "k AS (" + ranks(
    f"(SELECT *, {pct('total_sales', 'SUM(total_sales) OVER ()')} AS global_sales_share_percentage FROM pp)",
    {"global_sales_rank": "total_sales desc", "global_profit_rank": "total_profit desc", "global_margin_rank": "comparable_profit_margin_percentage desc",
     "subcategory_sales_rank": "total_sales desc"}, {"subcategory_sales_rank": "category, sub_category"}) + ")")
for name, col in (("top_products_by_sales", "total_sales"), ("top_products_by_profit", "total_profit")):
    SQL[name] = q(f"SELECT {pick(L[name])} FROM (SELECT * FROM pp ORDER BY {col} {DESC}, product_name, product_key LIMIT 20)", PROD)
SQL["product_count_check"] = q("SELECT m AS products_model, a AS products_analysed, a - m AS difference FROM (SELECT (SELECT COUNT(*) FROM products) AS m, (SELECT COUNT(*) FROM pp) AS a)", PROD)
SQL["product_uniqueness"] = q("SELECT COUNT(*) AS total_products, COUNT(DISTINCT product_key) AS unique_product_keys, COUNT(*) - COUNT(DISTINCT product_key) AS duplicates FROM pp", PROD)
PQ = f"pq AS (SELECT *, {RISK} AS profitability_status FROM ({quadrant('pp', 'volumen', 'performance_profile', True)}))"
SQL["product_quadrant"] = q(f"SELECT {pick(L['product_quadrant'])} FROM pq", PROD, PQ)
SQL["product_high_volume_low_margin"] = q(f"SELECT {pick(L['product_high_volume_low_margin'])} FROM pq WHERE {LOW}", PROD, PQ)
SQL["product_negative_profit"] = q(f"SELECT {pick(L['product_negative_profit'])} FROM pp WHERE total_profit < 0", PROD)
SQL["product_quadrant_distribution"] = q("SELECT performance_profile, COUNT(*) AS total_products FROM pq GROUP BY 1", PROD, PQ)
SQL["product_pareto"] = q(f"SELECT {pick(L['product_pareto'])} FROM par", PROD, PPAR)
SQL["product_milestones"] = q(f"SELECT {reach('cumulative_sales_percentage', 'sales_position', 'products_for_{}_percent')} FROM par", PROD, PPAR)
SQL["product_abc_distribution"] = q(
    f"SELECT abc_classification, total_products, {r(pct('total_products', 'SUM(total_products) OVER ()'))} AS product_percentage, {rd('ts')} AS total_sales, {r(pct('ts', 'SUM(ts) OVER ()'))} AS sales_percentage "
    "FROM (SELECT abc_classification, COUNT(*) AS total_products, SUM(total_sales) AS ts FROM par GROUP BY 1)", PROD, PPAR)
SQL["product_share_total"] = q(f"SELECT {share_total('SUM(total_sales)', '(SELECT SUM(sales) FROM detail)')} AS total_sales_share_percentage FROM pp", PROD)
REUSED = "ru AS (SELECT product_id, COUNT(*) AS associated_products FROM products GROUP BY 1 HAVING COUNT(*) > 1)"
SQL["product_reused_codes"] = q(f"SELECT {pick(L['product_reused_codes'])} FROM k", PROD, REUSED, "k AS (" + ranks(
    f"(SELECT *, {pct('total_sales', 'SUM(total_sales) OVER (PARTITION BY product_id)')} AS source_id_sales_share_percentage FROM pp JOIN ru USING (product_id))",
    {"sales_rank_within_source_id": "total_sales desc"}, {"sales_rank_within_source_id": "product_id"}) + ")")
SQL["product_reuse_summary"] = q(
    f"SELECT COUNT(*) AS reused_product_ids, {big('SUM(associated_products)')} AS products_with_reused_ids, MIN(associated_products) AS minimum_products_per_id, "
    f"MAX(associated_products) AS maximum_products_per_id, {r(mean('associated_products'))} AS average_products_per_id FROM ru", REUSED)
SQL["product_reuse_impact"] = q(
    f"SELECT {rd('x.s')} AS reused_product_sales, {r(pct('x.s', 'y.s'))} AS reused_product_sales_percentage, {rd('x.p')} AS reused_product_profit, x.n AS reused_order_lines, {r(pct('x.n', 'y.n'))} AS reused_product_line_percentage FROM x, y",
    REUSED, "x AS (SELECT SUM(sales) s, SUM(profit) p, COUNT(*) n FROM detail WHERE product_id IN (SELECT product_id FROM ru))", "y AS (SELECT SUM(sales) s, COUNT(*) n FROM detail)")
PY = f"y AS ({yearly(PRODUCT, 'product_key')})"
SQL["product_yearly"] = q(f"SELECT {pick(L['product_yearly'])} FROM y", PY)
SQL["product_growth_margin_drop"] = q(f"SELECT {pick(L['product_growth_margin_drop'])} FROM y WHERE {DROP}", PY)
SQL["product_profit_flip"] = q(f"SELECT {pick(L['product_profit_flip'])} FROM y WHERE previous_year_profit > 0 AND total_profit < 0", PY)
SQL["product_observed_years"] = q("SELECT observed_years, COUNT(*) AS total_products FROM (SELECT product_key, COUNT(DISTINCT year(order_date)) AS observed_years FROM detail GROUP BY 1) GROUP BY 1")
