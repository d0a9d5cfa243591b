"""Check statements: customer, geography, logistics and period reports."""

from __future__ import annotations

from oracle.base import (
    ORDER_AGG, big, d, fine, growth, lines_by, mean, mean_fine, n_if, orders_by, pct, pick, q, r, ratio, rd)
from oracle.reports_a import (
    ASC, CITY, CUST, DESC, LOW, MODE, MONTHS, PLACE, PRODUCT, SHIP, lagged, quadrant, ranks, reach, share_total)
from ventaria.plans.layouts import LAYOUTS as L

SQL: dict[str, str] = {}
GAP = "profit_rank - sales_rank AS sales_profit_rank_gap"

# ---- customer
SQL["customer_ranking"] = q(f"SELECT {pick(L['customer_ranking'])} FROM (SELECT *, {GAP} FROM k)", CUST, "k AS (" + ranks(
    f"(SELECT *, {pct('total_sales', 'SUM(total_sales) OVER ()')} AS global_sales_share_percentage FROM cu)",
    {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc", "order_frequency_rank": "total_orders desc",
     "average_order_value_rank": "average_complete_order_value desc"}) + ")")
SQL["top_customers_by_sales"] = q(f"SELECT {pick(L['top_customers_by_sales'])} FROM (SELECT * FROM cu ORDER BY total_sales {DESC}, customer_name, customer_id LIMIT 20)", CUST)
SQL["customer_count_check"] = q("SELECT m AS customers_model, a AS customers_analysed, a - m AS difference FROM (SELECT (SELECT COUNT(*) FROM customer) AS m, (SELECT COUNT(*) FROM cu) AS a)", CUST)
SQL["customer_uniqueness"] = q("SELECT COUNT(*) AS total_customers, COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) - COUNT(DISTINCT customer_id) AS duplicates FROM cu", CUST)
VF = """vf AS (SELECT *, CASE WHEN value_group = 2 AND frequency_group = 2 THEN 'Alto valor - Alta frecuencia' WHEN value_group = 2 AND frequency_group = 1 THEN 'Alto valor - Baja frecuencia'
 WHEN value_group = 1 AND frequency_group = 2 THEN 'Bajo valor - Alta frecuencia' ELSE 'Bajo valor - Baja frecuencia' END AS customer_profile FROM (SELECT *,
 CAST(NTILE(2) OVER (ORDER BY total_sales, customer_id) AS INTEGER) AS value_group, CAST(NTILE(2) OVER (ORDER BY total_orders, customer_id) AS INTEGER) AS frequency_group FROM cu WHERE total_sales IS NOT NULL))"""
SQL["customer_value_frequency"] = q(f"SELECT {pick(L['customer_value_frequency'])} FROM vf", CUST, VF)


def summary(table: str, by: str, layout: str, extra: str = "") -> str:
    return (f"SELECT {pick(layout)} FROM (SELECT *, {pct('total_sales', 'SUM(total_sales) OVER ()')} AS sales_share_percentage, {pct('total_customers', 'SUM(total_customers) OVER ()')} AS customer_percentage FROM "
            f"(SELECT {by}, COUNT(*) AS total_customers, {mean('total_orders')} AS average_orders, {mean('total_sales')} AS average_customer_sales, {extra}"
            f"SUM(total_sales) AS total_sales, SUM(total_profit) AS total_profit FROM {table} GROUP BY {by}))")


TAIL = "average_orders average_customer_sales total_sales total_profit sales_share_percentage"
SQL["customer_profile_summary"] = q(summary("vf", "customer_profile", f"customer_profile total_customers {TAIL}"), CUST, VF)
SQL["customers_without_sales"] = q("SELECT COUNT(*) AS customers_without_known_sales FROM cu WHERE total_sales IS NULL", CUST)
SQL["customers_with_sales"] = q("SELECT COUNT(*) AS customers_with_known_sales FROM cu WHERE total_sales IS NOT NULL", CUST)
RFM = """rf AS (SELECT *, recency_score + frequency_score + monetary_score AS rfm_total_score, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR) AS rfm_code,
 CASE WHEN recency_score >= 3 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'Clientes de alto valor' WHEN recency_score = 4 AND frequency_score >= 2 THEN 'Clientes recientes'
 WHEN frequency_score >= 3 AND monetary_score >= 3 THEN 'Clientes leales' WHEN recency_score <= 2 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'Clientes valiosos en riesgo'
 WHEN recency_score <= 2 AND frequency_score <= 2 THEN 'Clientes inactivos' ELSE 'Clientes intermedios' END AS rfm_segment FROM (SELECT *,
 CAST(NTILE(4) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS recency_score, CAST(NTILE(4) OVER (ORDER BY total_orders, customer_id) AS INTEGER) AS frequency_score,
 CAST(NTILE(4) OVER (ORDER BY total_sales, customer_id) AS INTEGER) AS monetary_score FROM (SELECT *, MAX(last_order_date) OVER () AS analysis_reference_date,
 CAST(MAX(last_order_date) OVER () - last_order_date AS INTEGER) AS recency_days FROM cu WHERE total_sales IS NOT NULL)))"""
SQL["customer_rfm"] = q(f"SELECT {pick(L['customer_rfm'])} FROM rf", CUST, RFM)
SQL["customer_rfm_summary"] = q(summary("rf", "rfm_segment", f"rfm_segment total_customers average_recency_days {TAIL}", f"{mean('recency_days')} AS average_recency_days, "), CUST, RFM)
CQ = (f"cq AS (SELECT *, CASE WHEN total_profit < 0 THEN 'Beneficio acumulado conocido negativo' WHEN complete_loss_making_orders > 0 THEN 'Presenta pedidos completos con pérdidas' "
      f"ELSE 'Sin pérdidas completas conocidas' END AS loss_status FROM ({quadrant('cu', 'valor', 'profitability_profile', True, 'total_sales IS NOT NULL')}))")
SQL["customer_profitability"] = q(f"SELECT {pick(L['customer_profitability'])} FROM cq", CUST, CQ)
SQL["customer_high_sales_low_margin"] = q(f"SELECT {pick(L['customer_high_sales_low_margin'])} FROM cq WHERE {LOW}", CUST, CQ)
SQL["customer_negative_profit"] = q(f"SELECT {pick(L['customer_negative_profit'])} FROM cu WHERE total_profit < 0", CUST)
SQL["customer_loss_orders"] = q(f"SELECT {pick(L['customer_loss_orders'])} FROM cu WHERE total_orders - orders_with_unknown_profit > 0 AND complete_loss_making_orders > 0", CUST)
ACT = f"""ac AS (SELECT *, CASE WHEN total_orders = 1 THEN 'Compra única' WHEN active_months = 1 THEN 'Recurrente en un solo mes' WHEN active_years = 1 THEN 'Recurrente dentro de un año' ELSE 'Recurrente multianual' END AS recurrence_profile,
 purchase_span_days AS customer_lifetime_days, {ratio('total_sales', 'total_orders')} AS average_known_sales_per_order FROM
 ({orders_by('customer_id, customer_name, segment', 'COUNT(DISTINCT order_year_month) AS active_months, COUNT(DISTINCT order_year) AS active_years')}))"""
SQL["customer_recurrence"] = q(f"SELECT {pick(L['customer_recurrence'])} FROM ac", ACT)
SQL["customer_recurrence_summary"] = q(summary("ac", "recurrence_profile", "recurrence_profile total_customers customer_percentage average_orders average_customer_lifetime_days average_customer_sales total_sales total_profit sales_share_percentage",
                                               f"{mean('customer_lifetime_days')} AS average_customer_lifetime_days, "), ACT)
SQL["repeat_customers"] = q(f"SELECT COUNT(*) AS total_customers, {n_if('n > 1')} AS repeat_customers, {n_if('n = 1')} AS one_time_customers, {r(pct('COUNT(*) FILTER (WHERE n > 1)', 'COUNT(*)'))} AS repeat_customer_percentage FROM (SELECT COUNT(*) n FROM vos GROUP BY customer_id)")
COHORT = """fi AS (SELECT customer_id, date_trunc('month', MIN(order_date)) AS cohort FROM vos GROUP BY 1),
am AS (SELECT DISTINCT customer_id, date_trunc('month', order_date) AS active FROM vos),
sz AS (SELECT cohort, COUNT(*) AS cohort_size FROM fi GROUP BY 1),
rt AS (SELECT cohort, CAST(datediff('month', cohort, active) AS INTEGER) AS m, COUNT(DISTINCT customer_id) AS n FROM fi JOIN am USING (customer_id) WHERE active >= cohort GROUP BY 1, 2)"""
SQL["cohort_retention"] = q(f"SELECT strftime(cohort, '%Y-%m') AS cohort_month, m AS months_since_first_order, cohort_size, n AS active_customers, {r(pct('n', 'cohort_size'))} AS retention_percentage FROM rt JOIN sz USING (cohort)", COHORT)
SQL["cohort_milestones"] = q("SELECT strftime(cohort, '%Y-%m') AS cohort_month, cohort_size, observable_months, " + ", ".join(
    f"CASE WHEN observable_months >= {m} THEN {r(pct(f'COALESCE(m{m}, 0)', 'cohort_size'))} END AS retention_month_{m}_percentage" for m in (1, 3, 6, 12)) +
    " FROM (SELECT cohort, cohort_size, CAST(datediff('month', cohort, (SELECT MAX(active) FROM am)) AS INTEGER) AS observable_months, " +
    ", ".join(f"MAX(CASE WHEN m = {m} THEN n END) AS m{m}" for m in (1, 3, 6, 12)) + " FROM sz LEFT JOIN rt USING (cohort) GROUP BY cohort, cohort_size)", COHORT)
SQL["new_customers"] = q("SELECT strftime(cohort, '%Y-%m') AS cohort_month, cohort_size AS new_customers FROM sz", COHORT)
SQL["cohort_check"] = q("SELECT COUNT(*) AS customers_in_cohorts, COUNT(DISTINCT customer_id) AS unique_customers, (SELECT COUNT(*) FROM customer) AS customers_model, COUNT(*) - (SELECT COUNT(*) FROM customer) AS difference FROM fi", COHORT)
KNOWN = "unknown_sales_lines = 0 AND unknown_profit_lines = 0"
SEG = f"""sc AS (SELECT segment, COUNT(*) AS total_customers, {big('SUM(total_orders)')} AS total_orders, {mean('total_orders')} AS average_orders_per_customer, {big('SUM(total_order_lines)')} AS total_order_lines,
 SUM(total_sales) AS total_sales, {mean('total_sales')} AS average_sales_per_customer, SUM(total_profit) AS total_profit, {mean('total_profit')} AS average_profit_per_customer,
 {mean_fine('average_complete_order_value')} AS average_customer_order_value, {pct(f'SUM(total_profit) FILTER (WHERE {KNOWN})', f'SUM(total_sales) FILTER (WHERE {KNOWN})')} AS comparable_profit_margin_percentage,
 {n_if('total_orders > 1')} AS repeat_customers, {n_if('total_orders = 1')} AS one_time_customers, {n_if('year(first_order_date) < year(last_order_date)')} AS multi_year_customers,
 {mean('purchase_span_days')} AS average_purchase_span_days, {n_if('total_profit < 0')} AS customers_with_negative_profit, {big('SUM(complete_loss_making_orders)')} AS complete_loss_making_orders,
 {big('SUM(unknown_sales_lines)')} AS unknown_sales_lines, {big('SUM(unknown_profit_lines)')} AS unknown_profit_lines FROM cu GROUP BY segment)"""
SQL["segment_comparison"] = q(f"SELECT {pick(L['segment_comparison'])} FROM k", CUST, SEG, "k AS (" + ranks(
    f"(SELECT *, {pct('repeat_customers', 'total_customers')} AS repeat_customer_percentage, {pct('multi_year_customers', 'total_customers')} AS multi_year_customer_percentage, "
    f"{pct('customers_with_negative_profit', 'total_customers')} AS negative_profit_customer_percentage FROM sc)",
    {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc", "customer_value_rank": "average_sales_per_customer desc"}) + ")")
SQL["segment_share"] = q(f"SELECT segment, total_customers, {r(pct('total_customers', 'SUM(total_customers) OVER ()'))} AS customer_share_percentage, {rd('total_sales')} AS total_sales, "
                         f"{r(pct('total_sales', 'SUM(total_sales) OVER ()'))} AS sales_share_percentage, {rd('total_profit')} AS total_profit FROM sc", CUST, SEG)


def twice(cols: dict[str, tuple[str, str, str]], left: str, right: str) -> str:
    out = []
    for c, (a, b, diff) in cols.items():
        wrap = d if c in ("total_sales", "total_profit") else big
        out += [f"{wrap('l.' + c)} AS {a}", f"{wrap('r.' + c)} AS {b}", f"{wrap(f'r.{c} - l.{c}')} AS {diff}"]
    return f"SELECT {', '.join(out)} FROM ({left}) l, ({right}) r"


SUM4 = "SUM(total_orders) AS total_orders, SUM(total_sales) AS total_sales, SUM(total_profit) AS total_profit"
SQL["segment_conservation"] = q(twice({
    "total_customers": ("customers_original", "customers_segmented", "customer_difference"), "total_orders": ("orders_original", "orders_segmented", "order_difference"),
    "total_sales": ("sales_original", "sales_segmented", "sales_difference"), "total_profit": ("profit_original", "profit_segmented", "profit_difference")},
    f"SELECT COUNT(*) AS total_customers, {SUM4} FROM cu", f"SELECT SUM(total_customers) AS total_customers, {SUM4} FROM sc"), CUST, SEG)

# ---- geography
CITYKEY = "country, state, city, region"
SQL["city_ranking"] = q(f"SELECT {pick(L['city_ranking'])} FROM (SELECT *, {GAP} FROM k)", CITY, "k AS (" + ranks(
    f"(SELECT *, {pct('total_sales', 'SUM(total_sales) OVER ()')} AS global_sales_share_percentage FROM gp)",
    {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc",
     "regional_sales_rank": "total_sales desc"}, {"regional_sales_rank": "region"}) + ")")
for name, col in (("top_cities_by_sales", "total_sales"), ("top_cities_by_profit", "total_profit")):
    SQL[name] = q(f"SELECT {pick(L[name])} FROM (SELECT * FROM gp ORDER BY {col} {DESC}, country, state, city LIMIT 20)", CITY)
SQL["city_uniqueness"] = q("SELECT COUNT(*) AS total_cities, COUNT(DISTINCT (region, country, state, city)) AS unique_cities, COUNT(*) - COUNT(DISTINCT (region, country, state, city)) AS duplicates FROM gp", CITY)
GQ = (f"gq AS (SELECT *, CASE WHEN total_profit < 0 THEN 'Beneficio acumulado negativo' WHEN complete_loss_making_orders > 0 THEN 'Presenta pedidos completos con pérdidas' "
      f"ELSE 'Sin pérdidas completas conocidas' END AS profitability_status, sales_benchmark AS average_city_sales, sales_vs_benchmark AS sales_above_average FROM ({quadrant('gp', 'volumen', 'geographic_profile', True, 'total_sales IS NOT NULL')}))")
SQL["city_quadrant"] = q(f"SELECT {pick(L['city_quadrant'])} FROM gq", CITY, GQ)
SQL["city_high_sales_loss"] = q(f"SELECT {pick(L['city_high_sales_loss'])} FROM gq WHERE {d('total_sales')} >= sales_benchmark AND total_profit < 0", CITY, GQ)


def shares(table: str, **named: str) -> str:
    return f"(SELECT *, {', '.join(f'{pct(c, f"SUM({c}) OVER ()")} AS {n}' for n, c in named.items())} FROM {table})"


SQL["region_performance"] = q(f"SELECT {pick(L['region_performance'])} FROM (SELECT *, {GAP} FROM k)", f"rg AS ({orders_by('region')})", "k AS (" + ranks(
    shares("rg", sales_share_percentage="total_sales", order_share_percentage="total_orders"),
    {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc"}) + ")")
for key in ("region", "country"):
    SQL[f"{key}_share_check"] = q(f"SELECT {share_total('SUM(n)', '(SELECT COUNT(*) FROM vos)')} AS order_share_total, {share_total('SUM(s)', '(SELECT SUM(total_sales) FROM vos)')} AS sales_share_total FROM (SELECT COUNT(*) n, SUM(total_sales) s FROM vos GROUP BY {key})")
    SQL[f"{key}_negative_profit"] = q(f"SELECT {pick(L.get(key + '_negative_profit', key))} FROM ({orders_by(key)}) WHERE total_profit < 0")
del SQL["region_negative_profit"]
SQL["region_count"] = q("SELECT COUNT(DISTINCT region) AS total_regions FROM vos")
SQL["country_count"] = q("SELECT COUNT(DISTINCT country) AS total_countries FROM vos")
STATES = f"st AS ({orders_by('region, country, state', 'COUNT(DISTINCT city) AS distinct_cities')})"
SQL["state_performance"] = q(f"SELECT {pick(L['state_performance'])} FROM (SELECT *, global_profit_rank - global_sales_rank AS sales_profit_rank_gap FROM k)", STATES, "k AS (" + ranks(
    shares("st", global_sales_share_percentage="total_sales"),
    {"global_sales_rank": "total_sales desc", "global_profit_rank": "total_profit desc", "global_margin_rank": "comparable_profit_margin_percentage desc",
     "regional_sales_rank": "total_sales desc", "regional_profit_rank": "total_profit desc", "country_sales_rank": "total_sales desc"},
    {"regional_sales_rank": "region", "regional_profit_rank": "region", "country_sales_rank": "country"}) + ")")
SQL["top_states"] = q(f"SELECT {pick(L['top_states'])} FROM (SELECT * FROM st ORDER BY total_sales {DESC}, country, state, region LIMIT 15)", STATES)
SQL["state_negative_profit"] = q(f"SELECT {pick(L['state_negative_profit'])} FROM st WHERE total_profit < 0", STATES)
SQL["state_conservation"] = q(twice({
    "total_orders": ("original_orders", "state_orders", "order_difference"), "total_sales": ("original_sales", "state_sales", "sales_difference"),
    "total_profit": ("original_profit", "state_profit", "profit_difference")},
    "SELECT COUNT(*) AS total_orders, SUM(total_sales) AS total_sales, SUM(total_profit) AS total_profit FROM vos", f"SELECT {SUM4} FROM st"), STATES)
SQL["country_performance"] = q(f"SELECT {pick(L['country_performance'])} FROM (SELECT *, {GAP} FROM k)",
    f"co AS ({orders_by('country', 'COUNT(DISTINCT region) AS distinct_regions, COUNT(DISTINCT state) AS distinct_states, COUNT(DISTINCT city) AS distinct_cities')})", "k AS (" + ranks(
    shares("co", sales_share_percentage="total_sales", order_share_percentage="total_orders", customer_presence_share_percentage="distinct_customers"),
    {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc",
     "average_order_value_rank": "average_complete_order_value desc"}) + ")")


def by_share(table: str, value: str, position: str, share: str, cumulative: str, label: str) -> str:
    w = f"ORDER BY {value} {DESC}, {CITYKEY}"
    return (f"SELECT *, CASE WHEN {cumulative} <= 80 THEN 'A' WHEN {cumulative} <= 95 THEN 'B' ELSE 'C' END AS {label} FROM (SELECT *, ROW_NUMBER() OVER ({w}) AS {position}, "
            f"CAST(SUM({fine(share)}) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS {cumulative} FROM "
            f"(SELECT *, {pct(value, f'SUM({value}) OVER ()')} AS {share} FROM {table}))")


CABC = f"ca AS ({by_share('(SELECT * FROM gp WHERE total_sales IS NOT NULL)', 'total_sales', 'city_position', 'sales_share_percentage', 'cumulative_sales_percentage', 'abc_class')})"
SQL["city_abc"] = q(f"SELECT {pick(L['city_abc'])} FROM ca", CITY, CABC)
SQL["city_milestones"] = q(f"SELECT COUNT(*) AS cities_with_known_sales, {reach('cumulative_sales_percentage', 'city_position', 'cities_for_{}_percent_sales')} FROM ca", CITY, CABC)
SQL["city_abc_distribution"] = q(f"SELECT abc_class, n AS total_cities, {r(pct('n', 'SUM(n) OVER ()'))} AS city_share_percentage, {rd('s')} AS total_sales, {rd('sh')} AS sales_share_percentage, {r('av')} AS average_city_sales FROM "
    f"(SELECT abc_class, COUNT(*) n, SUM(total_sales) s, SUM({fine('sales_share_percentage')}) sh, {mean('total_sales')} av FROM ca GROUP BY 1)", CITY, CABC)
SQL["city_share_check"] = q(f"SELECT COUNT(*) AS cities_with_known_sales, {rd('SUM(' + fine('sales_share_percentage') + ')')} AS total_sales_share_percentage FROM ca", CITY, CABC)
RY = "ry AS (" + (f"SELECT *, {growth('total_orders', 'o')} AS yoy_order_growth_percentage, {growth('distinct_customers', 'c')} AS yoy_customer_growth_percentage, {growth('total_sales', 'previous_year_sales')} AS yoy_sales_growth_percentage, "
    f"total_profit - previous_year_profit AS yoy_profit_absolute_change, comparable_profit_margin_percentage - previous_year_margin AS yoy_margin_change_points FROM "
    f"({lagged('(' + orders_by('region, order_year') + ')', 'order_year', {'o': 'total_orders', 'c': 'distinct_customers', 'previous_year_sales': 'total_sales', 'previous_year_profit': 'total_profit', 'previous_year_margin': 'comparable_profit_margin_percentage'}, 'region')})") + ")"
SQL["region_yearly"] = q(f"SELECT {pick(L['region_yearly'])} FROM ry", RY)
SQL["region_growth_margin_drop"] = q(f"SELECT {pick(L['region_growth_margin_drop'])} FROM ry WHERE total_sales > previous_year_sales AND comparable_profit_margin_percentage < previous_year_margin", RY)
SQL["region_year_coverage"] = q("SELECT region, COUNT(DISTINCT order_year) AS observed_years, MIN(order_year) AS first_year, MAX(order_year) AS last_year, COUNT(*) AS total_orders FROM vos GROUP BY region")
SQL["region_year_combinations"] = q("SELECT COUNT(*) AS region_year_combinations FROM (SELECT DISTINCT region, order_year FROM vos)")
LOSS = f"lo AS ({by_share('(SELECT *, abs(total_profit) AS known_loss_amount FROM gp WHERE total_profit < 0)', 'known_loss_amount', 'loss_position', 'loss_share_percentage', 'cumulative_loss_percentage', 'loss_concentration_class')})"
SQL["city_loss_concentration"] = q(f"SELECT {pick(L['city_loss_concentration'])} FROM lo", CITY, LOSS)
SQL["city_loss_milestones"] = q(f"SELECT COUNT(*) AS loss_making_cities, {reach('cumulative_loss_percentage', 'loss_position', 'cities_for_{}_percent_losses')} FROM lo", CITY, LOSS)
SQL["top_city_losses"] = q(f"SELECT {pick(L['top_city_losses'])} FROM (SELECT * FROM lo ORDER BY total_profit, total_sales {DESC}, country, state, city LIMIT 20)", CITY, LOSS)
SQL["city_loss_check"] = q(f"SELECT COUNT(*) AS loss_making_cities, {rd('SUM(total_profit)')} AS total_negative_profit, {rd('SUM(known_loss_amount)')} AS total_known_loss_amount, {r(pct('SUM(known_loss_amount)', 'SUM(known_loss_amount)'))} AS validated_loss_share_percentage FROM lo", CITY, LOSS)
SUMS = "SUM(total_order_lines) AS total_order_lines, SUM(total_sales) AS total_sales, SUM(total_quantity) AS total_quantity, SUM(total_profit) AS total_profit"


def levels(named: dict[str, str], level: str, groups: str) -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS {level}, COUNT(*) AS {groups}, SUM(total_orders) AS total_orders, {SUMS} FROM (SELECT COUNT(*) AS total_orders, {SUMS} FROM vos GROUP BY {k})" for n, k in named.items())
    out = []
    for own, other, diff in (("total_orders", "global_orders", "order_difference"), ("total_order_lines", "global_order_lines", "order_line_difference"),
                             ("total_sales", "global_sales", "sales_difference"), ("total_quantity", "global_quantity", "quantity_difference"), ("total_profit", "global_profit", "profit_difference")):
        wrap = d if own in ("total_sales", "total_profit") else big
        out += [f"{wrap('a.' + own)} AS {own}", f"{wrap('b.' + own)} AS {other}", f"{wrap(f'a.{own} - b.{own}')} AS {diff}"]
    return f"SELECT {level}, {groups}, {', '.join(out)} FROM ({rows}) a, (SELECT COUNT(*) AS total_orders, {SUMS} FROM vos) b"


SQL["geographic_levels"] = q(levels({"Country": "country", "Region": "region", "State": "region, country, state", "City": PLACE}, "geographic_level", "geographic_groups"))
CARD = "COUNT(DISTINCT country) AS total_countries, COUNT(DISTINCT region) AS total_regions, COUNT(DISTINCT (country, state)) AS total_states, COUNT(DISTINCT (country, state, city)) AS total_cities"
SQL["geographic_cardinality"] = q(f"SELECT {CARD} FROM vos")
SQL["geographic_missing"] = q("SELECT " + ", ".join(f"{n_if(c + ' IS NULL')} AS orders_without_{c}" for c in ("country", "region", "state", "city")) + " FROM vos")
SQL["order_uniqueness"] = q("SELECT COUNT(*) AS total_orders, COUNT(DISTINCT order_key) AS unique_order_keys, COUNT(*) - COUNT(DISTINCT order_key) AS duplicated_order_keys FROM vos")
SQL["geographic_summary"] = q(f"SELECT COUNT(*) AS total_orders, COUNT(DISTINCT order_key) AS unique_orders, {CARD}, {rd('SUM(total_sales)')} AS total_sales, {rd('SUM(total_profit)')} AS total_profit FROM vos")

# ---- logistics
NAMED = "SELECT *, COALESCE(ship_mode, 'Unknown') AS mode_name, CASE WHEN ship_mode IS NULL THEN 1 ELSE 0 END AS is_unknown, CASE WHEN shipping_days = 0 THEN 'Mismo día' WHEN shipping_days <= 2 THEN '1-2 días' WHEN shipping_days <= 4 THEN '3-4 días' WHEN shipping_days <= 7 THEN '5-7 días' ELSE '8+ días' END AS shipping_time_group FROM vos"
NM = f"nm AS ({NAMED})"


def modes(*keys: str) -> str:
    """CTE md: measures per mode and further keys."""
    group = ", ".join([*keys, "mode_name", "is_unknown"])
    aggs = ", ".join(f"{v} AS {k}" for k, v in ORDER_AGG.items())
    return f"md AS (SELECT {group}, mode_name AS ship_mode, is_unknown AS is_unknown_ship_mode, {aggs} FROM nm GROUP BY {group})"


SQL["ship_mode_ranking"] = q(f"SELECT {pick(L['ship_mode_ranking'])} FROM (SELECT *, {GAP} FROM k)", NM, modes(), "k AS (" + ranks(
    shares("md", order_share_percentage="total_orders", sales_share_percentage="total_sales"),
    {"usage_rank": "total_orders desc", "shipping_speed_rank": "average_shipping_days asc", "sales_rank": "total_sales desc", "profit_rank": "total_profit desc"}) + ")")
SQL["ship_mode_distribution"] = q(f"SELECT {pick(L['ship_mode_distribution'])} FROM {shares('md', order_share_percentage='total_orders')}", NM, modes())


def kept(keys: str, grouped: str, groups: str = "") -> str:
    g = f"COUNT(*) AS {groups}, " if groups else ""
    return f"SELECT *, {grouped} - original_orders AS order_difference FROM (SELECT {g}{big('SUM(n)')} AS {grouped}, (SELECT COUNT(*) FROM vos) AS original_orders FROM (SELECT COUNT(*) n FROM nm GROUP BY {keys}))"


SQL["ship_mode_conservation"] = q(kept("mode_name", "orders_by_ship_mode"), NM)
SQL["ship_mode_share_check"] = q(f"SELECT {r(pct('SUM(n)', '(SELECT COUNT(*) FROM vos)'))} AS total_order_share_percentage FROM (SELECT COUNT(*) n FROM nm GROUP BY mode_name)", NM)
BANDS = f"bd AS ({orders_by('shipping_time_group', table='nm')})"
SQL["shipping_bands"] = q(f"SELECT {pick(L['shipping_bands'])} FROM {shares('bd', order_share_percentage='total_orders', sales_share_percentage='total_sales')}", NM, BANDS)
SQL["shipping_day_histogram"] = q(f"SELECT shipping_days, n AS total_orders, {r(pct('n', 'SUM(n) OVER ()'))} AS order_share_percentage, {rd('s')} AS total_sales, {rd('p')} AS total_profit, {r('av')} AS average_known_sales_per_order FROM "
    f"(SELECT shipping_days, COUNT(*) n, SUM(total_sales) s, SUM(total_profit) p, {mean('total_sales')} av FROM vos GROUP BY 1)")
SQL["long_shipping_orders"] = q(f"SELECT {pick(L['long_shipping_orders'])} FROM (SELECT * REPLACE (COALESCE(ship_mode, 'Unknown') AS ship_mode) FROM vos) WHERE shipping_days >= 8")
SQL["shipping_band_check"] = q("SELECT COUNT(*) AS classified_orders, COUNT(DISTINCT order_key) AS unique_classified_orders, (SELECT COUNT(*) FROM vos) AS original_orders, COUNT(*) - (SELECT COUNT(*) FROM vos) AS order_difference, COUNT(*) - COUNT(DISTINCT order_key) AS duplicated_orders FROM nm", NM)
MB = (f"mb AS (SELECT *, {pct('total_orders', 'SUM(total_orders) OVER (PARTITION BY ship_mode)')} AS within_ship_mode_order_percentage, "
      f"{pct('total_orders', 'SUM(total_orders) OVER (PARTITION BY shipping_time_group)')} AS within_time_group_order_percentage FROM md)")
SQL["mode_by_band"] = q(f"SELECT {pick(L['mode_by_band'])} FROM mb", NM, modes("shipping_time_group"), MB)
SQL["mode_band_wide"] = q(f"SELECT {pick(L['mode_band_wide'])} FROM md", NM, modes())
SQL["same_day_histogram"] = q(f"SELECT shipping_days, n AS total_orders, {r(pct('n', 'SUM(n) OVER ()'))} AS order_share_percentage FROM (SELECT shipping_days, COUNT(*) n FROM vos WHERE ship_mode = 'Same Day' GROUP BY 1)")
SQL["mode_band_check"] = q(f"SELECT ship_mode, {big('SUM(total_orders)')} AS total_orders, {rd('SUM(' + fine('within_ship_mode_order_percentage') + ')')} AS total_percentage FROM mb GROUP BY 1", NM, modes("shipping_time_group"), MB)
GLOB = "(SELECT CAST(SUM(shipping_days) AS DOUBLE) / COUNT(*) AS global_average_shipping_days, sqrt(CAST(COUNT(*) * SUM(CAST(shipping_days AS HUGEINT) * shipping_days) - SUM(shipping_days) * SUM(shipping_days) AS DOUBLE)) / COUNT(*) AS global_shipping_days_stddev FROM vos)"


def placed(key: str, extra: str = "") -> str:
    return (f"pl AS (SELECT *, {pct('eight_plus_day_orders', 'total_orders')} AS e8, average_shipping_days - global_average_shipping_days AS shipping_days_vs_global_average, "
            f"average_shipping_days - global_average_shipping_days AS shipping_days_above_average FROM ({orders_by(key, extra)}), {GLOB})")


SPEED = {"shipping_speed_rank": "average_shipping_days asc", "long_shipping_rank": "e8 desc"}
SQL["region_logistics"] = q(f"SELECT {pick(L['region_logistics'])} FROM ({ranks('pl', SPEED)})", placed("region"))
SQL["slow_regions"] = q(f"SELECT {pick(L['slow_regions'])} FROM pl WHERE average_shipping_days > global_average_shipping_days", placed("region"))
SQL["slow_countries"] = q(f"SELECT {pick(L['slow_countries'])} FROM pl WHERE average_shipping_days > global_average_shipping_days", placed("country"))
SQL["country_logistics"] = q(f"SELECT {pick(L['country_logistics'])} FROM ({ranks('pl', {**SPEED, 'shipping_consistency_rank': 'shipping_days_stddev asc'})})",
                             placed("country", "COUNT(DISTINCT state) AS distinct_states, COUNT(DISTINCT city) AS distinct_cities"))
for key, share in (("region", "regional_order_percentage"), ("country", "country_order_percentage")):
    SQL[f"{key}_day_histogram"] = q(f"SELECT {key}, shipping_days, n AS total_orders, {r(pct('n', f'SUM(n) OVER (PARTITION BY {key})'))} AS {share} FROM (SELECT {key}, shipping_days, COUNT(*) n FROM vos GROUP BY 1, 2)")
SQL["region_order_conservation"] = q(kept("region", "regional_orders", "total_regions"), NM)
SQL["country_order_conservation"] = q(kept("country", "country_orders", "total_countries"), NM)
SQL["country_mode_share"] = q(f"SELECT country, ship_mode, total_orders, {r(pct('total_orders', 'SUM(total_orders) OVER (PARTITION BY country)'))} AS country_ship_mode_percentage, {r('average_shipping_days')} AS average_shipping_days FROM md", NM, modes("country"))
PACE = ("same_day", "two_day_or_less", "eight_plus_day", "unknown_ship_mode")


def paced(keys: str, order: str) -> str:
    base = f"(SELECT *, {', '.join(f'{pct(p + "_orders", "total_orders")} AS v_{p}' for p in PACE)} FROM ({orders_by(keys)}))"
    prev = {"o": "total_orders", "a": "average_shipping_days", "sd": "shipping_days_stddev", **{f"p_{p}": f"v_{p}" for p in PACE}}
    return f"pc AS ({lagged(base, order, prev)})"


POINTS = ", ".join(f"v_{p} - p_{p} AS {{0}}{p}_change_points" for p in PACE)
SQL["annual_logistics"] = q(f"SELECT {pick(L['annual_logistics'])} FROM (SELECT *, {growth('total_orders', 'o')} AS yoy_order_growth_percentage, average_shipping_days - a AS yoy_average_shipping_days_change, shipping_days_stddev - sd AS yoy_shipping_stddev_change, {POINTS.format('yoy_')} FROM pc)", paced("order_year", "order_year"))
SQL["logistics_evolution"] = q(f"SELECT {pick(L['logistics_evolution'])} FROM (SELECT *, average_shipping_days - a AS average_shipping_days_change, {POINTS.format('')}, CASE WHEN a IS NULL THEN 'Año base' "
    "WHEN average_shipping_days < a AND v_two_day_or_less > p_two_day_or_less AND v_eight_plus_day < p_eight_plus_day THEN 'Mejora logística consistente' "
    "WHEN average_shipping_days > a AND v_two_day_or_less < p_two_day_or_less AND v_eight_plus_day > p_eight_plus_day THEN 'Deterioro logístico consistente' ELSE 'Evolución mixta' END AS logistics_evolution FROM pc)", paced("order_year", "order_year"))
SQL["annual_mode_usage"] = q(f"SELECT order_year, ship_mode, total_orders, {r(pct('total_orders', 'SUM(total_orders) OVER (PARTITION BY order_year)'))} AS annual_ship_mode_percentage, {r('average_shipping_days')} AS average_shipping_days FROM md", NM, modes("order_year"))
SQL["order_year_coverage"] = q("SELECT COUNT(DISTINCT order_year) AS observed_years, MIN(order_year) AS first_year, MAX(order_year) AS last_year, COUNT(*) AS total_orders FROM vos")
SQL["annual_order_conservation"] = q(kept("order_year", "annual_orders"), NM)
SQL["monthly_logistics"] = q(f"SELECT {pick(L['monthly_logistics'])} FROM (SELECT *, average_shipping_days - a AS mom_average_shipping_days_change, {POINTS.format('mom_')} FROM pc)", paced("order_year, order_month, order_year_month", "order_year, order_month"))
CAL = f"cl AS (SELECT *, order_month AS calendar_month, {MONTHS}[order_month] AS month_name, {pct('eight_plus_day_orders', 'total_orders')} AS e8 FROM ({orders_by('order_month', 'COUNT(DISTINCT order_year) AS observed_years')}))"
SQL["logistics_seasonality"] = q(f"SELECT {pick(L['logistics_seasonality'])} FROM ({ranks('cl', SPEED)})", CAL)
SQL["months_by_shipping_time"] = q(f"SELECT {pick(L['months_by_shipping_time'])} FROM cl", CAL)
SQL["calendar_coverage"] = q("SELECT order_month AS calendar_month, COUNT(DISTINCT order_year) AS observed_years, COUNT(*) AS total_orders FROM vos GROUP BY 1")
SQL["calendar_size"] = q("SELECT COUNT(DISTINCT order_month) AS calendar_months, COUNT(DISTINCT order_year_month) AS observed_year_months FROM vos")
SQL["shipping_vs_commercial"] = q(f"SELECT {pick(L['shipping_vs_commercial'])} FROM (SELECT *, average_complete_order_value - global_average_complete_order_value AS order_value_vs_global_average, comparable_profit_margin_percentage - global_comparable_profit_margin_percentage AS margin_vs_global_average_points FROM k)", NM, BANDS, "k AS (" + ranks(
    f"(SELECT * FROM {shares('bd', order_share_percentage='total_orders')}, (SELECT {ORDER_AGG['average_complete_order_value']} AS global_average_complete_order_value, {ORDER_AGG['comparable_profit_margin_percentage']} AS global_comparable_profit_margin_percentage FROM vos))",
    {"average_order_value_rank": "average_complete_order_value desc", "profitability_rank": "comparable_profit_margin_percentage desc"}) + ")")
SQL["commercial_by_day"] = q(f"SELECT {pick(L['commercial_by_day'])} FROM {shares('dy', order_share_percentage='total_orders')}", f"dy AS ({orders_by('shipping_days')})")
SQL["logistics_extremes"] = q(f"SELECT {pick(L['logistics_extremes'])} FROM ({orders_by('logistics_group', table='ex')})", "ex AS (SELECT *, CASE WHEN shipping_days <= 2 THEN '0-2 días' ELSE '8+ días' END AS logistics_group FROM vos WHERE shipping_days <= 2 OR shipping_days >= 8)")


def with_mode(key: str) -> str:
    return (f"wm AS (SELECT *, average_shipping_days - ship_mode_average_shipping_days AS shipping_days_vs_ship_mode_average, average_shipping_days - ship_mode_average_shipping_days AS shipping_days_above_ship_mode_average, "
            f"{pct('total_orders', f'SUM(total_orders) OVER (PARTITION BY {key})')} AS regional_ship_mode_percentage, {pct('total_orders', 'SUM(total_orders) OVER (PARTITION BY ship_mode)')} AS ship_mode_region_percentage, "
            f"DENSE_RANK() OVER (PARTITION BY ship_mode ORDER BY average_shipping_days {ASC}) AS {'regional' if key == 'region' else key}_speed_rank_within_ship_mode "
            "FROM md JOIN (SELECT mode_name, CAST(SUM(shipping_days) AS DOUBLE) / COUNT(*) AS ship_mode_average_shipping_days FROM nm GROUP BY 1) USING (mode_name))")


SQL["region_mode"] = q(f"SELECT {pick(L['region_mode'])} FROM wm", NM, modes("region"), with_mode("region"))
SQL["slow_region_modes"] = q(f"SELECT {pick(L['slow_region_modes'])} FROM wm WHERE average_shipping_days > ship_mode_average_shipping_days", NM, modes("region"), with_mode("region"))
SQL["country_mode"] = q(f"SELECT {pick(L['country_mode'])} FROM wm", NM, modes("country"), with_mode("country"))
SQL["region_mode_matrix"] = q("SELECT region, " + ", ".join(
    r(f"CAST(SUM(shipping_days) FILTER (WHERE mode_name = '{m}') AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE mode_name = '{m}'), 0)") + f" AS {c}"
    for m, c in (("Same Day", "same_day_average_days"), ("First Class", "first_class_average_days"), ("Second Class", "second_class_average_days"), ("Standard Class", "standard_class_average_days"), ("Unknown", "unknown_average_days"))) + " FROM nm GROUP BY region", NM)
SQL["region_mode_conservation"] = q(kept("region, mode_name", "classified_orders", "observed_region_ship_mode_combinations"), NM)
SQL["logistics_levels"] = q(levels({"Ship Mode": "mode_name", "Shipping Time Group": "shipping_time_group", "Region": "region", "Country": "country", "Year": "order_year"}, "analysis_level", "observed_groups").replace("FROM vos GROUP BY", "FROM nm GROUP BY"), NM)
SQL["date_coherence"] = q(f"SELECT COUNT(*) AS total_orders, {n_if('ship_date < order_date')} AS orders_with_invalid_dates, {n_if('shipping_days < 0')} AS orders_with_negative_shipping_days, {n_if('shipping_days <> ship_date - order_date')} AS shipping_day_mismatches, "
    f"MIN(shipping_days) AS minimum_shipping_days, MAX(shipping_days) AS maximum_shipping_days, {r(mean('shipping_days'))} AS average_shipping_days FROM vos")
SQL["ship_mode_fixed_order"] = q(f"SELECT mode_name AS ship_mode, n AS total_orders, {r(pct('n', 'SUM(n) OVER ()'))} AS order_share_percentage FROM (SELECT mode_name, COUNT(*) n FROM nm GROUP BY 1)", NM)
SQL["logistics_summary"] = q(f"SELECT {pick(L['logistics_summary'])} FROM ({orders_by('')})")
SQL["observed_period"] = q("SELECT MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date, COUNT(DISTINCT order_year) AS observed_years, COUNT(DISTINCT order_year_month) AS observed_year_months FROM vos")

# ---- period reports
OBS = "first_order_date AS first_observed_order_date, last_order_date AS last_observed_order_date"


def bound(start: str | None, end: str | None) -> tuple[str, str]:
    lo = f"DATE '{start}'" if start else "(SELECT MIN(order_date) FROM vos)"
    hi = f"DATE '{end}'" if end else "(SELECT MAX(order_date) FROM vos)"
    return f"{lo} AS requested_start_date, {hi} AS requested_end_date", f"order_date BETWEEN {lo} AND {hi}"


def period(name: str, layout: str, start: str | None, end: str | None, make) -> None:
    stamp, test = bound(start, end)
    SQL[name] = make(stamp, test, pick(L[layout]))


def sales(stamp, test, cols):
    return q(f"SELECT {cols} FROM (SELECT *, {stamp}, {OBS}, unknown_ship_mode_orders AS orders_with_unknown_ship_mode FROM ({orders_by('', where=test)}))")


def category(value):
    extra = f" AND category = '{value}'" if value else ""
    return lambda stamp, test, cols: q(f"SELECT {cols} FROM (SELECT *, {stamp}, {OBS} FROM ({lines_by('category, sub_category', where=test + extra)}))")


def products(n):
    return lambda stamp, test, cols: q(f"SELECT {cols} FROM (SELECT *, {stamp}, profit_rank - sales_position AS sales_profit_rank_gap FROM k WHERE sales_position <= {n})", f"pp AS ({lines_by(PRODUCT, where=test)})", "k AS (" + ranks(
        f"(SELECT *, ROW_NUMBER() OVER (ORDER BY total_sales {DESC}, total_profit {DESC}, product_key) AS sales_position FROM pp)", {"profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc"}) + ")")


def customers(n):
    return lambda stamp, test, cols: q(f"SELECT {cols} FROM (SELECT *, {stamp}, profit_rank - sales_position AS sales_profit_rank_gap FROM k WHERE sales_position <= {n})",
        f"cu AS ({orders_by('customer_id, customer_name, segment', 'COUNT(DISTINCT order_year_month) AS active_months, COUNT(DISTINCT order_year) AS active_years', test)})", "k AS (" + ranks(
        f"(SELECT *, ROW_NUMBER() OVER (ORDER BY total_sales {DESC}, total_profit {DESC}, customer_id) AS sales_position FROM {shares('cu', sales_share_percentage='total_sales')})",
        {"profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc", "order_frequency_rank": "total_orders desc", "average_order_value_rank": "average_complete_order_value desc"}) + ")")


def places(region):
    extra = f" AND region = '{region}'" if region else ""
    return lambda stamp, test, cols: q(f"SELECT {cols} FROM (SELECT *, {stamp}, {GAP} FROM k)", f"gp AS ({orders_by(PLACE, where=test + extra)})", "k AS (" + ranks(
        shares("gp", sales_share_percentage="total_sales"), {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc", "regional_sales_rank": "total_sales desc"}, {"regional_sales_rank": "region"}) + ")")


def shipping(mode):
    extra = f" AND mode_name = '{mode}'" if mode else ""
    return lambda stamp, test, cols: q(f"SELECT {cols} FROM (SELECT *, {stamp}, {OBS}, {GAP} FROM k)", f"nm AS (SELECT * FROM ({NAMED}) WHERE {test}{extra})", modes(), "k AS (" + ranks(
        shares("md", order_share_percentage="total_orders"), {"shipping_speed_rank": "average_shipping_days asc", "usage_rank": "total_orders desc", "sales_rank": "total_sales desc", "profit_rank": "total_profit desc"}) + ")")


for suffix, layout, start, end, make in (
    ("", "period_sales_summary", None, None, sales), ("_1997", "period_sales_summary", "1997-01-01", "1997-12-31", sales),
    ("", "period_category_performance", None, None, category(None)), ("_economy", "period_category_performance", "1997-01-01", "1998-06-30", category("ECONOMY")),
    ("", "period_top_products", None, None, products(20)), ("_1998", "period_top_products", "1998-01-01", "1998-12-31", products(50)),
    ("", "period_top_customers", None, None, customers(20)), ("_1998", "period_top_customers", "1998-01-01", "1998-12-31", customers(50)),
    ("", "period_geographic_performance", None, None, places(None)), ("_asia", "period_geographic_performance", "1997-01-01", None, places("ASIA")),
    ("", "period_logistics_performance", None, None, shipping(None)), ("_unknown", "period_logistics_performance", None, "1999-12-31", shipping("Unknown")),
):
    period(layout + suffix, layout, start, end, make)
