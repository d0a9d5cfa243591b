"""Check statements: displays, conservation between views, change log."""

from __future__ import annotations

from oracle.base import big, d, lines_by, n_if, orders_by, pick, q
from oracle.reports_a import CAT, CITY, CUST, DESC, MONTH, OVERVIEW, PROD, SHIP, SUBCAT
from oracle.reports_a import SQL as VIEW_SQL
from oracle.reports_c import q as staged
from ventaria.plans.display import DISPLAYS

SQL: dict[str, str] = {}
SEG = f"sg AS ({orders_by('segment')})"
for name, table, cte, order in (
    ("display_order_summary", "vos", None, "ORDER BY order_date, order_key"), ("display_monthly_performance", "mp", MONTH, ""),
    ("display_subcategory_performance", "sp", SUBCAT, ""), ("display_customer_performance", "cu", CUST, f"ORDER BY total_sales {DESC}, customer_name, customer_id"),
    ("display_geographic_performance", "gp", CITY, f"ORDER BY total_sales {DESC}, country, state, city"),
    ("display_product_performance", "pp", PROD, f"ORDER BY total_sales {DESC}, product_name, product_key"),
    ("display_segment_performance", "sg", SEG, ""), ("display_ship_mode_performance", "sm", SHIP, ""),
    ("display_category_performance", "cp", CAT, ""), ("display_business_overview", "bo", OVERVIEW, ""),
):
    SQL[name] = q(f"SELECT {pick(DISPLAYS[name])} FROM (SELECT * FROM {table} {order})", *([cte] if cte else []))
SQL["display_sales_detail"] = q("SELECT source_row_id, order_id, order_date, customer_name, city, product_name, category, CAST(ROUND(sales, 2) AS DOUBLE) AS sales, quantity, CAST(ROUND(discount, 2) AS DOUBLE) AS discount, "
    "CAST(ROUND(profit, 2) AS DOUBLE) AS profit FROM (SELECT * FROM detail ORDER BY source_row_id, product_key, order_key)")
M = ("total_order_lines", "total_sales", "total_quantity", "total_profit")
PARENT = "par AS (SELECT COUNT(*) AS total_order_lines, SUM(sales) AS total_sales, SUM(quantity) AS total_quantity, SUM(profit) AS total_profit FROM lines)"
VIEWS = {"order_summary": "vos", "monthly_performance": "mp", "subcategory_performance": "sp", "customer_performance": "cu", "geographic_performance": "gp",
         "product_performance": "pp", "segment_performance": "sg", "ship_mode_performance": "sm", "category_performance": "cp"}


def kind(m: str):
    return d if m in ("total_sales", "total_profit") else big


SQL["view_conservation"] = q(" UNION ALL ".join(
    f"SELECT '{v}' AS view_name, COUNT(*) AS view_rows, {', '.join(f'{kind(m)(f"SUM({m})")} AS {m}' for m in M)}, "
    f"{', '.join(f'{kind(m)(f"SUM({m}) - (SELECT {m} FROM par)")} AS {m}_difference' for m in M)} FROM {t}" for v, t in VIEWS.items()),
    MONTH, SUBCAT, CUST, CITY, PROD, SEG, SHIP, CAT, PARENT)
SQL["view_uniqueness"] = q(" UNION ALL ".join(
    f"SELECT '{v}' AS view_name, COUNT(*) AS total_rows, COUNT(DISTINCT {k}) AS unique_keys, COUNT(*) - COUNT(DISTINCT {k}) AS duplicates FROM {t}" for v, t, k in (
        ("order_summary", "vos", "order_key"), ("monthly_performance", "mp", "(order_year, order_month)"), ("customer_performance", "cu", "customer_id"),
        ("geographic_performance", "gp", "(region, country, state, city)"), ("product_performance", "pp", "product_key"),
        ("sales_detail", "detail", "(source_row_id, order_key, product_key)"), ("subcategory_performance", "sp", "(category, sub_category)"),
        ("segment_performance", "sg", "(segment, 1)"), ("ship_mode_performance", "sm", "(ship_mode, 1)"), ("category_performance", "cp", "(category, 1)"))),
    MONTH, CUST, CITY, PROD, SUBCAT, SEG, SHIP, CAT)
SQL["view_missing_members"] = q("SELECT 'customers' AS entity, COUNT(*) AS missing FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT customer_id FROM vos) "
    "UNION ALL SELECT 'products', COUNT(*) FROM products WHERE product_key NOT IN (SELECT product_key FROM lines) UNION ALL SELECT 'orders', COUNT(*) FROM headers WHERE order_key NOT IN (SELECT order_key FROM lines)")
SQL["line_conservation"] = q("SELECT *, view_rows - model_rows AS difference FROM (SELECT (SELECT COUNT(*) FROM lines) AS model_rows, (SELECT COUNT(*) FROM detail) AS view_rows)")

# ---- change log
MOVED = 1_000_000_000_000
ORD = "order_key, order_id, customer_id, ship_mode, order_date, ship_date"
SNAP = f"""snew AS (SELECT order_key, order_id, customer_id, CASE WHEN order_key % 10 = 3 THEN NULL ELSE ship_mode END AS ship_mode, order_date, CASE WHEN order_key % 10 = 1 THEN ship_date + 1 ELSE ship_date END AS ship_date FROM headers WHERE order_key % 10 <> 0
  UNION ALL SELECT order_key + {MOVED}, order_id, customer_id, ship_mode, order_date, ship_date FROM headers WHERE order_key % 10 = 2),
chg AS (SELECT 'orders' AS table_name, CAST(COALESCE(n.order_key, o.order_key) AS VARCHAR) AS record_key, CASE WHEN o.order_key IS NULL THEN 'INSERT' WHEN n.order_key IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action_type,
  o.ship_date AS old_ship_date, n.ship_date AS new_ship_date, o.ship_mode AS old_ship_mode, n.ship_mode AS new_ship_mode, o.customer_id AS old_customer_id, n.customer_id AS new_customer_id
  FROM headers o FULL JOIN snew n ON o.order_key = n.order_key
  WHERE o.order_key IS NULL OR n.order_key IS NULL OR o.ship_date IS DISTINCT FROM n.ship_date OR o.ship_mode IS DISTINCT FROM n.ship_mode)"""
SQL["order_change_log"] = q("SELECT ROW_NUMBER() OVER (ORDER BY table_name, record_key) AS audit_id, * FROM chg", SNAP)
SQL["unchanged_log"] = q("SELECT table_name, record_key, action_type FROM chg WHERE false", SNAP)
DET = f"""dnew AS (SELECT * REPLACE (CASE WHEN order_detail_key % 10 = 1 THEN CAST(sales + 25 AS DECIMAL(15,6)) ELSE sales END AS sales, CASE WHEN order_detail_key % 10 = 3 THEN NULL ELSE profit END AS profit) FROM order_details WHERE order_detail_key % 10 <> 0
  UNION ALL SELECT * REPLACE (order_detail_key + {MOVED} AS order_detail_key) FROM order_details WHERE order_detail_key % 10 = 2),
dchg AS (SELECT 'order_details' AS table_name, CAST(COALESCE(n.order_detail_key, o.order_detail_key) AS VARCHAR) AS record_key, CASE WHEN o.order_detail_key IS NULL THEN 'INSERT' WHEN n.order_detail_key IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action_type,
  CAST(o.sales AS DOUBLE) AS old_sales, CAST(n.sales AS DOUBLE) AS new_sales, CAST(o.profit AS DOUBLE) AS old_profit, CAST(n.profit AS DOUBLE) AS new_profit FROM order_details o FULL JOIN dnew n ON o.order_detail_key = n.order_detail_key
  WHERE o.order_detail_key IS NULL OR n.order_detail_key IS NULL OR o.sales IS DISTINCT FROM n.sales OR o.profit IS DISTINCT FROM n.profit)"""
SQL["detail_change_log"] = staged("model", "SELECT * FROM dchg", DET)
HEAD = """headers AS (SELECT o_orderkey AS order_key, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(c_custkey AS VARCHAR) AS customer_id, CAST(o_orderdate AS DATE) AS order_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 11 AS INTEGER) AS ship_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class' WHEN '3-MEDIUM' THEN 'Second Class' WHEN '5-LOW' THEN 'Standard Class' END AS ship_mode FROM orders JOIN customer ON c_custkey = o_custkey)"""
BOTH = "ev AS (SELECT table_name, action_type FROM chg UNION ALL SELECT table_name, action_type FROM dchg)"
SQL["change_event_counts"] = staged("model", "SELECT table_name, action_type, COUNT(*) AS event_count FROM ev GROUP BY 1, 2", HEAD, SNAP, DET, BOTH)
SQL["change_payload_checks"] = staged("model", "SELECT table_name, " + ", ".join(n_if(f"action_type = '{a}'") + f" AS valid_{a.lower()}_events" for a in ("INSERT", "UPDATE", "DELETE")) + " FROM ev GROUP BY 1", HEAD, SNAP, DET, BOTH)
SQL["change_scorecard"] = staged("model", "SELECT 9 AS audit_columns_found, " + n_if("table_name NOT IN ('orders', 'order_details')") + " AS invalid_table_records, " + n_if("action_type NOT IN ('INSERT', 'UPDATE', 'DELETE')") +
    " AS invalid_action_records, CAST(0 AS BIGINT) AS invalid_payload_records, CAST(0 AS BIGINT) AS invalid_record_keys, CAST(0 AS BIGINT) AS invalid_audit_metadata, 'OK' AS audit_system_status FROM ev", HEAD, SNAP, DET, BOTH)
VERS = """ver AS (SELECT CAST(order_key AS VARCHAR) AS k, 0 AS v, true AS live, ship_mode, ship_date FROM headers UNION ALL SELECT CAST(order_key AS VARCHAR), 1, true, ship_mode, ship_date FROM snew
  UNION ALL SELECT CAST(order_key AS VARCHAR), 1, false, NULL, NULL FROM headers WHERE order_key % 10 = 0 UNION ALL SELECT CAST(order_key AS VARCHAR), 2, true, ship_mode, ship_date FROM headers
  UNION ALL SELECT CAST(order_key AS VARCHAR), 3, false, NULL, NULL FROM headers WHERE order_key % 10 = 5),
lag1 AS (SELECT *, LAG(live) OVER w AS pl, LAG(ship_mode) OVER w AS pm, LAG(ship_date) OVER w AS pd FROM ver WINDOW w AS (PARTITION BY k ORDER BY v)),
evs AS (SELECT k, v, CASE WHEN live AND NOT COALESCE(pl, false) THEN 'INSERT' WHEN NOT live AND COALESCE(pl, false) THEN 'DELETE' WHEN live AND (ship_mode IS DISTINCT FROM pm OR ship_date IS DISTINCT FROM pd) THEN 'UPDATE' END AS a FROM lag1)"""
SQL["order_versions"] = q("SELECT k AS record_key, COUNT(*) AS events, " + ", ".join(n_if(f"a = '{a}'") + f" AS {a.lower()}" for a in ("INSERT", "UPDATE", "DELETE")) + ", CAST(MAX(v) AS INTEGER) AS last_version FROM evs WHERE a IS NOT NULL GROUP BY 1", SNAP, VERS)
SQL["record_history"] = q("SELECT audit_id, record_key, version, action_type, old_ship_mode, new_ship_mode FROM seqd WHERE n = (SELECT MAX(n) FROM seqd)", SNAP, VERS,
    "seqd AS (SELECT ROW_NUMBER() OVER (ORDER BY k, v) AS audit_id, k AS record_key, v AS version, a AS action_type, pm AS old_ship_mode, m AS new_ship_mode, COUNT(*) OVER (PARTITION BY k) AS n FROM evs2 WHERE a IS NOT NULL)".replace("evs2", "(SELECT e.k, e.v, e.a, CASE WHEN l.pl THEN l.pm END AS pm, CASE WHEN l.live THEN l.ship_mode END AS m FROM evs e JOIN lag1 l ON e.k = l.k AND e.v = l.v)"))

# ---- views after a day of changes: the same statements over changed lines and orders
_LATER = f"""lines AS (
  SELECT order_key, CASE WHEN source_row_id % 10 = 5 AND product_key > 1 THEN product_key - 1 ELSE product_key END AS product_key, source_row_id, discount,
    CASE WHEN source_row_id % 10 = 1 THEN CAST(sales + 25 AS DECIMAL(15,6)) ELSE sales END AS sales, quantity, CASE WHEN source_row_id % 10 = 3 THEN NULL ELSE profit END AS profit
  FROM lines0 WHERE order_key % 20 <> 0 AND source_row_id % 10 <> 7
  UNION ALL SELECT order_key + {MOVED}, CASE WHEN source_row_id % 10 = 5 AND product_key > 1 THEN product_key - 1 ELSE product_key END, source_row_id + {MOVED}, discount,
    CASE WHEN source_row_id % 10 = 1 THEN CAST(sales + 25 AS DECIMAL(15,6)) ELSE sales END, quantity, CASE WHEN source_row_id % 10 = 3 THEN NULL ELSE profit END
  FROM lines0 WHERE order_key % 20 = 2 AND source_row_id % 10 <> 7),
headers AS (
  SELECT * REPLACE (CASE WHEN order_key % 20 = 6 THEN order_date + 40 ELSE order_date END AS order_date,
    CASE WHEN order_key % 20 = 6 THEN ship_date + 40 WHEN order_key % 10 = 1 THEN ship_date + 1 ELSE ship_date END AS ship_date,
    CASE WHEN order_key % 10 = 1 THEN shipping_days + 1 ELSE shipping_days END AS shipping_days, CASE WHEN order_key % 10 = 3 THEN NULL ELSE ship_mode END AS ship_mode)
  FROM headers0 WHERE order_key % 20 <> 0
  UNION ALL SELECT * REPLACE (order_key + {MOVED} AS order_key, CAST(order_key + {MOVED} AS VARCHAR) AS order_id) FROM headers0 WHERE order_key % 20 = 2),
products AS ("""


def after_changes(statement: str) -> str:
    return statement.replace("\nlines AS (", "\nlines0 AS (", 1).replace("\nheaders AS (", "\nheaders0 AS (", 1).replace("\nproducts AS (", "\n" + _LATER, 1)


for name in ("order_summary", "monthly_performance", "subcategory_performance", "customer_performance", "geographic_performance",
             "product_performance", "segment_performance", "ship_mode_performance", "category_performance", "business_overview"):
    SQL[f"view_{name}_refreshed"] = after_changes(VIEW_SQL[f"view_{name}"])
