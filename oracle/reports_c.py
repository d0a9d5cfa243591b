"""Check statements: profiling, cleaning, loading and the normalised model."""

from __future__ import annotations

from oracle.base import big, d, n_if, r

COLS = ("row_id order_id order_date ship_date ship_mode customer_id customer_name segment country city state postal_code region "
        "product_id category sub_category product_name sales quantity discount profit").split()
ALL = ", ".join(COLS)

RAW = """
src AS (
  SELECT o_orderkey AS o, c_custkey AS c, p_partkey AS p, l_linenumber AS n, l_suppkey AS s, CAST(o_orderdate AS DATE) AS d,
    (c_custkey + o_orderkey) % 12 AS b, c_name, n_name, n_nationkey, r_name, p_brand, p_name, CAST(l_quantity AS INTEGER) AS q,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class' WHEN '3-MEDIUM' THEN 'Second Class' WHEN '5-LOW' THEN 'Standard Class' END AS m,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 6 AS DECIMAL(4,2)) AS disc, CAST(p_retailprice AS DECIMAL(15,2)) AS pr
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
priced AS (SELECT *, CAST(q * pr * (1 - disc) AS DECIMAL(15,4)) AS net FROM src),
once AS (
  SELECT CAST((o * 8 + n) * 1000003 + p % 1000003 AS VARCHAR) AS row_id, 'OR-' || o AS order_id,
    CASE WHEN o % 80 = 4 THEN 'Jan 4' WHEN o % 80 = 12 THEN '99.99.2023' WHEN o % 8 = 0 THEN strftime(d, '%Y-%m-%d') || ' 00:00:00'
      WHEN o % 8 = 1 THEN strftime(d, '%d-%b-%Y') WHEN o % 8 = 2 THEN strftime(d, '%d.%m.%Y') WHEN o % 8 = 3 THEN strftime(d, '%Y%m%d') ELSE strftime(d, '%Y-%m-%d') END AS order_date,
    strftime(d + CASE WHEN o % 97 = 5 THEN -2 ELSE CAST(o % 11 AS INTEGER) END, '%Y-%m-%d') AS ship_date,
    CASE WHEN m IS NULL THEN '' WHEN (o + n) % 5 = 0 THEN NULL WHEN o % 31 = 7 AND n % 2 = 0 THEN 'Same Day' WHEN o % 13 = 3 THEN '  ' || m || ' ' ELSE m END AS ship_mode,
    CASE WHEN o % 41 = 6 THEN 'CX-' ELSE 'CU-' END || c AS customer_id, c_name || CASE WHEN c % 173 = 7 AND o % 5 = 1 THEN ' Jr' ELSE '' END AS customer_name,
    CASE WHEN o % 211 = 9 THEN 'Retail'
      WHEN c % 3 = 0 THEN CASE o % 7 WHEN 1 THEN 'Counsumer' WHEN 2 THEN 'CONSUMR' WHEN 3 THEN 'consumer' ELSE 'Consumer' END
      WHEN c % 3 = 1 THEN CASE o % 7 WHEN 1 THEN 'corp.' WHEN 2 THEN 'Corperate' ELSE 'Corporate' END
      ELSE CASE o % 7 WHEN 1 THEN 'home-office' WHEN 2 THEN 'HomeOffice' ELSE 'Home Office' END END AS segment,
    n_name AS country, n_name || CASE WHEN b = 3 AND o % 37 = 4 THEN '_Old' ELSE '_C' END || b AS city, n_name || '_S' || (b % 4) AS state,
    CAST(n_nationkey * 100 + b AS VARCHAR) AS postal_code, r_name AS region, 'P-' || CASE WHEN p % 50 = 1 THEN p - 1 ELSE p END AS product_id,
    CASE WHEN n = 3 THEN ' ' ELSE '' END || CASE p % 3 WHEN 0 THEN 'Furniture' WHEN 1 THEN 'Office Supplies' ELSE 'Technology' END || CASE WHEN n = 3 THEN '  ' ELSE '' END AS category,
    CASE WHEN p % 211 = 5 AND n = 2 THEN 'Brand#99' ELSE p_brand END AS sub_category, p_name || ' #' || p AS product_name,
    CASE WHEN (o * 13 + n) % 509 = 7 THEN replace(CAST(net AS VARCHAR), '.', ',') WHEN (o + p) % 23 = 0 THEN NULL WHEN (o + p) % 46 = 1 THEN '   ' ELSE CAST(net AS VARCHAR) END AS sales,
    CASE WHEN (o * 17 + n) % 509 = 9 THEN 'two' WHEN (p + s) % 29 = 0 THEN NULL ELSE q || CASE WHEN o % 3 = 0 THEN '.0' ELSE '' END END AS quantity,
    CASE WHEN disc = 0.54 AND o % 4 = 0 THEN '5.5' ELSE CAST(disc AS VARCHAR) END AS discount,
    CASE WHEN (o * 19 + n) % 509 = 11 THEN 'abc' WHEN (o + s) % 19 = 0 THEN NULL ELSE CAST(CAST(net * CAST((p % 7 - 2) * 0.1 AS DECIMAL(3,1)) AS DECIMAL(15,5)) AS VARCHAR) END AS profit,
    (o * 7 + n) % 20 = 0 AS twice
  FROM priced),
raw AS (SELECT * EXCLUDE (twice) FROM once UNION ALL SELECT * EXCLUDE (twice) FROM once WHERE twice)
"""


def blank(table: str) -> str:
    return f"SELECT {', '.join(f'NULLIF(trim({c}), $$$$) AS {c}' for c in COLS)} FROM {table}".replace("$$$$", "''")


SEGMENT = ("CASE WHEN lower(segment) IN ('consumer', 'counsumer', 'consumr') THEN 'Consumer' WHEN lower(segment) IN ('corporate', 'corp.', 'corperate') THEN 'Corporate' "
           "WHEN lower(segment) IN ('home office', 'home-office', 'homeoffice') THEN 'Home Office' ELSE segment END")


def full(pattern: str, c: str = "order_date") -> str:
    return f"regexp_full_match({c}, '{pattern}')"


ISO = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
DAY = (f"CASE WHEN {full(ISO)} THEN order_date WHEN {full(ISO + ' [0-9]{2}:[0-9]{2}:[0-9]{2}')} THEN strftime(try_strptime(order_date, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d') "
       f"WHEN {full('[0-9]{2}-[A-Za-z]{3}-[0-9]{4}')} THEN strftime(try_strptime(order_date, '%d-%b-%Y'), '%Y-%m-%d') "
       f"WHEN {full('[0-9]{2}[.][0-9]{2}[.][0-9]{4}')} THEN strftime(try_strptime(order_date, '%d.%m.%Y'), '%Y-%m-%d') "
       f"WHEN {full('[0-9]{8}')} THEN strftime(try_strptime(order_date, '%Y%m%d'), '%Y-%m-%d') ELSE order_date END")
DISC = "CASE WHEN TRY_CAST(discount AS DECIMAL(10,4)) = 5.5 THEN '0.55' ELSE discount END"
TIDY = f"plain AS ({blank('(SELECT DISTINCT * FROM raw)')}),\ntidy AS (SELECT * REPLACE ({SEGMENT} AS segment, {DAY} AS order_date, {DISC} AS discount) FROM plain)"


def num(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(20,6))"


def exact(e: str, digits: int, kind: str) -> str:
    return f"CAST(ROUND(CAST(CAST({e} AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS {kind})"


DK = "TRY_CAST(discount AS DECIMAL(10,4))"
QUOT = f"(CAST({num('sales')} AS DOUBLE) / CAST(unit_price AS DOUBLE))"
SALES_OK = "sales IS NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL"
QUANT_OK = f"quantity IS NULL AND sales IS NOT NULL AND unit_price > 0 AND round({QUOT}) > 0 AND abs({QUOT} - round({QUOT})) < 0.000001"
PROFIT_OK = "profit IS NULL AND sales IS NOT NULL AND margin IS NOT NULL"
TEXT = f"""
modes AS (SELECT order_id, MIN(ship_mode) AS v FROM tidy WHERE ship_mode IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT ship_mode) = 1),
prices AS (SELECT product_id, {DK} AS dk, MIN(up) AS unit_price FROM (SELECT *, {exact(f"CAST({num('sales')} AS DOUBLE) / CAST({num('quantity')} AS DOUBLE)", 6, 'DECIMAL(20,6)')} AS up FROM tidy
  WHERE sales IS NOT NULL AND {num('quantity')} > 0 AND discount IS NOT NULL) GROUP BY 1, 2 HAVING COUNT(DISTINCT up) = 1),
found AS (SELECT t.*, unit_price, {DK} AS dk2 FROM tidy t LEFT JOIN prices p ON p.product_id = t.product_id AND p.dk = TRY_CAST(t.discount AS DECIMAL(10,4))),
filled AS (SELECT * REPLACE (CASE WHEN {SALES_OK} THEN CAST(CAST(CAST(TRY_CAST(quantity AS DECIMAL(12,6)) * unit_price AS DECIMAL(38,12)) AS DECIMAL(20,6)) AS VARCHAR) ELSE sales END AS sales,
  CASE WHEN {QUANT_OK} THEN CAST(CAST(round({QUOT}) AS BIGINT) AS VARCHAR) ELSE quantity END AS quantity) FROM found),
margins AS (SELECT product_id, dk2, MIN(mg) AS margin FROM (SELECT *, {exact(f"CAST({num('profit')} AS DOUBLE) / CAST({num('sales')} AS DOUBLE)", 10, 'DECIMAL(12,10)')} AS mg FROM filled
  WHERE profit IS NOT NULL AND {num('sales')} <> 0) GROUP BY 1, 2 HAVING COUNT(*) >= 2 AND COUNT(DISTINCT mg) = 1),
joined AS (SELECT f.* REPLACE (COALESCE(f.ship_mode, modes.v) AS ship_mode), margin FROM filled f LEFT JOIN margins g ON g.product_id = f.product_id AND g.dk2 = f.dk2 LEFT JOIN modes ON modes.order_id = f.order_id),
gained AS (SELECT * REPLACE (CASE WHEN {PROFIT_OK} THEN CAST(CAST(ROUND({num('sales')} * margin, 6) AS DECIMAL(20,6)) AS VARCHAR) ELSE profit END AS profit) FROM joined),
ids AS (SELECT customer_name, customer_id, MIN(CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE)) AS f FROM tidy GROUP BY 1, 2),
alias AS (SELECT customer_name AS an, customer_id AS a, FIRST_VALUE(customer_id) OVER (PARTITION BY customer_name ORDER BY (f IS NULL), f, customer_id) AS canon FROM ids),
usual AS (SELECT postal_code AS pc, city AS u FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY postal_code ORDER BY n DESC, city DESC) AS k FROM (SELECT postal_code, city, COUNT(*) n FROM tidy GROUP BY 1, 2)) WHERE k = 1),
txt AS (SELECT {', '.join('COALESCE(canon, customer_id) AS customer_id' if c == 'customer_id' else 'COALESCE(u, city) AS city' if c == 'city' else c for c in COLS)}
  FROM gained LEFT JOIN alias ON a = customer_id AND an = customer_name LEFT JOIN usual ON pc = postal_code)
"""
REQUIRED = [c for c in COLS if c not in ("ship_mode", "sales", "quantity", "profit")]
RULES = {**{f"{c}_missing": f"{c} IS NULL" for c in REQUIRED}, "ship_before_order": "ship_date < order_date",
         "segment_domain": "segment NOT IN ('Consumer', 'Corporate', 'Home Office')", "category_domain": "category NOT IN ('Furniture', 'Office Supplies', 'Technology')",
         "ship_mode_domain": "ship_mode NOT IN ('Standard Class', 'Second Class', 'First Class', 'Same Day')", "sales_not_positive": "sales <= 0",
         "quantity_not_positive": "quantity <= 0", "discount_range": "discount NOT BETWEEN 0 AND 1"}
LOST = {c: f"({c} IS NOT NULL AND {t} IS NULL)" for c, t in (
    ("sales", "TRY_CAST(sales AS DECIMAL(15,6))"), ("quantity", num("quantity")), ("profit", "TRY_CAST(profit AS DECIMAL(15,6))"))}
CONFLICTS = (("customer_conflict", "customer_id", ("customer_name", "segment")), ("product_conflict", "product_id, product_name", ("category", "sub_category")),
             ("order_conflict", "order_id, customer_id, region, country, state, city, postal_code", ("order_date", "ship_date", "ship_mode")))


def conflict(keys: str, attributes: tuple[str, ...]) -> str:
    over = f"OVER (PARTITION BY broken_rules = '', {keys})"
    return "broken_rules = '' AND (" + " OR ".join(
        f"coalesce(MIN({a}) {over} <> MAX({a}) {over}, false) OR COUNT({a}) {over} NOT IN (0, COUNT(*) {over})" for a in attributes) + ")"


CLEAN = f"""
typ AS (SELECT * REPLACE (TRY_CAST(row_id AS BIGINT) AS row_id, CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date, CAST(try_strptime(ship_date, '%Y-%m-%d') AS DATE) AS ship_date,
  TRY_CAST(sales AS DECIMAL(15,6)) AS sales, CAST(ROUND({num('quantity')}) AS BIGINT) AS quantity, TRY_CAST(discount AS DECIMAL(4,2)) AS discount, TRY_CAST(profit AS DECIMAL(15,6)) AS profit), {', '.join(f'{t} AS {c}_lost' for c, t in LOST.items())} FROM txt),
ruled AS (SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {t} THEN '{n}' END" for n, t in RULES.items())}, CASE WHEN COUNT(*) OVER (PARTITION BY row_id) > 1 THEN 'row_id_repeated' END, {', '.join(f"CASE WHEN {c}_lost THEN '{c}_unreadable' END" for c in LOST)}) AS broken_rules FROM typ),
judged AS (SELECT * REPLACE (CASE WHEN broken_rules <> '' THEN broken_rules ELSE concat_ws(',', {', '.join(f"CASE WHEN {conflict(k, a)} THEN '{n}' END" for n, k, a in CONFLICTS)}) END AS broken_rules) FROM ruled),
clean AS (SELECT * EXCLUDE (broken_rules, {', '.join(f'{c}_lost' for c in LOST)}) FROM judged WHERE broken_rules = '')
"""
PLACE = "region, country, state, city, postal_code"
MODEL = """
segments AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY segment) AS INTEGER) AS segment_id, segment AS segment_name FROM (SELECT DISTINCT segment FROM clean)),
ship_modes AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY ship_mode) AS INTEGER) AS ship_mode_id, ship_mode AS ship_mode_name FROM (SELECT DISTINCT ship_mode FROM clean WHERE ship_mode IS NOT NULL)),
regions AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY region) AS INTEGER) AS region_id, region AS region_name FROM (SELECT DISTINCT region FROM clean)),
categories AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY category) AS INTEGER) AS category_id, category AS category_name FROM (SELECT DISTINCT category FROM clean)),
sub_categories AS (SELECT ROW_NUMBER() OVER (ORDER BY category_id, sub_category) AS sub_category_id, category_id, sub_category AS sub_category_name FROM (SELECT DISTINCT category_id, sub_category FROM clean JOIN categories ON category = category_name)),
locations AS (SELECT ROW_NUMBER() OVER (ORDER BY country, state, city, postal_code, region_id) AS location_id, * FROM (SELECT DISTINCT region_id, country, city, state, postal_code FROM clean JOIN regions ON region = region_name)),
customers AS (SELECT DISTINCT customer_id, segment_id, customer_name FROM clean JOIN segments ON segment = segment_name),
products AS (SELECT ROW_NUMBER() OVER (ORDER BY source_product_id, product_name, sub_category_id) AS product_key, * FROM (SELECT DISTINCT product_id AS source_product_id, sub_category_id, product_name FROM clean JOIN categories ON category = category_name JOIN sub_categories USING (category_id) WHERE sub_category = sub_category_name)),
placed AS (SELECT location_id, region_name AS region, country, state, city, postal_code FROM locations JOIN regions USING (region_id)),
hdr AS (SELECT DISTINCT order_id AS source_order_id, customer_id, location_id, ship_mode_id, order_date, ship_date FROM clean JOIN placed USING (region, country, state, city, postal_code) LEFT JOIN ship_modes ON ship_mode = ship_mode_name),
ord AS (SELECT ROW_NUMBER() OVER (ORDER BY source_order_id, customer_id, location_id, ship_mode_id NULLS FIRST, order_date, ship_date) AS order_key, * FROM hdr),
fct AS (SELECT row_id AS source_row_id, order_key, product_key, sales, quantity, discount, profit FROM clean c JOIN placed USING (region, country, state, city, postal_code) LEFT JOIN ship_modes sm ON c.ship_mode = sm.ship_mode_name
  JOIN ord o ON o.source_order_id = c.order_id AND o.customer_id = c.customer_id AND o.location_id = placed.location_id AND o.order_date = c.order_date AND o.ship_date = c.ship_date AND o.ship_mode_id IS NOT DISTINCT FROM sm.ship_mode_id
  JOIN products p ON p.source_product_id = c.product_id AND p.product_name = c.product_name),
order_details AS (SELECT ROW_NUMBER() OVER (ORDER BY source_row_id, order_key, product_key) AS order_detail_key, * FROM fct)
"""
STAGES = {"raw": [RAW], "tidy": [RAW, TIDY], "text": [RAW, TIDY, TEXT], "clean": [RAW, TIDY, TEXT, CLEAN], "model": [RAW, TIDY, TEXT, CLEAN, MODEL]}


def q(stage: str, body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in [*STAGES[stage], *ctes]) + "\n" + body


SQL: dict[str, str] = {}
DAYS = "CAST(CAST(try_strptime(ship_date, '%Y-%m-%d') AS DATE) - CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS INTEGER)"


def nulls(table: str, cols) -> str:
    return f"SELECT {', '.join(n_if(c + ' IS NULL') + f' AS {c}_null' for c in cols)} FROM {table}"


for c in ("segment", "category", "sub_category", "region"):
    SQL[f"raw_domain_{c}"] = q("raw", f"SELECT DISTINCT {c} FROM raw")
for c in ("segment", "category"):
    SQL[f"raw_frequency_{c}"] = q("raw", f"SELECT {c}, COUNT(*) AS total FROM raw GROUP BY 1")
SQL["tidy_frequency_segment"] = q("tidy", "SELECT segment, COUNT(*) AS total FROM tidy GROUP BY 1")
SQL["tidy_frequency_discount"] = q("tidy", "SELECT discount, COUNT(*) AS total FROM tidy GROUP BY 1")
SQL["tidy_frequency_ship_mode"] = q("tidy", "SELECT COALESCE(ship_mode, '[NULL]') AS ship_mode, COUNT(*) AS total FROM tidy GROUP BY 1")
SQL["text_frequency_ship_mode"] = q("text", "SELECT COALESCE(ship_mode, '[NULL]') AS ship_mode, COUNT(*) AS total FROM txt GROUP BY 1")
SQL["raw_row_count"] = q("raw", f"SELECT COUNT(*) AS total_rows, {len(COLS)} AS total_columns FROM raw")
SQL["raw_null_counts"] = q("raw", nulls("raw", COLS))
_BLANKS = ", ".join(n_if(f"trim({c}) = ''") + f" AS {c}_blank" for c in COLS)
SQL["raw_blank_counts"] = q("raw", f"SELECT {_BLANKS} FROM raw")
SQL["raw_duplicates"] = q("raw", f"SELECT COUNT(*) AS duplicate_groups, {big('SUM(n)')} AS rows_involved, {big('SUM(n - 1)')} AS excess_rows FROM (SELECT COUNT(*) n FROM raw GROUP BY {ALL} HAVING COUNT(*) > 1)")
SQL["tidy_duplicates"] = q("tidy", f"SELECT COUNT(*) AS duplicate_groups FROM (SELECT COUNT(*) n FROM tidy GROUP BY {ALL} HAVING COUNT(*) > 1)")
SQL["raw_distinct_counts"] = q("raw", "SELECT " + ", ".join(f"COUNT(DISTINCT {c}) AS {a}" for c, a in {
    "order_id": "orders", "customer_id": "customers", "product_id": "products", "city": "cities", "state": "states", "region": "regions",
    "category": "categories", "sub_category": "sub_categories", "segment": "segments"}.items()) + " FROM raw")
SQL["raw_date_formats"] = q("raw", f"SELECT CASE WHEN {full(ISO + ' 00:00:00')} THEN 'YYYY-MM-DD HH:MM:SS' WHEN {full('[0-9]{2}-[A-Za-z]{3}-[0-9]{4}')} THEN 'DD-MMM-YYYY' "
    f"WHEN {full('[0-9]{2}[.][0-9]{2}[.][0-9]{4}')} THEN 'DD.MM.YYYY' WHEN {full('[0-9]{8}')} THEN 'YYYYMMDD' ELSE 'OTRO' END AS format, COUNT(*) AS total FROM raw GROUP BY 1")
SQL["segment_preview"] = q("tidy", f"SELECT DISTINCT segment AS segment_original, {SEGMENT} AS segment_clean FROM plain")
SQL["date_preview"] = q("tidy", f"SELECT DISTINCT order_date AS original_date, {DAY} AS normal_date FROM plain ORDER BY 1 NULLS FIRST")
SQL["discount_preview"] = q("tidy", f"SELECT discount AS discount_original, {DISC} AS discount_corrected, COUNT(*) AS total FROM plain GROUP BY 1, 2")
_NUM = "-?[0-9]+([.][0-9]+)?"
SQL["numeric_formats"] = q("tidy", "SELECT " + ", ".join([n_if(f"{c} IS NULL") + f" AS {c}_null" for c in ("sales", "quantity", "discount", "profit")] + [
    n_if("NOT " + full("[0-9]+([.]0+)?" if c == "quantity" else _NUM, c)) + f" AS {c}_bad_format" for c in ("sales", "quantity", "discount", "profit")]) + " FROM tidy")
SQL["numeric_rules"] = q("tidy", f"SELECT {n_if(num('sales') + ' <= 0')} AS sales_not_positive, {n_if(num('quantity') + ' <= 0')} AS quantity_not_positive, "
    f"{n_if(num('quantity') + ' <> floor(' + num('quantity') + ')')} AS quantity_not_whole, {n_if(num('discount') + ' NOT BETWEEN 0 AND 1')} AS discount_out_of_range FROM plain")
SQL["discounts_out_of_range"] = q("tidy", f"SELECT discount, COUNT(*) AS total FROM plain WHERE {num('discount')} NOT BETWEEN 0 AND 1 GROUP BY 1")
SQL["missing_patterns"] = q("tidy", "SELECT " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in ("sales", "quantity", "profit")) + ", COUNT(*) AS total FROM tidy GROUP BY 1, 2, 3")
SQL["all_measures_missing"] = q("tidy", "SELECT row_id, order_id, product_id, product_name, discount, sales, quantity, profit FROM tidy WHERE sales IS NULL AND quantity IS NULL AND profit IS NULL")
SQL["ship_mode_recoverable"] = q("text", f"SELECT COUNT(*) AS ship_mode_null, COUNT(v) AS recoverable, {n_if('v IS NULL')} AS not_recoverable FROM tidy LEFT JOIN modes USING (order_id) WHERE ship_mode IS NULL")
SQL["measures_recoverable"] = q("text", f"SELECT {n_if(SALES_OK)} AS sales_recoverable, {n_if(QUANT_OK)} AS quantity_recoverable FROM found")
SQL["profit_recoverable"] = q("text", f"SELECT COUNT(*) AS profit_null, {n_if(PROFIT_OK)} AS recoverable, {n_if(f'NOT ({PROFIT_OK})')} AS not_recoverable FROM joined WHERE profit IS NULL")
SQL["date_checks"] = q("text", f"SELECT {n_if('order_date IS NULL OR NOT ' + full(ISO))} AS order_dates_not_iso, {n_if('ship_date IS NULL OR NOT ' + full(ISO, 'ship_date'))} AS ship_dates_not_iso, "
    f"{n_if("ship_date IS NOT NULL AND try_strptime(ship_date, '%Y-%m-%d') IS NULL")} AS ship_dates_impossible, {n_if(DAYS + ' < 0')} AS shipped_before_order, "
    f"MIN({DAYS}) AS least_days, MAX({DAYS}) AS most_days, {r(f'CAST(SUM({DAYS}) AS DOUBLE) / COUNT({DAYS})')} AS average_days FROM txt")
SQL["shipped_before_order"] = q("text", f"SELECT row_id, order_id, order_date, ship_date, ship_mode FROM txt WHERE {DAYS} < 0")


def broken(key: str, attr: str, table: str) -> str:
    return f"(SELECT COUNT(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT {attr}) > 1))"


SQL["dependency_violations"] = q("tidy", "SELECT " + ", ".join(f"{broken(k, a, 'tidy')} AS {n}" for n, k, a in (
    ("customers_with_several_names", "customer_id", "customer_name"), ("customers_with_several_segments", "customer_id", "segment"), ("products_with_several_names", "product_id", "product_name"),
    ("products_with_several_categories", "product_id", "category"), ("products_with_several_sub_categories", "product_id", "sub_category"), ("names_with_several_customers", "customer_name", "customer_id"))))


def values(key: str, attrs: dict[str, str], count: str) -> str:
    lists = ", ".join(f"string_agg(DISTINCT {a}, ' | ' ORDER BY {a}) AS {n}" for a, n in attrs.items())
    return f"SELECT {key}, {lists}, COUNT(*) AS {count} FROM tidy WHERE {key} IS NOT NULL GROUP BY 1 HAVING " + " OR ".join(f"COUNT(DISTINCT {a}) > 1" for a in attrs)


SQL["product_name_conflicts"] = q("tidy", values("product_id", {"product_name": "names_found"}, "total_rows"))
SQL["customer_name_conflicts"] = q("tidy", values("customer_id", {"customer_name": "names_found"}, "total_rows"))
SQL["customer_segment_conflicts"] = q("tidy", values("customer_id", {"segment": "segments_found"}, "total_rows"))
SQL["product_category_conflicts"] = q("tidy", values("product_id", {"category": "categories_found"}, "total_rows"))
SQL["product_sub_category_conflicts"] = q("tidy", values("product_id", {"sub_category": "sub_categories_found"}, "total_rows"))
SQL["ship_mode_recoverable_rows"] = q("text", "SELECT row_id, order_id, v AS ship_mode_found FROM tidy JOIN modes USING (order_id) WHERE ship_mode IS NULL")
SQL["sales_recoverable_rows"] = q("text", "SELECT row_id, product_id, discount, quantity, sales AS sales_original, "
    f"{d('CAST(CAST(TRY_CAST(quantity AS DECIMAL(12,6)) * unit_price AS DECIMAL(38,12)) AS DECIMAL(20,6))')} AS sales_computed FROM found WHERE {SALES_OK}")
SQL["quantity_recoverable_rows"] = q("text", f"SELECT row_id, product_id, discount, sales, quantity AS quantity_original, CAST(round({QUOT}) AS BIGINT) AS quantity_computed FROM found WHERE {QUANT_OK}")
SQL["profit_recoverable_rows"] = q("text", f"SELECT row_id, product_id, discount, sales, profit AS profit_original, {d('margin')} AS margin, {d('CAST(ROUND(' + num('sales') + ' * margin, 6) AS DECIMAL(20,6))')} AS profit_computed FROM joined WHERE {PROFIT_OK}")
SQL["customer_id_conflicts"] = q("tidy", values("customer_name", {"customer_id": "customer_ids"}, "total_rows"))
SQL["customer_id_conflicts_after"] = q("text", f"SELECT {broken('customer_name', 'customer_id', 'txt')} AS names_with_several_customers")
REUSED = "ru AS (SELECT product_id, COUNT(DISTINCT product_name) n FROM txt GROUP BY 1 HAVING COUNT(DISTINCT product_name) > 1)"
SQL["reused_product_detail"] = q("text", "SELECT product_id, category, sub_category, product_name, COUNT(*) AS total_rows, MIN(order_date) AS first_seen, MAX(order_date) AS last_seen FROM txt WHERE product_id IN (SELECT product_id FROM ru) GROUP BY 1, 2, 3, 4", REUSED)
SQL["reused_product_summary"] = q("text", f"SELECT COUNT(*) AS reused_product_ids, {big('SUM(n)')} AS id_name_pairs FROM ru", REUSED)
OA = "order_date ship_date ship_mode customer_id customer_name segment country city state postal_code region".split()
OC = f"oc AS (SELECT order_id, {', '.join(f'COUNT(DISTINCT {a}) AS total_{a}' for a in OA)} FROM txt GROUP BY 1)"
SQL["order_consistency"] = q("text", "SELECT " + ", ".join(n_if(f"total_{a} > 1") + f" AS orders_with_several_{a}" for a in OA) + " FROM oc", OC)
SQL["order_consistency_list"] = q("text", "SELECT * FROM oc WHERE " + " OR ".join(f"total_{a} > 1" for a in OA), OC)
SQL["inconsistent_orders"] = q("tidy", values("order_id", {"customer_id": "customer_ids", "city": "cities", "postal_code": "postal_codes"}, "total_lines"))
SQL["inconsistent_order_lines"] = q("tidy", "SELECT row_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment, city, state, postal_code, product_id, product_name, sales, quantity FROM tidy "
    "WHERE order_id IN (SELECT order_id FROM tidy GROUP BY 1 HAVING COUNT(DISTINCT customer_id) > 1 OR COUNT(DISTINCT city) > 1 OR COUNT(DISTINCT postal_code) > 1)")
SQL["alias_history"] = q("tidy", "SELECT customer_name, customer_id, COUNT(*) AS total_rows, COUNT(DISTINCT order_id) AS total_orders, MIN(order_date) AS first_seen, MAX(order_date) AS last_seen FROM tidy "
    "WHERE customer_name IN (SELECT customer_name FROM tidy GROUP BY 1 HAVING COUNT(DISTINCT customer_id) > 1) GROUP BY 1, 2")
SQL["key_check"] = q("text", "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT row_id) AS unique_row_ids, (SELECT COUNT(*) FROM (SELECT row_id FROM txt GROUP BY 1 HAVING COUNT(*) > 1)) AS repeated_row_ids, "
    + ", ".join(n_if(f"{c} IS NULL") + f" AS {c}_null" for c in ("row_id", "order_id", "customer_id", "product_id")) + " FROM txt")
PA = ("city", "state", "country", "region")
for name, stage, table in (("postal_consistency", "tidy", "tidy"), ("postal_consistency_after", "text", "txt")):
    SQL[name] = q(stage, "SELECT " + ", ".join(f"{broken('postal_code', a, table)} AS codes_with_several_{a}" for a in PA))
SQL["postal_conflicts"] = q("tidy", values("postal_code", {a: f"{a}_values" for a in PA}, "total_rows"))
PC = "hit AS (SELECT * FROM tidy WHERE postal_code IN (SELECT postal_code FROM tidy GROUP BY 1 HAVING " + " OR ".join(f"COUNT(DISTINCT {a}) > 1" for a in PA) + "))"
SQL["postal_drilldown"] = q("tidy", "SELECT postal_code, city, state, country, region, COUNT(*) AS total_rows, COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS total_customers, MIN(order_date) AS first_seen, MAX(order_date) AS last_seen FROM hit GROUP BY 1, 2, 3, 4, 5", PC)
SQL["postal_customers"] = q("tidy", "SELECT customer_id, customer_name, city, state, postal_code, COUNT(*) AS total_rows FROM tidy WHERE customer_id IN (SELECT customer_id FROM hit) GROUP BY 1, 2, 3, 4, 5", PC)
BAD_SEG = "segment IS NULL OR segment NOT IN ('Consumer', 'Corporate', 'Home Office')"
SQL["domain_check"] = q("text", f"SELECT {n_if(BAD_SEG)} AS invalid_segments, COUNT(DISTINCT ship_mode) FILTER (WHERE {RULES['ship_mode_domain']}) AS invalid_ship_modes FROM txt")
SQL["quality_scorecard"] = q("text", "SELECT COUNT(*) AS total_rows, " + ", ".join(n_if(f"{c} IS NULL") + f" AS {c}_null" for c in ("row_id", "order_id", "customer_id", "product_id"))
    + f", {n_if('order_date IS NULL OR NOT ' + full(ISO))} AS order_dates_invalid, {n_if('ship_date IS NULL OR NOT ' + full(ISO, 'ship_date'))} AS ship_dates_invalid, {n_if(DAYS + ' < 0')} AS shipped_before_order, "
    f"{n_if(BAD_SEG)} AS segments_invalid, {n_if('category IS NULL OR ' + RULES['category_domain'])} AS categories_invalid, {n_if(RULES['ship_mode_domain'])} AS ship_modes_invalid, "
    f"{n_if(num('discount') + ' NOT BETWEEN 0 AND 1')} AS discounts_out_of_range, {n_if(num('quantity') + ' <= 0 OR ' + num('quantity') + ' <> floor(' + num('quantity') + ')')} AS quantities_invalid, COUNT(DISTINCT row_id) AS unique_row_ids FROM txt")
SQL["cleaned_text"] = q("text", f"SELECT {ALL} FROM txt")
TYPED = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in ("sales", "discount", "profit") else c for c in COLS)
SQL["clean_sales"] = q("clean", f"SELECT {TYPED} FROM clean")
SQL["quarantine"] = q("clean", "SELECT row_id, order_id, broken_rules FROM judged WHERE broken_rules <> ''")
SQL["load_counts"] = q("clean", "SELECT *, staged_rows - clean_rows - quarantined_rows AS difference FROM (SELECT (SELECT COUNT(*) FROM txt) AS staged_rows, (SELECT COUNT(*) FROM clean) AS clean_rows, (SELECT COUNT(*) FROM judged WHERE broken_rules <> '') AS quarantined_rows)")
_U = ("ship_mode", "sales", "quantity", "profit")
SQL["load_nulls"] = q("clean", "SELECT " + ", ".join(f"a.{c}_null AS {c}_null_staged, b.{c}_null AS {c}_null_typed, b.{c}_null - a.{c}_null AS {c}_null_difference" for c in _U) + f" FROM ({nulls('txt', _U)}) a, ({nulls('(SELECT * REPLACE (' + ', '.join(f'CASE WHEN {c}_lost THEN 0 ELSE {c} END AS {c}' for c in LOST) + ') FROM judged)', _U)}) b")
SQL["rejected_casts"] = q("text", " UNION ALL ".join(f"SELECT row_id, order_id, '{c}' AS measure, {c} AS found FROM txt WHERE {t}" for c, t in LOST.items()))
_SPOILT = "CAST(row_id AS BIGINT) % 1009 = 3"
SQL["corrupt_records"] = q("raw", f"SELECT COUNT(*) AS total_records, {n_if(_SPOILT)} AS corrupt_records, {n_if('NOT ' + _SPOILT)} AS readable_records, {d('SUM(' + num('sales') + f') FILTER (NOT {_SPOILT})')} AS readable_sales FROM raw")
_BROKEN_UP = "CAST(row_id AS BIGINT) % 7 = 3"
SQL["line_break_records"] = q("raw", f"SELECT COUNT(*) AS total_records, {n_if(_BROKEN_UP)} AS records_with_line_breaks, CAST(0 AS BIGINT) AS corrupt_records, "
    f"CAST(SUM(LENGTH(product_name) + CASE WHEN {_BROKEN_UP} THEN LENGTH(category) + 6 ELSE 0 END) AS BIGINT) AS name_characters, {d('SUM(' + num('sales') + ')')} AS readable_sales FROM raw")
_NEW = "CAST(row_id AS BIGINT) % 3 <> 0"
SQL["append_new_rows"] = q("raw", f"SELECT COUNT(DISTINCT CASE WHEN {_NEW} THEN row_id END) AS appended_rows, COUNT(DISTINCT CASE WHEN {_NEW} THEN row_id END) AS appended_keys FROM (SELECT DISTINCT * FROM raw)")
_OTHERS = ", ".join(c for c in COLS if c != "row_id")
SQL["append_contradictions"] = q("raw", "SELECT (SELECT COUNT(*) FROM taken) AS appended_rows, (SELECT COUNT(*) FROM taken WHERE product_name LIKE '% (2)') AS second_rows, "
    "(SELECT COUNT(*) FROM aside) AS set_aside, (SELECT COUNT(DISTINCT row_id) FROM aside) AS contradictory_keys",
    "arriving AS (SELECT DISTINCT * FROM (SELECT * FROM raw UNION ALL SELECT * REPLACE (product_name || ' (2)' AS product_name) FROM raw WHERE CAST(row_id AS BIGINT) % 7 = 1))",
    f"ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY row_id ORDER BY {', '.join(c + ' NULLS FIRST' for c in COLS if c != 'row_id')}) AS k FROM arriving WHERE {_NEW})",
    "taken AS (SELECT * FROM ranked WHERE k = 1)", "aside AS (SELECT * FROM ranked WHERE k > 1)")
SQL["load_size"] = q("raw", f"SELECT COUNT(*) AS total_rows, {len(COLS)} AS total_columns, 'OK' AS status FROM raw")
SQL["model_conflicts"] = q("clean", " UNION ALL ".join(f"SELECT '{n}' AS rule, COUNT(*) AS total_rows FROM judged WHERE list_contains(string_split(broken_rules, ','), '{n}') HAVING COUNT(*) > 0" for n, _, _ in CONFLICTS))
_K = {"sales": "DECIMAL(15,6)", "quantity": "DECIMAL(20,6)", "discount": "DECIMAL(4,2)", "profit": "DECIMAL(15,6)"}


def typed_sum(c: str) -> str:
    return (f"{d('a.' + c)} AS {c}_staged, {big('b.' + c) if c == 'quantity' else d('b.' + c)} AS {c}_typed, {d(f'b.{c} - a.{c}')} AS {c}_difference")


SQL["load_sums"] = q("clean", f"SELECT {', '.join(typed_sum(c) for c in _K)} FROM (SELECT {', '.join(f'SUM(TRY_CAST({c} AS {k})) AS {c}' for c, k in _K.items())} FROM txt) a, (SELECT {', '.join(f'SUM({c}) AS {c}' for c in _K)} FROM judged) b")
SQL["clean_rules"] = q("clean", "SELECT COUNT(*) AS total_rows, " + ", ".join(f"{n_if(t)} AS {n}" for n, t in RULES.items()) + " FROM clean")
SQL["clean_uniqueness"] = q("clean", "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT row_id) AS unique_row_ids, COUNT(*) - COUNT(DISTINCT row_id) AS repeated_row_ids FROM clean")
SQL["clean_ranges"] = q("clean", "SELECT " + ", ".join(f"{f'{fn}({c})' if c == 'quantity' else d(f'{fn}({c})')} AS {n}_{c}" for c in _K for fn, n in (("MIN", "least"), ("MAX", "most"))) + " FROM clean")

# ---- model
TABLES = {"segments": "segments", "ship_modes": "ship_modes", "regions": "regions", "categories": "categories", "sub_categories": "sub_categories",
          "locations": "locations", "customers": "customers", "products": "products", "orders": "ord", "order_details": "order_details"}
for name, table in TABLES.items():
    cols = "* REPLACE (CAST(sales AS DOUBLE) AS sales, CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit)" if name == "order_details" else "*"
    SQL[f"model_{name}"] = q("model", f"SELECT {cols} FROM {table}")
SQL["model_counts"] = q("model", "SELECT " + ", ".join(f"(SELECT COUNT(*) FROM {t}) AS total_{n}" for n, t in TABLES.items()))
SQL["product_listing"] = q("model", "SELECT product_key, source_product_id, product_name, sub_category_name, category_name FROM products JOIN sub_categories USING (sub_category_id) JOIN categories USING (category_id) ORDER BY source_product_id, product_name, product_key")
SQL["lookup_listing"] = q("model", " UNION ALL ".join(f"SELECT '{t}' AS lookup, CAST({k} AS BIGINT) AS id, {n} AS name, (SELECT COUNT(*) FROM {t}) AS lookup_rows FROM {t}" for t, k, n in (
    ("segments", "segment_id", "segment_name"), ("ship_modes", "ship_mode_id", "ship_mode_name"), ("regions", "region_id", "region_name"), ("categories", "category_id", "category_name"))))
SQL["sub_category_listing"] = q("model", "SELECT sub_category_id, category_name, sub_category_name FROM sub_categories JOIN categories USING (category_id)")
SQL["location_listing"] = q("model", "SELECT location_id, country, state, city, postal_code, region_name FROM locations JOIN regions USING (region_id)")
SQL["customer_listing"] = q("model", "SELECT customer_id, customer_name, segment_name FROM customers JOIN segments USING (segment_id)")
SQL["detail_listing"] = q("model", f"SELECT order_detail_key, source_row_id, source_order_id, customer_id, product_name, {d('sales')} AS sales, quantity, {d('discount')} AS discount, {d('profit')} AS profit FROM order_details JOIN ord USING (order_key) JOIN products USING (product_key)")
SQL["order_listing"] = q("model", "SELECT order_key, source_order_id, order_date, ship_date, customer_name, city, state, ship_mode_name FROM ord JOIN customers USING (customer_id) JOIN locations USING (location_id) LEFT JOIN ship_modes USING (ship_mode_id) ORDER BY order_date, source_order_id, order_key")
SQL["unmatched_rows"] = q("model", " UNION ALL ".join(f"SELECT '{n}' AS entity, COUNT(*) AS unmatched FROM clean c WHERE NOT EXISTS ({t})" for n, t in {
    "sub_categories": "SELECT 1 FROM sub_categories JOIN categories USING (category_id) WHERE category_name = c.category AND sub_category_name = c.sub_category",
    "locations": "SELECT 1 FROM placed p WHERE p.region = c.region AND p.country = c.country AND p.state = c.state AND p.city = c.city AND p.postal_code = c.postal_code",
    "customers": "SELECT 1 FROM customers u JOIN segments USING (segment_id) WHERE u.customer_id = c.customer_id AND segment_name = c.segment",
    "products": "SELECT 1 FROM products p JOIN sub_categories USING (sub_category_id) JOIN categories USING (category_id) WHERE p.source_product_id = c.product_id AND p.product_name = c.product_name AND category_name = c.category AND sub_category_name = c.sub_category",
    "orders": "SELECT 1 FROM ord o JOIN placed p USING (location_id) LEFT JOIN ship_modes sm USING (ship_mode_id) WHERE o.source_order_id = c.order_id AND o.customer_id = c.customer_id AND p.region = c.region AND p.country = c.country AND p.state = c.state AND p.city = c.city AND p.postal_code = c.postal_code AND o.order_date = c.order_date AND o.ship_date = c.ship_date AND sm.ship_mode_name IS NOT DISTINCT FROM c.ship_mode",
    "order_details": "SELECT 1 FROM order_details x WHERE x.source_row_id = c.row_id"}.items()))

_REBUILT = """rebuilt AS (SELECT x.source_row_id AS row_id, o.source_order_id AS order_id, o.order_date, o.ship_date, sm.ship_mode_name AS ship_mode, u.customer_id, u.customer_name,
    g.segment_name AS segment, p.country, p.city, p.state, p.postal_code, p.region, r.source_product_id AS product_id, k.category_name AS category,
    b.sub_category_name AS sub_category, r.product_name, x.sales, x.quantity, x.discount, x.profit
    FROM order_details x JOIN ord o USING (order_key) JOIN customers u USING (customer_id) JOIN segments g USING (segment_id) JOIN placed p USING (location_id)
    LEFT JOIN ship_modes sm USING (ship_mode_id) JOIN products r USING (product_key) JOIN sub_categories b USING (sub_category_id) JOIN categories k USING (category_id))"""
_COPY = """copied AS (SELECT * REPLACE (CASE WHEN row_id % 1009 = 7 THEN sales + 0.01 ELSE sales END AS sales, CASE WHEN row_id % 1013 <> 11 THEN profit END AS profit)
    FROM (SELECT * FROM clean WHERE row_id % 997 <> 5 UNION ALL SELECT * FROM clean WHERE row_id % 1019 = 13))"""


def both_ways(other: str) -> tuple[str, ...]:
    """Rows by which two tables differ as multisets, counted by key."""
    cols = ", ".join(COLS)
    sides = (("lost", "clean", other), ("extra", other, "clean"))
    return (*[f"{n} AS (SELECT row_id, COUNT(*) AS n FROM (SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b}) GROUP BY row_id)" for n, a, b in sides],
            "named AS (SELECT row_id, COALESCE(l.n, 0) AS missing_rows, COALESCE(e.n, 0) AS surplus_rows, CASE WHEN e.n IS NULL THEN 'missing' WHEN l.n IS NULL THEN 'surplus' ELSE 'changed' END AS difference FROM lost l FULL JOIN extra e USING (row_id))")


SQL["copy_differences"] = q("clean", "SELECT * FROM named", _COPY, *both_ways("copied"))
SQL["model_row_differences"] = q("model", "SELECT *, CASE WHEN missing_keys + surplus_keys + changed_keys = 0 THEN 'OK' ELSE 'REVISAR' END AS status FROM (SELECT "
    + ", ".join(f"(SELECT COUNT(*) FROM named WHERE difference = '{k}') AS {k}_keys" for k in ("missing", "surplus", "changed"))
    + ", (SELECT COUNT(*) FROM clean) AS clean_rows, (SELECT COUNT(*) FROM order_details) AS model_rows)", _REBUILT, *both_ways("rebuilt"))


def counted(rows: dict[str, str], value: str) -> str:
    inner = " UNION ALL ".join(f"SELECT '{n}' AS control, ({t}) AS {value}" for n, t in rows.items())
    return f"SELECT control, {value}, CASE WHEN {value} = 0 THEN 'OK' ELSE 'REVISAR' END AS status FROM ({inner})"


SIZES = (("Segmentos", "segment", "segments"), ("Modos de envío", "ship_mode", "ship_modes"), ("Regiones", "region", "regions"), ("Categorías", "category", "categories"),
         ("Subcategorías", "category, sub_category", "sub_categories"), ("Ubicaciones", PLACE, "locations"), ("Clientes", "customer_id", "customers"),
         ("Productos", "product_id, product_name", "products"), ("Pedidos", f"order_id, customer_id, {PLACE}", "ord"))
SQL["model_control"] = q("model", "SELECT control, expected, obtained, obtained - expected AS difference, CASE WHEN expected = obtained THEN 'OK' ELSE 'REVISAR' END AS status FROM (" + " UNION ALL ".join(
    [f"SELECT '{n}' AS control, (SELECT COUNT(*) FROM (SELECT DISTINCT {k} FROM clean{' WHERE ship_mode IS NOT NULL' if k == 'ship_mode' else ''})) AS expected, (SELECT COUNT(*) FROM {t}) AS obtained" for n, k, t in SIZES]
    + ["SELECT 'Detalles de pedidos', (SELECT COUNT(*) FROM clean), (SELECT COUNT(*) FROM order_details)"]) + ")")
SQL["model_references"] = q("model", counted({n: f"SELECT COUNT(*) FROM {c} x WHERE x.{k} IS NOT NULL AND x.{k} NOT IN (SELECT {k} FROM {p})" for n, c, p, k in (
    ("Subcategorías sin categoría", "sub_categories", "categories", "category_id"), ("Ubicaciones sin región", "locations", "regions", "region_id"), ("Clientes sin segmento", "customers", "segments", "segment_id"),
    ("Productos sin subcategoría", "products", "sub_categories", "sub_category_id"), ("Pedidos sin cliente", "ord", "customers", "customer_id"), ("Pedidos sin ubicación", "ord", "locations", "location_id"),
    ("Pedidos con modo de envío inválido", "ord", "ship_modes", "ship_mode_id"), ("Detalles sin pedido", "order_details", "ord", "order_key"), ("Detalles sin producto", "order_details", "products", "product_key"))}, "invalid_rows"))
SQL["model_unique_keys"] = q("model", counted({n: f"SELECT COUNT(*) FROM (SELECT 1 FROM {t} GROUP BY {k} HAVING COUNT(*) > 1)" for n, t, k in (
    ("Nombres de segmento duplicados", "segments", "segment_name"), ("Nombres de modo de envío duplicados", "ship_modes", "ship_mode_name"), ("Nombres de región duplicados", "regions", "region_name"),
    ("Nombres de categoría duplicados", "categories", "category_name"), ("Subcategorías duplicadas por categoría", "sub_categories", "category_id, sub_category_name"),
    ("Ubicaciones duplicadas", "locations", "region_id, country, state, city, postal_code"), ("Identificadores de cliente duplicados", "customers", "customer_id"),
    ("Productos duplicados por código y nombre", "products", "source_product_id, product_name"), ("Pedidos lógicos duplicados", "ord", "source_order_id, customer_id, location_id"),
    ("Identificadores de fila duplicados", "order_details", "source_row_id"))}, "duplicate_groups"))
SQL["model_business_rules"] = q("model", counted({n: f"SELECT COUNT(*) FROM {t} WHERE {w}" for n, t, w in (
    ("Pedidos con fecha de envío anterior al pedido", "ord", "ship_date < order_date"), ("Pedidos con fecha del pedido nula", "ord", "order_date IS NULL"), ("Pedidos con fecha de envío nula", "ord", "ship_date IS NULL"),
    ("Detalles con ventas no positivas", "order_details", "sales <= 0"), ("Detalles con cantidades no positivas", "order_details", "quantity <= 0"), ("Detalles con descuento nulo", "order_details", "discount IS NULL"),
    ("Detalles con descuento fuera de rango", "order_details", "discount NOT BETWEEN 0 AND 1"), ("Detalles con identificador de fila no positivo", "order_details", "source_row_id <= 0"))}, "invalid_rows"))
SQL["model_unknowns"] = q("model", f"SELECT COUNT(*) AS total_details, {n_if('sales IS NULL')} AS unknown_sales, {n_if('quantity IS NULL')} AS unknown_quantities, {n_if('profit IS NULL')} AS unknown_profits, {n_if('profit < 0')} AS loss_making, "
    f"{n_if('profit = 0')} AS zero_profit, (SELECT COUNT(*) FROM ord) AS total_orders, (SELECT COUNT(*) FROM ord WHERE ship_mode_id IS NULL) AS unknown_ship_modes FROM order_details")
MC = {"Total de filas": "COUNT(*)", "Ventas conocidas": "COUNT(sales)", "Ventas desconocidas": "COUNT(*) - COUNT(sales)", "Cantidades conocidas": "COUNT(quantity)", "Cantidades desconocidas": "COUNT(*) - COUNT(quantity)",
      "Beneficios conocidos": "COUNT(profit)", "Beneficios desconocidos": "COUNT(*) - COUNT(profit)", "Total de ventas": "SUM(sales)", "Total de cantidades": "SUM(quantity)", "Total de descuentos": "SUM(discount)", "Total de beneficios": "SUM(profit)"}
SQL["model_measures"] = q("model", "SELECT control, CAST(e AS DOUBLE) AS expected, CAST(o AS DOUBLE) AS obtained, CAST(o - e AS DOUBLE) AS difference, CASE WHEN e IS NOT DISTINCT FROM o THEN 'OK' ELSE 'REVISAR' END AS status FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS control, (SELECT CAST({e} AS DECIMAL(38,6)) FROM clean) AS e, (SELECT CAST({e} AS DECIMAL(38,6)) FROM order_details) AS o" for n, e in MC.items()) + ")")
