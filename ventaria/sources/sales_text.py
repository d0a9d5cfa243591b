"""The raw sales extract: 21 text columns, read from CSV or derived from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ventaria.sources.quoted_lines import quoted_records
from ventaria.sources.tpch import CITIES_PER_COUNTRY, SHIP_MODE_OF_PRIORITY, STATES_PER_COUNTRY, _on, read_table

COLUMNS = (
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name", "segment",
    "country", "city", "state", "postal_code", "region", "product_id", "category", "sub_category",
    "product_name", "sales", "quantity", "discount", "profit",
)
SCHEMA = ", ".join(f"{c} STRING" for c in COLUMNS)
CORRUPT = "_corrupt_record"
_CSV = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}  # a surplus field is only seen if all fields are parsed


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False, header: bool = True) -> DataFrame:
    """CSV; every column stays text, broken records keep their text and are rejected by the load.

    ``multi_line`` is only for files with line breaks inside quotes: such files
    cannot be split, so one file is then read by one task (``read_quoted_csv`` reads them by many).
    """
    return (spark.read.options(**_CSV).option("multiLine", str(multi_line).lower()).option("header", str(header).lower())
            .schema(f"{SCHEMA}, {CORRUPT} STRING").csv(path))


def read_quoted_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The rows of ``read_raw_csv`` with ``multi_line``, but a large file is read by many tasks."""
    records = quoted_records(spark, path)
    if header:
        records = records.where("NOT (_block = 0 AND _at = 0)")
    options = {k: v for k, v in _CSV.items() if k not in ("header", "columnPruning")} | {"multiLine": "true"}
    return records.select(F.from_csv("record", f"{SCHEMA}, {CORRUPT} STRING", options).alias("r")).select("r.*")


def stream_raw_csv(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """The same reader over a folder that new files keep arriving in."""
    return (spark.readStream.options(**_CSV).option("maxFilesPerTrigger", files_per_batch)
            .schema(f"{SCHEMA}, {CORRUPT} STRING").csv(folder))


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """An untidy extract derived from the order tables by fixed key rules.

    Copies of rows, padding, blanks, five date formats, two unusable dates,
    spelling variants, missing and mixed shipping modes, missing measures, a
    mis-scaled discount, alias customer ids, reused product codes, one postal
    code with two cities, unreadable measures, a customer with two names and a
    product in two sub-categories all occur.
    """
    modes = " ".join(f"WHEN '{key}' THEN '{mode}'" for key, mode in SHIP_MODE_OF_PRIORITY.items())
    places = read_table(spark, folder, "nation").join(read_table(spark, folder, "region"), _on("n_regionkey", "r_regionkey"))
    buyers = read_table(spark, folder, "customer").join(places, _on("c_nationkey", "n_nationkey"))
    orders = read_table(spark, folder, "orders").join(buyers, _on("o_custkey", "c_custkey")).selectExpr(
        "o_orderkey AS o", "c_custkey AS c", "CAST(o_orderdate AS DATE) AS d", f"CASE o_orderpriority {modes} END AS m",
        "c_name", "n_name", "n_nationkey", "r_name")
    lines = read_table(spark, folder, "lineitem").join(read_table(spark, folder, "part"), _on("l_partkey", "p_partkey")).selectExpr(
        "l_orderkey", "p_partkey AS p", "l_linenumber AS n", "l_suppkey AS s", "CAST(l_quantity AS INT) AS q",
        "CAST(CAST(l_discount AS DECIMAL(4,2)) * 6 AS DECIMAL(4,2)) AS disc", "CAST(p_retailprice AS DECIMAL(15,2)) AS price", "p_name", "p_brand")
    # Joined by the text of the order's key: the rows then lie as all that groups or joins them by order needs them.
    # Only the number travels, the text is made on both sides.
    placed = "concat('OR-', {})"
    facts = lines.join(orders, _on(placed.format("l_orderkey"), placed.format("o"))).selectExpr(
        "*", f"{placed.format('l_orderkey')} AS order_id", f"(c + o) % {CITIES_PER_COUNTRY} AS b", "CAST(q * price * (1 - disc) AS DECIMAL(15,4)) AS net",
    ).selectExpr(
        "string((o * 8 + n) * 1000003 + p % 1000003) AS row_id",
        "order_id",
        """CASE WHEN o % 80 = 4 THEN 'Jan 4' WHEN o % 80 = 12 THEN '99.99.2023'
           WHEN o % 8 = 0 THEN concat(date_format(d, 'yyyy-MM-dd'), ' 00:00:00')
           WHEN o % 8 = 1 THEN date_format(d, 'dd-MMM-yyyy') WHEN o % 8 = 2 THEN date_format(d, 'dd.MM.yyyy')
           WHEN o % 8 = 3 THEN date_format(d, 'yyyyMMdd') ELSE date_format(d, 'yyyy-MM-dd') END AS order_date""",
        "date_format(date_add(d, if(o % 97 = 5, -2, CAST(o % 11 AS INT))), 'yyyy-MM-dd') AS ship_date",
        """CASE WHEN m IS NULL THEN '' WHEN (o + n) % 5 = 0 THEN NULL WHEN o % 31 = 7 AND n % 2 = 0 THEN 'Same Day'
           WHEN o % 13 = 3 THEN concat('  ', m, ' ') ELSE m END AS ship_mode""",
        "concat(if(o % 41 = 6, 'CX-', 'CU-'), c) AS customer_id",
        "concat(c_name, if(c % 173 = 7 AND o % 5 = 1, ' Jr', '')) AS customer_name",
        """CASE WHEN o % 211 = 9 THEN 'Retail'
           WHEN c % 3 = 0 THEN CASE o % 7 WHEN 1 THEN 'Counsumer' WHEN 2 THEN 'CONSUMR' WHEN 3 THEN 'consumer' ELSE 'Consumer' END
           WHEN c % 3 = 1 THEN CASE o % 7 WHEN 1 THEN 'corp.' WHEN 2 THEN 'Corperate' ELSE 'Corporate' END
           ELSE CASE o % 7 WHEN 1 THEN 'home-office' WHEN 2 THEN 'HomeOffice' ELSE 'Home Office' END END AS segment""",
        "n_name AS country",
        "concat(n_name, if(b = 3 AND o % 37 = 4, '_Old', '_C'), b) AS city",
        f"concat(n_name, '_S', b % {STATES_PER_COUNTRY}) AS state",
        "string(n_nationkey * 100 + b) AS postal_code",
        "r_name AS region",
        "concat('P-', if(p % 50 = 1, p - 1, p)) AS product_id",
        """concat(if(n = 3, ' ', ''), CASE p % 3 WHEN 0 THEN 'Furniture' WHEN 1 THEN 'Office Supplies' ELSE 'Technology' END,
           if(n = 3, '  ', '')) AS category""",
        "if(p % 211 = 5 AND n = 2, 'Brand#99', p_brand) AS sub_category",
        "concat(p_name, ' #', p) AS product_name",
        "CASE WHEN (o * 13 + n) % 509 = 7 THEN replace(string(net), '.', ',') WHEN (o + p) % 23 = 0 THEN NULL WHEN (o + p) % 46 = 1 THEN '   ' ELSE string(net) END AS sales",
        "if((o * 17 + n) % 509 = 9, 'two', if((p + s) % 29 = 0, NULL, concat(q, if(o % 3 = 0, '.0', '')))) AS quantity",
        "if(disc = 0.54 AND o % 4 = 0, '5.5', string(disc)) AS discount",
        "if((o * 19 + n) % 509 = 11, 'abc', if((o + s) % 19 = 0, NULL, string(CAST(net * CAST((p % 7 - 2) * 0.1 AS DECIMAL(3,1)) AS DECIMAL(15,5))))) AS profit",
        "explode(if((o * 7 + n) % 20 = 0, array(1, 2), array(1))) AS _copy",
    )
    return facts.select(*COLUMNS)
