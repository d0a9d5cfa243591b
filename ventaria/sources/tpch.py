"""Adapter: order-processing tables (Parquet) as a retail sales model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# The priority that stands for each shipping mode; the others are unknown.
SHIP_MODE_OF_PRIORITY = {
    "1-URGENT": "Same Day", "2-HIGH": "First Class",
    "3-MEDIUM": "Second Class", "5-LOW": "Standard Class",
}
CITIES_PER_COUNTRY = 12
STATES_PER_COUNTRY = 4


# Declared, never inferred: opening a table costs no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


@dataclass
class Star:
    """Facts and resolved dimensions every view is built from.

    lines    order_key, product_key, source_row_id, sales, quantity, discount, profit
    headers  one row per order with customer, place, dates and shipping mode
    products product_key, product_id, product_name, category, sub_category
    customers / regions: dimension rows, for counts only
    """

    lines: DataFrame
    headers: DataFrame
    products: DataFrame
    customers: DataFrame
    regions: DataFrame

    @property
    def locations(self) -> DataFrame:
        return self.headers.select("region", "country", "state", "city", "postal_code").distinct()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def read_star(spark: SparkSession, folder: str) -> Star:
    """Sales, profit and places by fixed rules over keys, so that unknown values,
    losses, reused codes and every shipping delay occur."""
    # Cents and percent as whole numbers: exact, and free of decimal parsing per row.
    whole = read_table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "bigint(l_extendedprice * 100 + 0.5D) AS cents",
        "bigint(l_discount * 100 + 0.5D) * 6 AS percent",
    )
    money = "CAST(CAST({} AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(15,6))"
    lines = whole.selectExpr(
        "l_orderkey AS order_key",
        "l_partkey AS product_key",
        "l_orderkey * 8 + l_linenumber AS source_row_id",
        f"if((l_orderkey + l_partkey) % 23 != 0, {money.format('cents * (100 - percent)')}, NULL) AS sales",
        "if((l_partkey + l_suppkey) % 29 != 0, CAST(l_quantity AS INT), NULL) AS quantity",
        "CAST(CAST(percent AS DECIMAL(4,0)) * 0.01 AS DECIMAL(4,2)) AS discount",
        f"if((l_orderkey + l_suppkey) % 19 != 0, {money.format('cents * (30 - percent)')}, NULL) AS profit",
    )

    modes = " ".join(f"WHEN '{key}' THEN '{mode}'" for key, mode in SHIP_MODE_OF_PRIORITY.items())
    region = read_table(spark, folder, "region")
    places = read_table(spark, folder, "nation").join(region, _on("n_regionkey", "r_regionkey"))
    customer = read_table(spark, folder, "customer")
    buyers = customer.join(places, _on("c_nationkey", "n_nationkey"))
    headers = (
        read_table(spark, folder, "orders").join(buyers, _on("o_custkey", "c_custkey"))
        .selectExpr("*", f"(c_custkey + o_orderkey) % {CITIES_PER_COUNTRY} AS bucket",
                    "CAST(o_orderdate AS DATE) AS order_date", "CAST(o_orderkey % 11 AS INT) AS shipping_days")
        .selectExpr(
            "o_orderkey AS order_key", "string(o_orderkey) AS order_id", "order_date",
            "date_add(order_date, shipping_days) AS ship_date", "shipping_days",
            f"CASE o_orderpriority {modes} END AS ship_mode",
            "string(c_custkey) AS customer_id", "c_name AS customer_name", "c_mktsegment AS segment",
            "n_name AS country", f"concat(n_name, '_S', bucket % {STATES_PER_COUNTRY}) AS state",
            "concat(n_name, '_C', bucket) AS city", "string(n_nationkey * 100 + bucket) AS postal_code",
            "r_name AS region",
        )
    )
    products = read_table(spark, folder, "part").selectExpr(
        "p_partkey AS product_key", "p_name AS product_id", "concat(p_name, ' #', p_partkey) AS product_name",
        "p_type AS category", "p_brand AS sub_category")
    return Star(lines, headers, products, customer.selectExpr("string(c_custkey) AS customer_id"),
                region.selectExpr("r_name AS region"))


def _on(left: str, right: str):
    return F.expr(f"{left} = {right}")
