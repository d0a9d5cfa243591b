"""The layered analytical views, as builder functions over a Star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ventaria.functions.expressions import flag, mode_or_unknown, pct, ratio
from ventaria.functions.measures import LINE_PARTS, fold, line_rollup, order_rollup
from ventaria.operators.scalars import attach
from ventaria.sources.tpch import Star

PLACE = ["region", "country", "state", "city"]
PRODUCT = ["product_key", "product_id", "product_name", "category", "sub_category"]
CUSTOMER = ["customer_id", "customer_name", "segment"]
PARTY = ("customer_id", "order_date")


def sales_detail(star: Star) -> DataFrame:
    """One row per order line with every dimension resolved; the wide headers come last, so only lines and products move twice."""
    return (
        star.lines.join(star.products, "product_key").join(star.headers, "order_key")
        .select(
            F.col("source_row_id").alias("order_detail_key"), "source_row_id", "order_key", "order_id",
            "order_date", "ship_date", "shipping_days", "ship_mode", "customer_id", "customer_name",
            "segment", "country", "state", "city", "postal_code", "region", "product_key", "product_id",
            "product_name", "category", "sub_category", "sales", "quantity", "discount", "profit",
        )
    )


def facts(star: Star, header: tuple[str, ...] = (), product: tuple[str, ...] = ()) -> DataFrame:
    """Order lines joined only to the dimensions whose columns are asked for.

    Every line has its order and product (checked by the reference controls), so
    leaving a join out changes no row.
    """
    df = star.lines
    if header:
        df = df.join(star.headers.select("order_key", *header), "order_key")
    if product:
        df = df.join(star.products.select("product_key", *product), "product_key")
    return df


def order_summary(star: Star) -> DataFrame:
    """One row per order.

    Lines are folded by order before the header is joined, so the join moves
    one row per order, and it reuses the partitioning of the grouping.
    """
    wanted = ("total_order_lines", "total_sales", "total_quantity", "total_profit", "discount_sum",
              "discount_lines", "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines")
    parts = [p for p in LINE_PARTS if p[0] in wanted]
    folded = star.lines.groupBy("order_key").agg(
        *fold(parts), F.count_distinct("product_key").alias("distinct_products"))
    day = F.col("order_date")
    return folded.join(star.headers, "order_key").select(
        "order_key", "order_id", "order_date",
        F.year(day).alias("order_year"), F.month(day).alias("order_month"),
        F.date_format(day, "yyyy-MM").alias("order_year_month"),
        "ship_date", "shipping_days", "ship_mode", *CUSTOMER,
        "country", "state", "city", "postal_code", "region",
        "total_order_lines", "distinct_products", "total_sales", "total_quantity",
        ratio("discount_sum", "discount_lines").alias("average_line_discount"), "total_profit",
        "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines",
    )


def monthly_performance(orders: DataFrame) -> DataFrame:
    return order_rollup(orders, ["order_year", "order_month", "order_year_month"])


def sold_products(star: Star) -> DataFrame:
    """Products with at least one line; needs one column of the fact table."""
    return star.products.join(star.lines.select("product_key"), "product_key", "left_semi")


def subcategory_performance(star: Star) -> DataFrame:
    keys = ["category", "sub_category"]
    sold = sold_products(star).groupBy(*keys).agg(F.count(F.lit(1)).alias("distinct_products"))
    return line_rollup(facts(star, PARTY, tuple(keys)), keys).join(sold, keys)


def category_performance(star: Star) -> DataFrame:
    sold = (
        sold_products(star).groupBy("category", "sub_category").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("category").agg(F.sum("n").alias("distinct_products"),
                                 F.count(F.lit(1)).alias("distinct_subcategories"))
    )
    return line_rollup(facts(star, PARTY, ("category",)), ["category"]).join(sold, "category")


def product_performance(star: Star) -> DataFrame:
    """Folded by key; the texts of a product are attached to its one result row."""
    return line_rollup(facts(star, PARTY), ["product_key"]).join(star.products, "product_key")


def customer_performance(orders: DataFrame) -> DataFrame:
    place = ["country", "state", "city", "postal_code", "region"]
    return order_rollup(orders, CUSTOMER, {"distinct_locations": place})


def geographic_performance(orders: DataFrame) -> DataFrame:
    return order_rollup(orders, PLACE, {
        "distinct_postal_codes": ["postal_code"], "distinct_customers": ["customer_id"]})


def segment_performance(orders: DataFrame) -> DataFrame:
    return order_rollup(orders, ["segment"])


def ship_mode_performance(orders: DataFrame) -> DataFrame:
    """Grouped on the raw mode, so NULL and a literal 'Unknown' stay apart."""
    grouped = order_rollup(orders.withColumnRenamed("ship_mode", "raw_mode")
                           .withColumn("ship_mode", F.col("raw_mode")), ["raw_mode"])
    return grouped.select(
        "*", mode_or_unknown("raw_mode").alias("ship_mode"),
        flag(F.col("raw_mode").isNull()).alias("is_unknown_ship_mode"))


def dimension_sizes(star: Star) -> list[DataFrame]:
    one = F.count(F.lit(1))
    kinds = star.products.select("category", "sub_category").distinct()
    return [
        star.products.agg(one.alias("total_products")),
        kinds.agg(one.alias("total_subcategories"), F.count_distinct("category").alias("total_categories")),
        star.locations.agg(one.alias("total_locations")),
        star.regions.agg(one.alias("total_regions")),
    ]


def business_overview(star: Star, orders: DataFrame | None = None) -> DataFrame:
    orders = order_summary(star) if orders is None else orders
    total = order_rollup(orders, [], {"total_customers": ["customer_id"]})
    for size in dimension_sizes(star):
        total = attach(total, size)
    lines = F.col("total_order_lines")
    return total.select(
        "*",
        (F.date_diff("last_order_date", "first_order_date") + 1).alias("analysis_period_days"),
        ratio("total_orders", "total_customers").alias("average_orders_per_customer"),
        F.col("unknown_ship_mode_orders").alias("orders_with_unknown_ship_mode"),
        *[pct(lines - F.col(f"unknown_{m}_lines"), lines).alias(f"{m}_coverage_percentage")
          for m in ("sales", "quantity", "profit")],
    )
