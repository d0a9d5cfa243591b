"""Default display of every view, and the conservation checks between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ventaria.functions.present import present
from ventaria.operators.reconcile import doubles, stack_controls
from ventaria.operators.scalars import attach
from ventaria.plans import views
from ventaria.plans.book import Book

# name -> (view, sort keys, columns)
_TOP = {
    "display_sales_detail": (lambda b: b.detail, ["source_row_id", "product_key", "order_key"],
        "source_row_id order_id order_date customer_name city product_name category sales quantity discount profit"),
    "display_order_summary": (lambda b: b.orders, ["order_date", "order_key"],
        "order_key order_id order_date customer_name city total_order_lines distinct_products total_sales total_quantity average_line_discount:4 total_profit"),
    "display_monthly_performance": (lambda b: b.months, ["order_year", "order_month"],
        "order_year_month total_orders distinct_customers total_sales total_quantity total_profit average_complete_order_value profit_margin_percentage orders_with_unknown_sales orders_with_unknown_profit"),
    "display_subcategory_performance": (lambda b: b.subcategories, ["-total_sales", "sub_category", "category"],
        "category sub_category total_orders distinct_products total_sales total_quantity total_profit comparable_profit_margin_percentage loss_making_lines unknown_sales_lines unknown_profit_lines"),
    "display_customer_performance": (lambda b: b.customers, ["-total_sales", "customer_name", "customer_id"],
        "customer_id customer_name segment total_orders first_order_date last_order_date purchase_span_days distinct_locations total_sales total_profit average_complete_order_value comparable_profit_margin_percentage complete_loss_making_orders orders_with_unknown_sales"),
    "display_geographic_performance": (lambda b: b.cities, ["-total_sales", "country", "state", "city"],
        "region country state city distinct_postal_codes total_orders distinct_customers total_sales total_profit average_complete_order_value comparable_profit_margin_percentage average_shipping_days complete_loss_making_orders"),
    "display_product_performance": (lambda b: b.products, ["-total_sales", "product_name", "product_key"],
        "product_key product_id product_name category sub_category total_orders distinct_customers total_sales total_quantity total_profit comparable_average_unit_sales comparable_profit_margin_percentage loss_making_lines unknown_sales_lines unknown_profit_lines"),
    "display_segment_performance": (lambda b: views.segment_performance(b.orders), ["-total_sales"],
        "segment distinct_customers total_orders total_order_lines total_sales total_quantity total_profit average_complete_order_value average_complete_order_profit comparable_profit_margin_percentage average_shipping_days complete_loss_making_orders orders_with_unknown_sales orders_with_unknown_profit"),
    "display_ship_mode_performance": (lambda b: views.ship_mode_performance(b.orders), ["is_unknown_ship_mode", "-total_orders"],
        "ship_mode is_unknown_ship_mode total_orders distinct_customers total_order_lines total_sales total_quantity total_profit average_complete_order_value comparable_profit_margin_percentage average_shipping_days minimum_shipping_days maximum_shipping_days complete_loss_making_orders orders_with_unknown_sales orders_with_unknown_profit"),
    "display_category_performance": (lambda b: b.categories, ["-total_sales"],
        "category distinct_subcategories distinct_products distinct_customers total_orders total_order_lines total_sales total_quantity total_profit average_line_discount comparable_profit_margin_percentage loss_making_lines unknown_sales_lines unknown_profit_lines"),
    "display_business_overview": (lambda b: b.overview, [],
        "first_order_date last_order_date analysis_period_days total_orders total_customers total_products total_locations total_sales total_quantity total_profit average_complete_order_value average_complete_order_profit comparable_profit_margin_percentage average_orders_per_customer average_shipping_days sales_coverage_percentage quantity_coverage_percentage profit_coverage_percentage complete_loss_making_orders orders_with_unknown_sales orders_with_unknown_profit orders_with_unknown_ship_mode"),
}
DISPLAYS = {name: layout for name, (_, _, layout) in _TOP.items()}


def _display(name: str):
    view, keys, layout = _TOP[name]

    def report(book: Book, n: int | None = None) -> DataFrame:
        """The whole view in its order, or its first ``n`` rows where a caller asks for them."""
        df = view(book)
        if keys:
            df = df.orderBy(*[F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys])
        return present(df if n is None else df.limit(n), layout)
    return report


def view_conservation(book: Book) -> DataFrame:
    """Lines, sales, quantity and profit of every view against the order lines."""
    measures = ("total_order_lines", "total_sales", "total_quantity", "total_profit")
    lines = book.star.lines.agg(F.count(F.lit(1)).alias("p_total_order_lines"), F.sum("sales").alias("p_total_sales"),
                                F.sum("quantity").alias("p_total_quantity"), F.sum("profit").alias("p_total_profit"))
    shown = {"order_summary": book.orders, "monthly_performance": book.months, "subcategory_performance": book.subcategories,
             "customer_performance": book.customers, "geographic_performance": book.cities, "product_performance": book.products,
             "segment_performance": views.segment_performance(book.orders), "ship_mode_performance": views.ship_mode_performance(book.orders),
             "category_performance": book.categories}
    rows = [df.agg(F.count(F.lit(1)).alias("view_rows"), *[F.sum(m).alias(m) for m in measures]).select(F.lit(name).alias("view_name"), "*")
            for name, df in shown.items()]
    both = attach(stack_controls(rows), lines)
    return doubles(both.select("view_name", "view_rows", *measures, *[(F.col(m) - F.col(f"p_{m}")).alias(f"{m}_difference") for m in measures]))


def view_uniqueness(book: Book) -> DataFrame:
    """Rows and distinct keys per view; duplicates must be zero."""
    keys = {"order_summary": (book.orders, ["order_key"]), "monthly_performance": (book.months, ["order_year", "order_month"]),
            "customer_performance": (book.customers, ["customer_id"]), "geographic_performance": (book.cities, views.PLACE),
            "product_performance": (book.products, ["product_key"]), "sales_detail": (book.detail, ["source_row_id", "order_key", "product_key"]),
            "subcategory_performance": (book.subcategories, ["category", "sub_category"]),
            "segment_performance": (views.segment_performance(book.orders), ["segment"]),
            "ship_mode_performance": (views.ship_mode_performance(book.orders), ["ship_mode"]),
            "category_performance": (book.categories, ["category"])}
    rows = []
    for name, (df, key) in keys.items():
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        rows.append(per_key.agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("unique_keys")).select(F.lit(name).alias("view_name"), "*"))
    return stack_controls(rows).select("*", (F.col("total_rows") - F.col("unique_keys")).alias("duplicates"))


def view_missing_members(book: Book) -> DataFrame:
    """Model members that no view row shows: customers, products and orders without lines."""
    tests = {"customers": book.star.customers.join(book.orders.select("customer_id"), "customer_id", "left_anti"),
             "products": book.star.products.join(book.star.lines.select("product_key"), "product_key", "left_anti"),
             "orders": book.star.headers.join(book.star.lines.select("order_key"), "order_key", "left_anti")}
    return stack_controls([df.agg(F.count(F.lit(1)).alias("missing")).select(F.lit(n).alias("entity"), "missing") for n, df in tests.items()])


def line_conservation(book: Book) -> DataFrame:
    """The line view has every model line once."""
    both = attach(book.star.lines.agg(F.count(F.lit(1)).alias("model_rows")), book.detail.agg(F.count(F.lit(1)).alias("view_rows")))
    return both.select("*", (F.col("view_rows") - F.col("model_rows")).alias("difference"))


REPORTS = {**{name: _display(name) for name in _TOP},
           **{f.__name__: f for f in (view_conservation, view_uniqueness, view_missing_members, line_conservation)}}
