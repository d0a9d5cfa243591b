"""Parameterised period reports.

A missing bound means the first or last date of the data; it stays a lazy
subquery.  Invalid arguments raise ValueError before any report is built.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import mode_or_unknown, pct
from ventaria.functions.measures import line_rollup, order_rollup
from ventaria.functions.present import present
from ventaria.operators.ordering import dense_ranks, first_rows, small_ranks, small_share
from ventaria.operators.scalars import attach, scalar_fields
from ventaria.operators.selection import ranks_of
from ventaria.plans.book import Book, narrow
from ventaria.plans.category import _products_per
from ventaria.plans.layouts import PERIOD as LAYOUT
from ventaria.plans.logistics import by_mode
from ventaria.plans.views import CUSTOMER, PARTY, PLACE
from ventaria.session import settle

DEFAULT_TOP, LARGEST_TOP = 20, 1000  # fixed values
Day = dt.date | str | None


def _day(value: Day) -> dt.date | None:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


class Period:
    """Bounds as columns plus the filter on the order date."""

    def __init__(self, book: Book, start: Day, end: Day):
        first, last = _day(start), _day(end)
        headers = book.star.headers.join(book.star.lines.select("order_key"), "order_key", "left_semi")
        if (first is None) != (last is None):  # one bound given: compare it with the data
            edge = F.max("order_date") if first else F.min("order_date")
            known = headers.agg(edge.alias("d")).first()["d"]
            if known is not None and ((first and first > known) or (last and last < known)):
                raise ValueError("the start date must not be after the end date")
        if first and last and first > last:
            raise ValueError("the start date must not be after the end date")
        open_end = None
        if first is None or last is None:
            open_end = scalar_fields(headers.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")))
        self.start: Column = F.lit(first) if first else open_end["lo"]
        self.end: Column = F.lit(last) if last else open_end["hi"]
        self._tests = ([F.col("order_date") >= F.lit(first)] if first else []) + ([F.col("order_date") <= F.lit(last)] if last else [])

    def within(self, df: DataFrame) -> DataFrame:
        """An open bound filters nothing, so no predicate is added for it."""
        for test in self._tests:
            df = df.where(test)
        return df

    def stamp(self, df: DataFrame) -> DataFrame:
        return df.select("*", self.start.alias("requested_start_date"), self.end.alias("requested_end_date"))


def _require(df: DataFrame, test: Column, message: str) -> None:
    if df.where(test).isEmpty():
        raise ValueError(message)


def _top(n: int | None) -> int:
    n = DEFAULT_TOP if n is None else n
    if not 0 < n <= LARGEST_TOP:
        raise ValueError(f"the number of rows must be between 1 and {LARGEST_TOP}")
    return n


def _observed(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("first_order_date").alias("first_observed_order_date"),
                     F.col("last_order_date").alias("last_observed_order_date"))


def period_sales_summary(book: Book, start: Day = None, end: Day = None) -> DataFrame:
    period = Period(book, start, end)
    df = _observed(period.stamp(order_rollup(period.within(book.orders), [])))
    df = df.select("*", F.col("unknown_ship_mode_orders").alias("orders_with_unknown_ship_mode"))
    return present(df, LAYOUT["period_sales_summary"])


def period_category_performance(book: Book, category: str | None = None, start: Day = None, end: Day = None) -> DataFrame:
    period = Period(book, start, end)
    detail = period.within(book.facts(PARTY, ("category", "sub_category")))
    if category is not None:
        test = F.col("category") == category
        _require(book.star.products, test, f"unknown category: {category}")
        detail = detail.where(test)
    keys = ["category", "sub_category"]
    df = line_rollup(detail, keys).join(_products_per(detail, keys), keys)
    df = _observed(period.stamp(df)).orderBy("category", F.desc("total_sales"), "sub_category")
    return present(df, LAYOUT["period_category_performance"])


def period_top_products(book: Book, start: Day = None, end: Day = None, n: int | None = None) -> DataFrame:
    n = _top(n)
    period = Period(book, start, end)
    df = line_rollup(period.within(book.facts(PARTY)), ["product_key"])
    df = settle(narrow(df, "product_key", "total_orders", "distinct_customers", "total_order_lines", "total_sales", "total_quantity",
                "total_profit", "average_line_discount", "comparable_profit_margin_percentage", "loss_making_lines",
                "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines"))
    top = settle(first_rows(df, "total_sales desc, total_profit desc, product_key", n, "sales_position"))
    df = ranks_of(top, df, "product_key", {
        "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc"}, n)
    df = df.join(book.star.products, "product_key")
    df = df.select("*", (F.col("profit_rank") - F.col("sales_position")).alias("sales_profit_rank_gap"))
    return present(period.stamp(df).orderBy("sales_position"), LAYOUT["period_top_products"])


def period_top_customers(book: Book, start: Day = None, end: Day = None, n: int | None = None) -> DataFrame:
    n = _top(n)
    period = Period(book, start, end)
    df = order_rollup(period.within(book.orders), CUSTOMER, {"active_months": ["order_year_month"], "active_years": ["order_year"]})
    df = settle(narrow(df, *CUSTOMER, "total_orders", "first_order_date", "last_order_date", "purchase_span_days", "active_months",
                       "active_years", "total_order_lines", "total_product_references", "total_sales", "total_quantity",
                       "total_profit", "average_complete_order_value", "comparable_profit_margin_percentage",
                       "average_shipping_days", "complete_loss_making_orders", "orders_with_unknown_profit",
                       "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines"))
    wanted = {"profit_rank": "total_profit desc", "order_frequency_rank": "total_orders desc",
              "average_order_value_rank": "average_complete_order_value desc", "margin_rank": "comparable_profit_margin_percentage desc"}
    top = settle(first_rows(df, "total_sales desc, total_profit desc, customer_id", n, "sales_position"))
    top = attach(ranks_of(top, df, "customer_id", wanted, n), df.agg(F.sum("total_sales").alias("_all")))
    df = top.select("*", pct("total_sales", "_all").alias("sales_share_percentage"))
    df = df.select("*", (F.col("profit_rank") - F.col("sales_position")).alias("sales_profit_rank_gap"))
    return present(period.stamp(df).orderBy("sales_position"), LAYOUT["period_top_customers"])


def period_geographic_performance(book: Book, country: str | None = None, region: str | None = None,
                                  start: Day = None, end: Day = None) -> DataFrame:
    period = Period(book, start, end)
    orders = period.within(book.orders)
    for name, value in (("country", country), ("region", region)):
        if value is not None:
            test = F.col(name) == value
            _require(book.star.headers, test, f"unknown {name}: {value}")
            orders = orders.where(test)
    df = order_rollup(orders, PLACE)
    df = settle(narrow(df, *PLACE, "total_orders", "distinct_customers", "total_order_lines", "total_sales", "total_quantity",
                       "total_profit", "average_complete_order_value", "comparable_profit_margin_percentage",
                       "average_shipping_days", "minimum_shipping_days", "maximum_shipping_days", "shipping_days_stddev",
                       "two_day_or_less_orders", "eight_plus_day_orders", "complete_loss_making_orders",
                       "orders_with_unknown_profit", "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines"))
    df = attach(df, df.agg(F.sum("total_sales").alias("_all")))
    df = df.select("*", pct("total_sales", "_all").alias("sales_share_percentage"))
    df = dense_ranks(df, "country, state, city, region", {
        "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc",
        "regional_sales_rank": "total_sales desc", "sales_rank": "total_sales desc"}, {"regional_sales_rank": ("region",)})
    df = df.select("*", (F.col("profit_rank") - F.col("sales_rank")).alias("sales_profit_rank_gap"))
    return present(period.stamp(df).orderBy("sales_rank", "country", "state", "city"), LAYOUT["period_geographic_performance"])


def period_logistics_performance(book: Book, ship_mode: str | None = None, start: Day = None, end: Day = None) -> DataFrame:
    period = Period(book, start, end)
    orders = period.within(book.orders)
    if ship_mode is not None:
        test = mode_or_unknown() == ship_mode
        _require(book.star.headers, test, f"unknown ship mode: {ship_mode}")
        orders = orders.where(test)
    df = small_share(by_mode(orders), {"order_share_percentage": "total_orders"})
    df = small_ranks(df, {"shipping_speed_rank": "average_shipping_days asc", "usage_rank": "total_orders desc",
                          "sales_rank": "total_sales desc", "profit_rank": "total_profit desc"})
    df = df.select("*", (F.col("profit_rank") - F.col("sales_rank")).alias("sales_profit_rank_gap"))
    df = _observed(period.stamp(df)).orderBy("is_unknown_ship_mode", "usage_rank", "ship_mode")
    return present(df, LAYOUT["period_logistics_performance"])


def _year(book_report, **arguments):
    return lambda book: book_report(book, **arguments)


REPORTS = {
    "period_sales_summary": period_sales_summary,
    "period_sales_summary_1997": _year(period_sales_summary, start="1997-01-01", end="1997-12-31"),
    "period_category_performance": period_category_performance,
    "period_category_performance_economy": _year(period_category_performance, category="ECONOMY", start="1997-01-01", end="1998-06-30"),
    "period_top_products": period_top_products,
    "period_top_products_1998": _year(period_top_products, start="1998-01-01", end="1998-12-31", n=50),
    "period_top_customers": period_top_customers,
    "period_top_customers_1998": _year(period_top_customers, start="1998-01-01", end="1998-12-31", n=50),
    "period_geographic_performance": period_geographic_performance,
    "period_geographic_performance_asia": _year(period_geographic_performance, region="ASIA", start="1997-01-01"),
    "period_logistics_performance": period_logistics_performance,
    "period_logistics_performance_unknown": _year(period_logistics_performance, ship_mode="Unknown", end="1999-12-31"),
}
