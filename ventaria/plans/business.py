"""Business overview, annual and monthly reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ventaria.functions.expressions import growth, mean_of, mean_of_fine, month_name, pct
from ventaria.functions.measures import order_rollup
from ventaria.functions.present import present
from ventaria.operators.growth import with_previous
from ventaria.operators.ordering import small_ranks
from ventaria.operators.reconcile import compare_totals
from ventaria.plans.book import Book
from ventaria.plans.layouts import BUSINESS as LAYOUT


def executive_kpis(book: Book) -> DataFrame:
    return present(book.overview, LAYOUT["executive_kpis"])


def annual_performance(book: Book) -> DataFrame:
    years = with_previous(order_rollup(book.orders, ["order_year"]), ["order_year"], {
        "o": "total_orders", "c": "distinct_customers", "s": "total_sales", "p": "total_profit"})
    years = years.select(
        "*",
        growth("total_orders", "o").alias("year_over_year_order_growth_percentage"),
        growth("distinct_customers", "c").alias("year_over_year_customer_growth_percentage"),
        growth("total_sales", "s").alias("year_over_year_sales_growth_percentage"),
        (F.col("total_profit") - F.col("p")).alias("year_over_year_profit_change"),
    )
    return present(years.orderBy("order_year"), LAYOUT["annual_performance"])


def year_range(book: Book) -> DataFrame:
    return book.orders.agg(F.min("order_year").alias("first_year"), F.max("order_year").alias("last_year"),
                           F.count_distinct("order_year").alias("total_years"))


_TOTALS = ("total_order_lines", "total_sales", "total_quantity", "total_profit")


def annual_conservation(book: Book) -> DataFrame:
    one = F.count(F.lit(1)).alias("total_orders")
    sums = [F.sum(c).alias(c) for c in _TOTALS]
    whole = book.orders.agg(one, *sums)
    years = book.orders.groupBy("order_year").agg(one, *sums)
    return compare_totals(whole, years.agg(F.sum("total_orders").alias("total_orders"), *sums), {
        "total_orders": ("orders_summary", "orders_annual", "order_difference"),
        "total_order_lines": ("lines_summary", "lines_annual", "line_difference"),
        "total_sales": ("sales_summary", "sales_annual", "sales_difference"),
        "total_quantity": ("quantity_summary", "quantity_annual", "quantity_difference"),
        "total_profit": ("profit_summary", "profit_annual", "profit_difference"),
    })


def monthly_growth(book: Book) -> DataFrame:
    months = with_previous(book.months, ["order_year", "order_month"], {
        "o": "total_orders", "c": "distinct_customers", "s": "total_sales", "p": "total_profit"})
    months = months.select(
        "*",
        growth("total_orders", "o").alias("month_over_month_order_growth_percentage"),
        growth("distinct_customers", "c").alias("month_over_month_customer_growth_percentage"),
        growth("total_sales", "s").alias("month_over_month_sales_growth_percentage"),
        (F.col("total_profit") - F.col("p")).alias("month_over_month_profit_change"),
    )
    return present(months.orderBy("order_year", "order_month"), LAYOUT["monthly_growth"])


def month_range(book: Book) -> DataFrame:
    months = book.orders.select("order_year_month").distinct()
    return months.agg(F.min("order_year_month").alias("first_month"), F.max("order_year_month").alias("last_month"),
                      F.count(F.lit(1)).alias("total_months"))


def repeated_months(book: Book) -> DataFrame:
    """Must be empty: the monthly view has one row per month."""
    return (book.months.groupBy("order_year", "order_month").agg(F.count(F.lit(1)).alias("total_records"))
            .where("total_records > 1"))


def month_ranking(book: Book) -> DataFrame:
    ranked = small_ranks(book.months, {
        "sales_rank_best": "total_sales desc", "sales_rank_worst": "total_sales asc",
        "profit_rank_best": "total_profit desc", "profit_rank_worst": "total_profit asc",
        "order_rank_best": "total_orders desc", "order_rank_worst": "total_orders asc"})
    return present(ranked.orderBy("sales_rank_best", "order_year_month"), LAYOUT["month_ranking"])


def _months_by(book: Book, key, layout: str) -> DataFrame:
    return present(book.months.orderBy(key, "order_year_month").limit(5), LAYOUT[layout])


def top_months_by_sales(book: Book) -> DataFrame:
    return _months_by(book, F.desc("total_sales"), "top_months_by_sales")


def top_months_by_profit(book: Book) -> DataFrame:
    return _months_by(book, F.desc("total_profit"), "top_months_by_profit")


def bottom_months_by_profit(book: Book) -> DataFrame:
    return _months_by(book, F.asc("total_profit"), "bottom_months_by_profit")


def _by_calendar_month(months: DataFrame) -> DataFrame:
    lines = F.col("total_order_lines")
    known = lambda m: pct(lines - F.col(f"unknown_{m}_lines"), lines)
    return months.groupBy("order_month").agg(
        F.count(F.lit(1)).alias("observed_periods"),
        F.count_distinct("order_year").alias("observed_years"),
        mean_of("total_orders").alias("average_orders"),
        mean_of("distinct_customers").alias("average_distinct_customers"),
        mean_of("total_sales").alias("average_sales"),
        mean_of("total_quantity").alias("average_quantity"),
        mean_of("total_profit").alias("average_profit"),
        mean_of_fine("average_complete_order_value").alias("average_complete_order_value"),
        F.min("total_sales").alias("minimum_sales"), F.max("total_sales").alias("maximum_sales"),
        F.min("total_profit").alias("minimum_profit"), F.max("total_profit").alias("maximum_profit"),
        mean_of_fine(known("sales")).alias("average_sales_coverage_percentage"),
        mean_of_fine(known("profit")).alias("average_profit_coverage_percentage"),
    ).select("*", month_name("order_month").alias("month_name"))


def seasonality(book: Book) -> DataFrame:
    ranked = small_ranks(_by_calendar_month(book.months), {
        "average_sales_rank": "average_sales desc", "average_profit_rank": "average_profit desc",
        "average_orders_rank": "average_orders desc"})
    return present(ranked.orderBy("order_month"), LAYOUT["seasonality"])


def calendar_months(book: Book) -> DataFrame:
    return book.orders.agg(F.count_distinct("order_month").alias("distinct_months"),
                           F.min("order_month").alias("first_month"), F.max("order_month").alias("last_month"))


def seasonal_coverage(book: Book) -> DataFrame:
    return (book.orders.groupBy("order_month").agg(F.count_distinct("order_year").alias("observed_years"))
            .select("order_month", month_name("order_month").alias("month_name"), "observed_years")
            .orderBy("order_month"))


def months_by_average_sales(book: Book) -> DataFrame:
    months = _by_calendar_month(book.months)
    return present(months.orderBy(F.desc("average_sales"), "order_month"), LAYOUT["months_by_average_sales"])


REPORTS = {f.__name__: f for f in (
    executive_kpis, annual_performance, year_range, annual_conservation, monthly_growth, month_range,
    repeated_months, month_ranking, top_months_by_sales, top_months_by_profit, bottom_months_by_profit,
    seasonality, calendar_months, seasonal_coverage, months_by_average_sales)}
