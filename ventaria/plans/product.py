"""Product reports; ranks and running totals are distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ventaria.functions.expressions import pct, rounded
from ventaria.functions.measures import line_rollup
from ventaria.functions.present import present
from ventaria.operators.concentration import abc_class, cumulate, milestones
from ventaria.operators.ordering import dense_ranks, small_share
from ventaria.operators.quadrant import against_mean, profile_order, quadrant_label
from ventaria.operators.reconcile import count_against, share_total, uniqueness
from ventaria.operators.scalars import attach
from ventaria.plans.book import Book, narrow
from ventaria.plans.category import growth_with_falling_margin, high_sales_low_margin, loss_risk, yearly
from ventaria.plans.layouts import PRODUCT as LAYOUT
from ventaria.plans.views import PARTY, PRODUCT, sold_products
from ventaria.session import settle

_DISPLAY = ["total_orders", "total_order_lines", "distinct_customers", "total_sales", "total_quantity", "total_profit",
            "average_line_discount", "comparable_profit_margin_percentage", "loss_making_lines",
            "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines"]


def _plain(book: Book) -> DataFrame:
    """Product measures without texts and counts: one grouping of the lines alone."""
    return line_rollup(book.star.lines, ["product_key"], parties=False)


def product_ranking(book: Book) -> DataFrame:
    df = settle(narrow(book.products, *PRODUCT, "first_order_date", "last_order_date",
                       "comparable_average_unit_sales", *_DISPLAY))
    df = attach(df, df.agg(F.sum("total_sales").alias("_all")))
    df = df.select("*", pct("total_sales", "_all").alias("global_sales_share_percentage"))
    df = dense_ranks(df, "product_key", {
        "global_profit_rank": "total_profit desc",
        "global_margin_rank": "comparable_profit_margin_percentage desc",
        "subcategory_sales_rank": "total_sales desc",
        "global_sales_rank": "total_sales desc",
    }, {"subcategory_sales_rank": ("category", "sub_category")})
    df = df.select("*", (F.col("global_profit_rank") - F.col("global_sales_rank")).alias("sales_profit_rank_gap"))
    return present(df.orderBy("global_sales_rank", "product_name", "product_key"), LAYOUT["product_ranking"])


def top_products_by_sales(book: Book) -> DataFrame:
    df = book.products.orderBy(F.desc("total_sales"), "product_name", "product_key").limit(20)
    return present(df, LAYOUT["top_products_by_sales"])


def top_products_by_profit(book: Book) -> DataFrame:
    df = book.products.orderBy(F.desc("total_profit"), "product_name", "product_key").limit(20)
    return present(df, LAYOUT["top_products_by_profit"])


def product_count_check(book: Book) -> DataFrame:
    return count_against(book.star.products, sold_products(book.star),
                         ("products_model", "products_analysed", "difference"))


def product_uniqueness(book: Book) -> DataFrame:
    return uniqueness(_plain(book), ["product_key"], "total_products", "unique_product_keys", "duplicates")


def product_quadrant(book: Book) -> DataFrame:
    df = against_mean(narrow(book.products, *PRODUCT, *_DISPLAY))
    df = df.select("*", quadrant_label("volumen", unknown_sales=True).alias("performance_profile"),
                   loss_risk().alias("profitability_status"))
    order = [profile_order("performance_profile", "volumen"), F.desc("total_sales"), "product_name", "product_key"]
    return present(df.orderBy(*order), LAYOUT["product_quadrant"])


def product_high_volume_low_margin(book: Book) -> DataFrame:
    df = against_mean(narrow(book.products, *PRODUCT, *_DISPLAY)).where(high_sales_low_margin())
    order = [F.desc("total_sales"), "comparable_profit_margin_percentage", "product_name"]
    return present(df.orderBy(*order), LAYOUT["product_high_volume_low_margin"])


def product_negative_profit(book: Book) -> DataFrame:
    df = book.products.where("total_profit < 0")
    return present(df.orderBy("total_profit", F.desc("total_sales"), "product_name"), LAYOUT["product_negative_profit"])


def product_quadrant_distribution(book: Book) -> DataFrame:
    slim = _plain(book).select("product_key", "total_sales", "comparable_profit_margin_percentage")
    df = against_mean(slim).select(quadrant_label("volumen", unknown_sales=True).alias("performance_profile"))
    return (df.groupBy("performance_profile").agg(F.count(F.lit(1)).alias("total_products"))
            .orderBy(F.desc("total_products"), "performance_profile"))


def _pareto(df: DataFrame) -> DataFrame:
    df = cumulate(df, "total_sales", "product_key", position="sales_position", share="sales_share_percentage",
                  cumulative="cumulative_sales_percentage", running="cumulative_sales")
    return df.select("*", abc_class(F.col("cumulative_sales_percentage")).alias("abc_classification"))


def product_pareto(book: Book) -> DataFrame:
    df = _pareto(narrow(book.products, *PRODUCT, *_DISPLAY))
    return present(df.orderBy("sales_position"), LAYOUT["product_pareto"])


def product_milestones(book: Book) -> DataFrame:
    df = _pareto(_plain(book).select("product_key", "total_sales"))
    return df.agg(*milestones(df, "cumulative_sales_percentage", "sales_position",
                              [f"products_for_{m}_percent" for m in (50, 80, 95)]))


def product_abc_distribution(book: Book) -> DataFrame:
    df = _pareto(_plain(book).select("product_key", "total_sales"))
    df = df.groupBy("abc_classification").agg(F.count(F.lit(1)).alias("total_products"), F.sum("total_sales").alias("total_sales"))
    df = small_share(df, {"product_percentage": "total_products", "sales_percentage": "total_sales"})
    return present(df.orderBy("abc_classification"),
                   "abc_classification total_products product_percentage total_sales sales_percentage")


def product_share_total(book: Book) -> DataFrame:
    return share_total(_plain(book), line_rollup(book.star.lines, [], parties=False),
                       {"total_sales": "total_sales_share_percentage"})


def _reused(book: Book) -> DataFrame:
    """Source codes carried by more than one product."""
    return (book.star.products.groupBy("product_id").agg(F.count(F.lit(1)).alias("associated_products"))
            .where("associated_products > 1"))


def product_reused_codes(book: Book) -> DataFrame:
    products = narrow(book.products, *PRODUCT, *_DISPLAY)
    df = settle(products.join(_reused(book), "product_id"))
    totals = df.groupBy("product_id").agg(F.sum("total_sales").alias("_code_sales"))
    df = df.join(totals, "product_id")
    df = df.select("*", pct("total_sales", "_code_sales").alias("source_id_sales_share_percentage"))
    df = dense_ranks(df, "product_key", {"sales_rank_within_source_id": "total_sales desc"},
                     {"sales_rank_within_source_id": ("product_id",)})
    order = ["product_id", "sales_rank_within_source_id", "product_key"]
    return present(df.orderBy(*order), LAYOUT["product_reused_codes"])


def product_reuse_summary(book: Book) -> DataFrame:
    n = F.col("associated_products")
    df = _reused(book).agg(
        F.count(F.lit(1)).alias("reused_product_ids"), F.sum(n).alias("products_with_reused_ids"),
        F.min(n).alias("minimum_products_per_id"), F.max(n).alias("maximum_products_per_id"),
        (F.sum(n).cast("double") / F.count(n)).alias("average_products_per_id"))
    return present(df, " ".join(df.columns))


def product_reuse_impact(book: Book) -> DataFrame:
    codes = _reused(book).select("product_id")
    lines = book.star.lines.join(book.star.products.select("product_key", "product_id"), "product_key")
    sums = lambda p: [F.sum("sales").alias(f"{p}_sales"), F.sum("profit").alias(f"{p}_profit"),
                      F.count(F.lit(1)).alias(f"{p}_lines")]
    df = attach(lines.join(codes, "product_id", "left_semi").agg(*sums("reused")), lines.agg(*sums("all")))
    return df.select(
        rounded("reused_sales").alias("reused_product_sales"),
        rounded(pct("reused_sales", "all_sales")).alias("reused_product_sales_percentage"),
        rounded("reused_profit").alias("reused_product_profit"),
        F.col("reused_lines").alias("reused_order_lines"),
        rounded(pct("reused_lines", "all_lines")).alias("reused_product_line_percentage"))


def product_yearly(book: Book) -> DataFrame:
    df = yearly(book.facts(PARTY), ["product_key"], products=False).join(book.star.products, "product_key")
    return present(df.orderBy("product_key", "order_year"), LAYOUT["product_yearly"])


def _yearly_change(book: Book) -> DataFrame:
    df = yearly(book.facts(("order_date",)), ["product_key"], products=False, parties=False)
    return df.select("*", F.col("total_sales").alias("current_year_sales"), F.col("total_profit").alias("current_year_profit"),
                     F.col("comparable_profit_margin_percentage").alias("current_year_margin"),
                     F.col("year_over_year_sales_growth_percentage").alias("sales_growth_percentage"),
                     F.col("year_over_year_profit_change").alias("profit_change"),
                     F.col("year_over_year_margin_change_points").alias("margin_change_points"))


def product_growth_margin_drop(book: Book) -> DataFrame:
    df = _yearly_change(book).where(growth_with_falling_margin()).join(book.star.products, "product_key")
    order = ["margin_change_points", F.desc("sales_growth_percentage"), "product_name"]
    return present(df.orderBy(*order), LAYOUT["product_growth_margin_drop"])


def product_profit_flip(book: Book) -> DataFrame:
    df = _yearly_change(book).where("previous_year_profit > 0 AND total_profit < 0").join(book.star.products, "product_key")
    return present(df.orderBy("profit_change", "product_name"), LAYOUT["product_profit_flip"])


def product_observed_years(book: Book) -> DataFrame:
    seen = (book.star.lines.join(book.star.headers.select("order_key", "order_date"), "order_key")
            .select("product_key", F.year("order_date").alias("y")).distinct())
    return (seen.groupBy("product_key").agg(F.count(F.lit(1)).alias("observed_years"))
            .groupBy("observed_years").agg(F.count(F.lit(1)).alias("total_products")).orderBy("observed_years"))


REPORTS = {f.__name__: f for f in (
    product_ranking, top_products_by_sales, top_products_by_profit, product_count_check, product_uniqueness,
    product_quadrant, product_high_volume_low_margin, product_negative_profit, product_quadrant_distribution,
    product_pareto, product_milestones, product_abc_distribution, product_share_total, product_reused_codes,
    product_reuse_summary, product_reuse_impact, product_yearly, product_growth_margin_drop, product_profit_flip,
    product_observed_years)}
