"""Category and sub-category reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import discount_band, flag, growth, mean_of, pct
from ventaria.functions.measures import line_rollup
from ventaria.functions.present import derive, present
from ventaria.operators.concentration import abc_class, cumulate, milestones
from ventaria.operators.growth import with_previous
from ventaria.operators.ordering import small_ranks, small_share
from ventaria.operators.quadrant import against_mean, profile_order, quadrant_label
from ventaria.operators.reconcile import count_against, share_total
from ventaria.plans import views
from ventaria.plans.book import Book, narrow
from ventaria.plans.layouts import CATEGORY as LAYOUT
from ventaria.plans.views import PARTY

SUB = ["category", "sub_category"]
# Published labels.
ABOVE, BELOW, EVEN = ("Rentabilidad superior al volumen", "Rentabilidad inferior al volumen",
                      "Rentabilidad alineada con ventas")
RISKS = ("Beneficio acumulado negativo", "Margen comparable negativo",
         "Presenta líneas con pérdidas", "Sin pérdidas conocidas")


def _with_year(detail: DataFrame) -> DataFrame:
    return detail.withColumn("order_year", F.year("order_date"))


def category_comparison(book: Book) -> DataFrame:
    df = small_share(book.categories, {
        "sales_share_percentage": "total_sales", "quantity_share_percentage": "total_quantity",
        "order_line_share_percentage": "total_order_lines"})
    df = small_ranks(df, {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc",
                          "margin_rank": "comparable_profit_margin_percentage desc"})
    return present(df.orderBy("sales_rank", "category"), LAYOUT["category_comparison"])


def category_share_totals(book: Book) -> DataFrame:
    categories = book.totals("category")
    whole = line_rollup(book.star.lines, [], parties=False)
    return share_total(categories, whole, {
        "total_sales": "sales_share_total", "total_quantity": "quantity_share_total",
        "total_order_lines": "order_line_share_total"})


def category_rank_gap(book: Book) -> DataFrame:
    df = small_ranks(book.categories, {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc",
                                       "margin_rank": "comparable_profit_margin_percentage desc"})
    gap = F.col("profit_rank") - F.col("sales_rank")
    df = df.select("*", gap.alias("sales_profit_rank_gap"),
                   F.when(gap < 0, ABOVE).when(gap > 0, BELOW).otherwise(EVEN).alias("profitability_vs_sales"))
    return present(df.orderBy("sales_rank", "category"), LAYOUT["category_rank_gap"])


def category_by_margin(book: Book) -> DataFrame:
    df = book.categories.orderBy(F.desc("comparable_profit_margin_percentage"), F.desc("total_profit"))
    return present(df, LAYOUT["category_by_margin"])


def category_discount_bands(book: Book) -> DataFrame:
    label, place = discount_band("discount")
    detail = book.facts(PARTY, ("category",)).select("*", label.alias("discount_range"), place.alias("discount_order"))
    df = line_rollup(detail, ["category", "discount_range", "discount_order"])
    return present(df.orderBy("category", "discount_order"), LAYOUT["category_discount_bands"])


def category_loss_discounts(book: Book) -> DataFrame:
    df = book.facts(product=("category",)).groupBy("category", "discount").agg(
        F.count(F.lit(1)).alias("total_order_lines"), F.sum("sales").alias("total_sales"),
        F.sum("profit").alias("total_profit"), mean_of("profit").alias("average_known_profit"),
        F.sum(flag(F.col("profit") < 0)).alias("loss_making_lines"))
    return present(df.where("total_profit < 0").orderBy("category", "discount"), LAYOUT["category_loss_discounts"])


def _products_per(detail: DataFrame, keys: list[str]) -> DataFrame:
    pairs = detail.select(*keys, "product_key").distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("distinct_products"))


def yearly(detail: DataFrame, entity: list[str], products: bool, parties: bool = True) -> DataFrame:
    """Entity x year with the values of the previous available year."""
    keys = [*entity, "order_year"]
    dated = _with_year(detail)
    df = line_rollup(dated, keys, parties)
    if products:
        df = df.join(_products_per(dated, keys), keys)
    previous = {"previous_year_sales": "total_sales", "previous_year_profit": "total_profit",
                "previous_year_margin": "comparable_profit_margin_percentage"}
    if parties:
        previous["previous_year_orders"] = "total_orders"
    df = with_previous(df, ["order_year"], previous, tuple(entity))
    c = F.col
    out = [
        growth("total_sales", "previous_year_sales").alias("year_over_year_sales_growth_percentage"),
        (c("total_profit") - c("previous_year_profit")).alias("year_over_year_profit_change"),
        (c("comparable_profit_margin_percentage") - c("previous_year_margin")).alias("year_over_year_margin_change_points"),
    ]
    if parties:
        out.append(growth("total_orders", "previous_year_orders").alias("year_over_year_order_growth_percentage"))
    return df.select("*", *out)


def growth_with_falling_margin() -> Column:
    return (F.col("total_sales") > F.col("previous_year_sales")) & (
        F.col("comparable_profit_margin_percentage") < F.col("previous_year_margin"))


def category_yearly(book: Book) -> DataFrame:
    df = yearly(book.facts(PARTY, ("category",)), ["category"], products=True)
    return present(df.orderBy("category", "order_year"), LAYOUT["category_yearly"])


def _year_coverage(book: Book, keys: list[str]) -> DataFrame:
    seen = _with_year(book.facts(("order_date",), tuple(keys))).select(*keys, "order_year").distinct()
    return seen.groupBy(*keys).agg(F.min("order_year").alias("first_year"), F.max("order_year").alias("last_year"),
                                   F.count(F.lit(1)).alias("observed_years")).orderBy(*keys)


def category_year_coverage(book: Book) -> DataFrame:
    return _year_coverage(book, ["category"])


def category_year_combinations(book: Book) -> DataFrame:
    seen = _with_year(book.facts(("order_date",), ("category",))).select("category", "order_year").distinct()
    return seen.agg(F.count(F.lit(1)).alias("category_year_combinations"))


def subcategory_comparison(book: Book) -> DataFrame:
    df = small_share(book.subcategories, {"global_sales_share_percentage": "total_sales",
                                          "global_profit_share_percentage": "total_profit"})
    df = small_share(df, {"category_sales_share_percentage": "total_sales"}, ("category",))
    df = small_ranks(df, {
        "global_sales_rank": "total_sales desc", "global_profit_rank": "total_profit desc",
        "global_margin_rank": "comparable_profit_margin_percentage desc", "category_sales_rank": "total_sales desc",
    }, {"category_sales_rank": ("category",)})
    df = df.select("*", (F.col("global_profit_rank") - F.col("global_sales_rank")).alias("sales_profit_rank_gap"))
    return present(df.orderBy("global_sales_rank", *SUB), LAYOUT["subcategory_comparison"])


def subcategory_count_check(book: Book) -> DataFrame:
    model = book.star.products.select(*SUB).distinct()
    return count_against(model, views.sold_products(book.star).select(*SUB).distinct(),
                         ("subcategories_model", "subcategories_analysed", "difference"))


def subcategory_share_check(book: Book) -> DataFrame:
    df = small_share(book.totals(*SUB), {"s": "total_sales"}, ("category",))
    total = F.sum(F.col("s").cast("decimal(28,12)"))
    return df.groupBy("category").agg(F.round(total, 2).cast("double").alias("category_sales_share_total")).orderBy("category")


def subcategory_share_total(book: Book) -> DataFrame:
    df = book.totals(*SUB)
    return share_total(df, line_rollup(book.star.lines, [], parties=False), {"total_sales": "total_sales_share_percentage"})


def _sub_quadrant(book: Book) -> DataFrame:
    df = against_mean(narrow(book.subcategories, *book.subcategories.columns))
    return df.select("*", quadrant_label("volumen", unknown_sales=False).alias("performance_profile"))


def subcategory_quadrant(book: Book) -> DataFrame:
    df = _sub_quadrant(book).orderBy(profile_order("performance_profile", "volumen"), F.desc("total_sales"), *SUB)
    return present(df, LAYOUT["subcategory_quadrant"])


def high_sales_low_margin() -> Column:
    return (F.col("total_sales") >= F.col("sales_benchmark")) & (
        F.col("comparable_profit_margin_percentage") < F.col("margin_benchmark"))


def subcategory_high_volume_low_margin(book: Book) -> DataFrame:
    df = _sub_quadrant(book).where(high_sales_low_margin())
    return present(df.orderBy("comparable_profit_margin_percentage", F.desc("total_sales"), *SUB),
                   LAYOUT["subcategory_high_volume_low_margin"])


def subcategory_quadrant_distribution(book: Book) -> DataFrame:
    slim = book.totals(*SUB)
    df = against_mean(slim).select(quadrant_label("volumen", unknown_sales=False).alias("performance_profile"))
    return df.groupBy("performance_profile").agg(F.count(F.lit(1)).alias("total_subcategories")).orderBy("performance_profile")


def subcategory_pareto(book: Book) -> DataFrame:
    df = cumulate(book.subcategories, "total_sales", "sub_category, category", position="sales_position",
                  share="sales_share_percentage", cumulative="cumulative_sales_percentage", running="cumulative_sales")
    df = df.select("*", abc_class(F.col("cumulative_sales_percentage")).alias("abc_classification"))
    return present(df.orderBy("sales_position"), LAYOUT["subcategory_pareto"])


def subcategory_milestones(book: Book) -> DataFrame:
    df = cumulate(book.totals(*SUB).select(*SUB, "total_sales"), "total_sales",
                  "sub_category, category", position="n", share="s", cumulative="c")
    return df.agg(*milestones(df, "c", "n", [f"subcategories_for_{m}_percent" for m in (50, 80, 95)]))


def loss_risk() -> Column:
    return (F.when(F.col("total_profit") < 0, RISKS[0])
            .when(F.col("comparable_profit_margin_percentage") < 0, RISKS[1])
            .when(F.col("loss_making_lines") > 0, RISKS[2]).otherwise(RISKS[3]))


def subcategory_risk(book: Book) -> DataFrame:
    df = derive(book.subcategories, "known_loss_making_line_percentage")
    df = small_ranks(df, {"lowest_profit_rank": "total_profit asc",
                          "loss_frequency_rank": "known_loss_making_line_percentage desc"})
    df = df.select("*", loss_risk().alias("risk_status"))
    place = F.array_position(F.array(*[F.lit(r) for r in RISKS]), F.col("risk_status"))
    return present(df.orderBy(place, "total_profit", "sub_category", "category"), LAYOUT["subcategory_risk"])


def subcategory_negative_profit(book: Book) -> DataFrame:
    df = line_rollup(book.facts(PARTY, tuple(SUB)), SUB).where("total_profit < 0")
    return present(df.orderBy("total_profit", "sub_category", "category"), LAYOUT["subcategory_negative_profit"])


def subcategory_top_loss_lines(book: Book) -> DataFrame:
    df = derive(book.totals(*SUB), "known_loss_making_line_percentage")
    df = df.where("total_order_lines - unknown_profit_lines > 0")
    order = [F.desc("known_loss_making_line_percentage"), F.desc("loss_making_lines"), "sub_category", "category"]
    return present(df.orderBy(*order).limit(5), LAYOUT["subcategory_top_loss_lines"])


def subcategory_yearly(book: Book) -> DataFrame:
    df = yearly(book.facts(PARTY, tuple(SUB)), SUB, products=True)
    return present(df.orderBy(*SUB, "order_year"), LAYOUT["subcategory_yearly"])


def subcategory_growth_margin_drop(book: Book) -> DataFrame:
    df = yearly(book.facts(("order_date",), tuple(SUB)), SUB, products=False, parties=False).where(growth_with_falling_margin())
    df = df.select("*", F.col("year_over_year_sales_growth_percentage").alias("sales_growth_percentage"),
                   F.col("comparable_profit_margin_percentage").alias("current_margin"),
                   F.col("year_over_year_margin_change_points").alias("margin_change_points"))
    return present(df.orderBy("margin_change_points", F.desc("sales_growth_percentage"), *SUB),
                   LAYOUT["subcategory_growth_margin_drop"])


def subcategory_year_coverage(book: Book) -> DataFrame:
    return _year_coverage(book, SUB)


REPORTS = {f.__name__: f for f in (
    category_comparison, category_share_totals, category_rank_gap, category_by_margin, category_discount_bands,
    category_loss_discounts, category_yearly, category_year_coverage, category_year_combinations,
    subcategory_comparison, subcategory_count_check, subcategory_share_check, subcategory_share_total,
    subcategory_quadrant, subcategory_high_volume_low_margin, subcategory_quadrant_distribution,
    subcategory_pareto, subcategory_milestones, subcategory_risk, subcategory_negative_profit,
    subcategory_top_loss_lines, subcategory_yearly, subcategory_growth_margin_drop, subcategory_year_coverage)}
