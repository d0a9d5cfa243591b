"""City, state, region and country reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ventaria.functions.expressions import flag, growth, pct, rounded
from ventaria.functions.measures import order_rollup
from ventaria.functions.present import present
from ventaria.operators.concentration import abc_class, cumulate, milestones
from ventaria.operators.growth import with_previous
from ventaria.operators.ordering import dense_ranks, small_ranks, small_share
from ventaria.operators.quadrant import against_mean, profile_order, quadrant_label
from ventaria.operators.reconcile import compare_totals, levels_against_total, share_total, uniqueness
from ventaria.operators.scalars import attach
from ventaria.plans.book import Book, narrow
from ventaria.plans.category import growth_with_falling_margin
from ventaria.plans.customer import LOSS_STATUS
from ventaria.plans.layouts import GEOGRAPHY as LAYOUT
from ventaria.plans.views import PLACE
from ventaria.session import settle

STATE = ["region", "country", "state"]
CITY_KEY = "country, state, city, region"
_DISPLAY = ["distinct_postal_codes", "total_orders", "distinct_customers", "total_order_lines", "total_sales",
            "total_quantity", "total_profit", "average_complete_order_value", "comparable_profit_margin_percentage",
            "average_shipping_days", "minimum_shipping_days", "maximum_shipping_days", "complete_loss_making_orders",
            "orders_with_unknown_profit", "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines"]


def _cities(book: Book) -> DataFrame:
    """City measures with customers only (no postal codes): one distinct count."""
    return order_rollup(book.orders, PLACE)


def _gap(df: DataFrame, prefix: str = "") -> DataFrame:
    return df.select("*", (F.col(f"{prefix}profit_rank") - F.col(f"{prefix}sales_rank")).alias("sales_profit_rank_gap"))


def city_ranking(book: Book) -> DataFrame:
    df = settle(narrow(book.cities, *PLACE, *_DISPLAY))
    df = attach(df, df.agg(F.sum("total_sales").alias("_all")))
    df = df.select("*", pct("total_sales", "_all").alias("global_sales_share_percentage"))
    df = dense_ranks(df, CITY_KEY, {
        "profit_rank": "total_profit desc", "margin_rank": "comparable_profit_margin_percentage desc",
        "regional_sales_rank": "total_sales desc", "sales_rank": "total_sales desc",
    }, {"regional_sales_rank": ("region",)})
    return present(_gap(df).orderBy("sales_rank", "country", "state", "city"), LAYOUT["city_ranking"])


def top_cities_by_sales(book: Book) -> DataFrame:
    df = _cities(book).orderBy(F.desc("total_sales"), "country", "state", "city").limit(20)
    return present(df, LAYOUT["top_cities_by_sales"])


def top_cities_by_profit(book: Book) -> DataFrame:
    df = _cities(book).orderBy(F.desc("total_profit"), "country", "state", "city").limit(20)
    return present(df, LAYOUT["top_cities_by_profit"])


def city_uniqueness(book: Book) -> DataFrame:
    return uniqueness(order_rollup(book.orders, PLACE, {}), PLACE, "total_cities", "unique_cities", "duplicates")


def city_quadrant(book: Book) -> DataFrame:
    df = against_mean(narrow(book.cities, *PLACE, *_DISPLAY), known_sales_only=True)
    status = (F.when(F.col("total_profit") < 0, "Beneficio acumulado negativo")
              .when(F.col("complete_loss_making_orders") > 0, LOSS_STATUS[1]).otherwise(LOSS_STATUS[2]))
    df = df.select("*", quadrant_label("volumen", unknown_sales=True).alias("geographic_profile"),
                   status.alias("profitability_status"))
    order = [profile_order("geographic_profile", "volumen"), F.desc("total_sales"), "country", "state", "city"]
    return present(df.orderBy(*order), LAYOUT["city_quadrant"])


def region_performance(book: Book) -> DataFrame:
    df = small_share(order_rollup(book.orders, ["region"]), {
        "sales_share_percentage": "total_sales", "order_share_percentage": "total_orders"})
    df = small_ranks(df, {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc",
                          "margin_rank": "comparable_profit_margin_percentage desc"})
    return present(_gap(df).orderBy("sales_rank", "region"), LAYOUT["region_performance"])


def _share_check(book: Book, key: str) -> DataFrame:
    measures = [F.count(F.lit(1)).alias("total_orders"), F.sum("total_sales").alias("total_sales")]
    return share_total(book.orders.groupBy(key).agg(*measures), book.orders.agg(*measures),
                       {"total_orders": "order_share_total", "total_sales": "sales_share_total"})


def region_share_check(book: Book) -> DataFrame:
    return _share_check(book, "region")


def country_share_check(book: Book) -> DataFrame:
    return _share_check(book, "country")


def region_count(book: Book) -> DataFrame:
    return book.orders.agg(F.count_distinct("region").alias("total_regions"))


def country_count(book: Book) -> DataFrame:
    return book.orders.agg(F.count_distinct("country").alias("total_countries"))


def _states(book: Book) -> DataFrame:
    return order_rollup(book.orders, STATE, {"distinct_customers": ["customer_id"], "distinct_cities": ["city"]})


def state_performance(book: Book) -> DataFrame:
    df = small_share(_states(book), {"global_sales_share_percentage": "total_sales"})
    df = small_ranks(df, {
        "global_sales_rank": "total_sales desc", "global_profit_rank": "total_profit desc",
        "global_margin_rank": "comparable_profit_margin_percentage desc",
        "regional_sales_rank": "total_sales desc", "regional_profit_rank": "total_profit desc",
        "country_sales_rank": "total_sales desc",
    }, {"regional_sales_rank": ("region",), "regional_profit_rank": ("region",), "country_sales_rank": ("country",)})
    return present(_gap(df, "global_").orderBy("global_sales_rank", "country", "state"), LAYOUT["state_performance"])


def top_states(book: Book) -> DataFrame:
    df = _states(book).orderBy(F.desc("total_sales"), "country", "state", "region").limit(15)
    return present(df, LAYOUT["top_states"])


def state_negative_profit(book: Book) -> DataFrame:
    df = order_rollup(book.orders, STATE).where("total_profit < 0")
    return present(df.orderBy("total_profit", F.desc("total_sales"), "country", "state"), LAYOUT["state_negative_profit"])


def country_negative_profit(book: Book) -> DataFrame:
    df = order_rollup(book.orders, ["country"]).where("total_profit < 0")
    return present(df.orderBy("total_profit", F.desc("total_sales"), "country"), LAYOUT["country_negative_profit"])


def state_conservation(book: Book) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("total_sales", "total_profit")]
    n = F.count(F.lit(1)).alias("total_orders")
    states = book.orders.groupBy(*STATE).agg(n, *sums)
    whole = states.agg(F.sum("total_orders").alias("total_orders"), *sums)
    out = compare_totals(book.orders.agg(n, *sums), whole, {
        "total_orders": ("original_orders", "state_orders", "order_difference"),
        "total_sales": ("original_sales", "state_sales", "sales_difference"),
        "total_profit": ("original_profit", "state_profit", "profit_difference")})
    return out


def country_performance(book: Book) -> DataFrame:
    df = order_rollup(book.orders, ["country"], {
        "distinct_regions": ["region"], "distinct_states": ["state"], "distinct_cities": ["city"],
        "distinct_customers": ["customer_id"]})
    df = small_share(df, {"sales_share_percentage": "total_sales", "order_share_percentage": "total_orders",
                          "customer_presence_share_percentage": "distinct_customers"})
    df = small_ranks(df, {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc",
                          "margin_rank": "comparable_profit_margin_percentage desc",
                          "average_order_value_rank": "average_complete_order_value desc"})
    return present(_gap(df).orderBy("sales_rank", "country"), LAYOUT["country_performance"])


def _city_abc(df: DataFrame) -> DataFrame:
    """Cities accumulate their shares, not their sales."""
    df = cumulate(df.where("total_sales IS NOT NULL"), "total_sales", CITY_KEY, position="city_position",
                  share="sales_share_percentage", cumulative="cumulative_sales_percentage", by_share=True)
    return df.select("*", abc_class(F.col("cumulative_sales_percentage")).alias("abc_class"))


def _city_sales(book: Book) -> DataFrame:
    return order_rollup(book.orders, PLACE, {}).select(*PLACE, "total_sales")


def city_abc(book: Book) -> DataFrame:
    df = _city_abc(narrow(_cities(book), *PLACE, *_DISPLAY))
    return present(df.orderBy("city_position"), LAYOUT["city_abc"])


def city_milestones(book: Book) -> DataFrame:
    names = [f"cities_for_{m}_percent_sales" for m in (50, 80, 95)]
    df = _city_abc(_city_sales(book))
    return df.agg(F.count(F.lit(1)).alias("cities_with_known_sales"),
                  *milestones(df, "cumulative_sales_percentage", "city_position", names))


def city_abc_distribution(book: Book) -> DataFrame:
    share = F.sum(F.col("sales_share_percentage").cast("decimal(28,12)"))
    df = _city_abc(_city_sales(book)).groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("total_cities"), F.sum("total_sales").alias("total_sales"),
        share.alias("sales_share_percentage"),
        (F.sum("total_sales").cast("double") / F.count("total_sales")).alias("average_city_sales"))
    df = small_share(df, {"city_share_percentage": "total_cities"})
    return present(df.orderBy("abc_class"), "abc_class total_cities city_share_percentage total_sales "
                   "sales_share_percentage average_city_sales")


def city_share_check(book: Book) -> DataFrame:
    df = settle(_city_sales(book).where("total_sales IS NOT NULL"))
    df = attach(df, df.agg(F.sum("total_sales").alias("_all")))
    total = F.sum(pct("total_sales", "_all").cast("decimal(28,12)"))
    return df.agg(F.count(F.lit(1)).alias("cities_with_known_sales"),
                  F.round(total, 2).cast("double").alias("total_sales_share_percentage"))


def _region_years(book: Book) -> DataFrame:
    df = with_previous(order_rollup(book.orders, ["region", "order_year"]), ["order_year"], {
        "previous_year_orders": "total_orders", "previous_year_customers": "distinct_customers",
        "previous_year_sales": "total_sales", "previous_year_profit": "total_profit",
        "previous_year_margin": "comparable_profit_margin_percentage"}, ("region",))
    return df.select(
        "*", growth("total_orders", "previous_year_orders").alias("yoy_order_growth_percentage"),
        growth("distinct_customers", "previous_year_customers").alias("yoy_customer_growth_percentage"),
        growth("total_sales", "previous_year_sales").alias("yoy_sales_growth_percentage"),
        (F.col("total_profit") - F.col("previous_year_profit")).alias("yoy_profit_absolute_change"),
        (F.col("comparable_profit_margin_percentage") - F.col("previous_year_margin")).alias("yoy_margin_change_points"))


def region_yearly(book: Book) -> DataFrame:
    return present(_region_years(book).orderBy("region", "order_year"), LAYOUT["region_yearly"])


def region_growth_margin_drop(book: Book) -> DataFrame:
    df = _region_years(book).where(growth_with_falling_margin())
    order = ["yoy_margin_change_points", F.desc("yoy_sales_growth_percentage"), "region", "order_year"]
    return present(df.orderBy(*order), LAYOUT["region_growth_margin_drop"])


def region_year_coverage(book: Book) -> DataFrame:
    return book.orders.groupBy("region").agg(
        F.count_distinct("order_year").alias("observed_years"), F.min("order_year").alias("first_year"),
        F.max("order_year").alias("last_year"), F.count(F.lit(1)).alias("total_orders")).orderBy("region")


def region_year_combinations(book: Book) -> DataFrame:
    return book.orders.select("region", "order_year").distinct().agg(F.count(F.lit(1)).alias("region_year_combinations"))


def _losses(df: DataFrame) -> DataFrame:
    df = df.where("total_profit < 0").select("*", F.abs("total_profit").alias("known_loss_amount"))
    df = cumulate(df, "known_loss_amount", CITY_KEY, position="loss_position", share="loss_share_percentage",
                  cumulative="cumulative_loss_percentage", by_share=True)
    return df.select("*", abc_class(F.col("cumulative_loss_percentage")).alias("loss_concentration_class"))


def city_loss_concentration(book: Book) -> DataFrame:
    df = _losses(narrow(_cities(book), *PLACE, *_DISPLAY))
    return present(df.orderBy("loss_position"), LAYOUT["city_loss_concentration"])


def city_loss_milestones(book: Book) -> DataFrame:
    df = _losses(order_rollup(book.orders, PLACE, {}).select(*PLACE, "total_profit"))
    names = [f"cities_for_{m}_percent_losses" for m in (50, 80, 95)]
    return df.agg(F.count(F.lit(1)).alias("loss_making_cities"),
                  *milestones(df, "cumulative_loss_percentage", "loss_position", names))


def top_city_losses(book: Book) -> DataFrame:
    df = _cities(book).where("total_profit < 0").select("*", F.abs("total_profit").alias("known_loss_amount"))
    order = ["total_profit", F.desc("total_sales"), "country", "state", "city"]
    return present(df.orderBy(*order).limit(20), LAYOUT["top_city_losses"])


def city_high_sales_loss(book: Book) -> DataFrame:
    df = against_mean(narrow(_cities(book), *PLACE, *_DISPLAY), known_sales_only=True)
    df = df.where("double(total_sales) >= sales_benchmark AND total_profit < 0")
    df = df.select("*", F.col("sales_benchmark").alias("average_city_sales"), F.col("sales_vs_benchmark").alias("sales_above_average"))
    return present(df.orderBy(F.desc("total_sales"), "total_profit", "country", "state", "city"), LAYOUT["city_high_sales_loss"])


def city_loss_check(book: Book) -> DataFrame:
    df = order_rollup(book.orders, PLACE, {}).where("total_profit < 0").agg(
        F.count(F.lit(1)).alias("loss_making_cities"), F.sum("total_profit").alias("n"), F.sum(F.abs("total_profit")).alias("a"))
    return df.select("loss_making_cities", rounded("n").alias("total_negative_profit"), rounded("a").alias("total_known_loss_amount"),
                     rounded(pct("a", "a")).alias("validated_loss_share_percentage"))


def geographic_levels(book: Book) -> DataFrame:
    return levels_against_total(book.orders, {"Country": ["country"], "Region": ["region"], "State": STATE, "City": PLACE},
                                "geographic_level", "geographic_groups")


def _sizes(df: DataFrame):
    return [F.count_distinct("country").alias("total_countries"), F.count_distinct("region").alias("total_regions"),
            F.count_distinct("country", "state").alias("total_states"),
            F.count_distinct("country", "state", "city").alias("total_cities")]


def geographic_cardinality(book: Book) -> DataFrame:
    places = book.orders.select(*PLACE).distinct()
    return places.agg(*_sizes(places))


def geographic_missing(book: Book) -> DataFrame:
    return book.orders.agg(*[F.sum(flag(F.col(c).isNull())).alias(f"orders_without_{c}") for c in ("country", "region", "state", "city")])


def order_uniqueness(book: Book) -> DataFrame:
    return uniqueness(book.orders, ["order_key"], "total_orders", "unique_order_keys", "duplicated_order_keys")


def geographic_summary(book: Book) -> DataFrame:
    orders = book.orders.agg(F.count(F.lit(1)).alias("total_orders"), F.count_distinct("order_key").alias("unique_orders"),
                             F.sum("total_sales").alias("total_sales"), F.sum("total_profit").alias("total_profit"))
    df = attach(orders, geographic_cardinality(book))
    return present(df, "total_orders unique_orders total_countries total_regions total_states total_cities total_sales total_profit")


REPORTS = {f.__name__: f for f in (
    city_ranking, top_cities_by_sales, top_cities_by_profit, city_uniqueness, city_quadrant, region_performance,
    region_share_check, region_count, state_performance, top_states, state_negative_profit, state_conservation,
    country_performance, country_negative_profit, country_share_check, country_count, city_abc, city_milestones,
    city_abc_distribution, city_share_check, region_yearly, region_growth_margin_drop, region_year_coverage,
    region_year_combinations, city_loss_concentration, city_loss_milestones, top_city_losses, city_high_sales_loss,
    city_loss_check, geographic_levels, geographic_cardinality, geographic_missing, order_uniqueness, geographic_summary)}
