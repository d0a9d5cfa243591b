"""Shipping reports by mode, delay, place and time.

All frames below the order view are bounded by small domains (modes, delays,
regions, countries, months), so plain windows over them are safe.  Global
reference values are folded from the group sums instead of a second scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ventaria.functions.expressions import (
    flag, growth, mean_of, mode_or_unknown, month_name, pct, ratio, shipping_band, sql_spread)
from ventaria.functions.measures import order_rollup
from ventaria.functions.present import derive, present
from ventaria.operators.growth import with_previous
from ventaria.operators.ordering import small_ranks, small_share
from ventaria.operators.reconcile import levels_against_total
from ventaria.operators.scalars import attach
from ventaria.plans.book import Book
from ventaria.plans.layouts import LOGISTICS as LAYOUT

# Published labels.
EVOLUTION = {"base": "Año base", "better": "Mejora logística consistente",
             "worse": "Deterioro logístico consistente", "mixed": "Evolución mixta"}
MODE_ORDER = ("Standard Class", "Second Class", "First Class", "Same Day", "Unknown")
MODE_COLUMNS = {"Same Day": "same_day_average_days", "First Class": "first_class_average_days",
                "Second Class": "second_class_average_days", "Standard Class": "standard_class_average_days"}

_NO_COUNT: dict[str, list[str]] = {}


def by_mode(orders: DataFrame, keys: list[str] = (), distinct: dict | None = None) -> DataFrame:
    """Order measures per shipping mode (and further keys), unknown mode named."""
    named = orders.select("*", mode_or_unknown().alias("mode"), flag(F.col("ship_mode").isNull()).alias("is_unknown_ship_mode"))
    return order_rollup(named, [*keys, "mode", "is_unknown_ship_mode"], distinct).withColumnRenamed("mode", "ship_mode")


def with_band(orders: DataFrame) -> DataFrame:
    label, place = shipping_band("shipping_days")
    return orders.select("*", label.alias("shipping_time_group"), place.alias("shipping_time_order"))


def ship_mode_ranking(book: Book) -> DataFrame:
    df = small_share(by_mode(book.orders), {"order_share_percentage": "total_orders", "sales_share_percentage": "total_sales"})
    df = small_ranks(df, {"usage_rank": "total_orders desc", "shipping_speed_rank": "average_shipping_days asc",
                          "sales_rank": "total_sales desc", "profit_rank": "total_profit desc"})
    df = df.select("*", (F.col("profit_rank") - F.col("sales_rank")).alias("sales_profit_rank_gap"))
    return present(df.orderBy("is_unknown_ship_mode", "usage_rank", "ship_mode"), LAYOUT["ship_mode_ranking"])


def ship_mode_distribution(book: Book) -> DataFrame:
    df = small_share(by_mode(book.orders, distinct=_NO_COUNT), {"order_share_percentage": "total_orders"})
    return present(df.orderBy("is_unknown_ship_mode", F.desc("total_orders"), "ship_mode"), LAYOUT["ship_mode_distribution"])


def _orders_kept(book: Book, keys: list[str], grouped: str, groups: str | None = None) -> DataFrame:
    """Order counts over the groups against the order view."""
    n = F.count(F.lit(1))
    orders = book.orders.select("*", mode_or_unknown().alias("mode"))
    parts = orders.groupBy(*keys).agg(n.alias("n"))
    out = parts.agg(*([n.alias(groups)] if groups else []), F.sum("n").alias(grouped))
    out = attach(out, book.orders.agg(n.alias("original_orders")))
    return out.select("*", (F.col(grouped) - F.col("original_orders")).alias("order_difference"))


def ship_mode_conservation(book: Book) -> DataFrame:
    return _orders_kept(book, ["mode"], "orders_by_ship_mode")


def ship_mode_share_check(book: Book) -> DataFrame:
    df = _orders_kept(book, ["mode"], "n")
    return present(df.select(pct("n", "original_orders").alias("total_order_share_percentage")), "total_order_share_percentage")


def shipping_bands(book: Book) -> DataFrame:
    df = order_rollup(with_band(book.orders), ["shipping_time_group", "shipping_time_order"])
    df = small_share(df, {"order_share_percentage": "total_orders", "sales_share_percentage": "total_sales"})
    return present(df.orderBy("shipping_time_order"), LAYOUT["shipping_bands"])


def shipping_day_histogram(book: Book) -> DataFrame:
    df = book.orders.groupBy("shipping_days").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("total_sales").alias("total_sales"),
        F.sum("total_profit").alias("total_profit"), mean_of("total_sales").alias("average_known_sales_per_order"))
    df = small_share(df, {"order_share_percentage": "total_orders"})
    return present(df.orderBy("shipping_days"), LAYOUT["shipping_day_histogram"])


def long_shipping_orders(book: Book) -> DataFrame:
    df = book.orders.where("shipping_days >= 8").withColumn("ship_mode", mode_or_unknown())
    return present(df.orderBy(F.desc("shipping_days"), "order_date", "order_key"), LAYOUT["long_shipping_orders"])


def shipping_band_check(book: Book) -> DataFrame:
    n = F.count(F.lit(1))
    banded = with_band(book.orders).where("shipping_time_group IS NOT NULL")
    df = banded.agg(n.alias("classified_orders"), F.count_distinct("order_key").alias("unique_classified_orders"))
    df = attach(df, book.orders.agg(n.alias("original_orders")))
    return df.select("*", F.expr("classified_orders - original_orders AS order_difference"),
                     F.expr("classified_orders - unique_classified_orders AS duplicated_orders"))


def _mode_band(book: Book, distinct: dict | None = None) -> DataFrame:
    df = by_mode(with_band(book.orders), ["shipping_time_group", "shipping_time_order"], distinct)
    df = small_share(df, {"within_ship_mode_order_percentage": "total_orders"}, ("ship_mode",))
    return small_share(df, {"within_time_group_order_percentage": "total_orders"}, ("shipping_time_group",))


def mode_by_band(book: Book) -> DataFrame:
    df = _mode_band(book).orderBy("is_unknown_ship_mode", "ship_mode", "shipping_time_order")
    return present(df, LAYOUT["mode_by_band"])


def mode_band_wide(book: Book) -> DataFrame:
    df = by_mode(book.orders, distinct=_NO_COUNT)
    return present(df.orderBy("is_unknown_ship_mode", "average_shipping_days", "ship_mode"), LAYOUT["mode_band_wide"])


def same_day_histogram(book: Book) -> DataFrame:
    df = book.orders.where("ship_mode = 'Same Day'").groupBy("shipping_days").agg(F.count(F.lit(1)).alias("total_orders"))
    df = small_share(df, {"order_share_percentage": "total_orders"})
    return present(df.orderBy("shipping_days"), "shipping_days total_orders order_share_percentage")


def mode_band_check(book: Book) -> DataFrame:
    share = F.sum(F.col("within_ship_mode_order_percentage").cast("decimal(28,12)"))
    df = _mode_band(book, _NO_COUNT).groupBy("ship_mode").agg(F.sum("total_orders").alias("total_orders"), share.alias("total_percentage"))
    return present(df.orderBy("ship_mode"), "ship_mode total_orders total_percentage")


def _global(name: str, numerator: str, denominator: str, partition: tuple[str, ...] = ()) -> Column:
    """A ratio of group sums over all groups (or per ``partition``)."""
    over = Window.partitionBy(*partition)
    return ratio(F.sum(numerator).over(over), F.sum(denominator).over(over)).alias(name)


def _against_global_days(df: DataFrame) -> DataFrame:
    df = df.select("*", _global("global_average_shipping_days", "shipping_days_sum", "total_orders"))
    apart = F.col("average_shipping_days") - F.col("global_average_shipping_days")
    df = derive(df, "eight_plus_day_percentage")
    return df.select("*", apart.alias("shipping_days_vs_global_average"), apart.alias("shipping_days_above_average"))


def _speed_ranks(df: DataFrame, **more: str) -> DataFrame:
    return small_ranks(df, {"shipping_speed_rank": "average_shipping_days asc", "long_shipping_rank": "eight_plus_day_percentage desc", **more})


def region_logistics(book: Book) -> DataFrame:
    df = _speed_ranks(_against_global_days(order_rollup(book.orders, ["region"])))
    return present(df.orderBy("shipping_speed_rank", "region"), LAYOUT["region_logistics"])


def _slow(book: Book, key: str, layout: str) -> DataFrame:
    df = _against_global_days(order_rollup(book.orders, [key], _NO_COUNT)).where("average_shipping_days > global_average_shipping_days")
    return present(df.orderBy(F.desc("shipping_days_above_average"), F.desc("total_orders"), key), LAYOUT[layout])


def slow_regions(book: Book) -> DataFrame:
    return _slow(book, "region", "slow_regions")


def slow_countries(book: Book) -> DataFrame:
    return _slow(book, "country", "slow_countries")


def _day_histogram(book: Book, key: str, share: str) -> DataFrame:
    df = book.orders.groupBy(key, "shipping_days").agg(F.count(F.lit(1)).alias("total_orders"))
    df = small_share(df, {share: "total_orders"}, (key,))
    return present(df.orderBy(key, "shipping_days"), f"{key} shipping_days total_orders {share}")


def region_day_histogram(book: Book) -> DataFrame:
    return _day_histogram(book, "region", "regional_order_percentage")


def country_day_histogram(book: Book) -> DataFrame:
    return _day_histogram(book, "country", "country_order_percentage")


def region_order_conservation(book: Book) -> DataFrame:
    return _orders_kept(book, ["region"], "regional_orders", "total_regions")


def country_order_conservation(book: Book) -> DataFrame:
    return _orders_kept(book, ["country"], "country_orders", "total_countries")


def country_logistics(book: Book) -> DataFrame:
    df = order_rollup(book.orders, ["country"], {"distinct_customers": ["customer_id"], "distinct_states": ["state"], "distinct_cities": ["city"]})
    df = _against_global_days(df)
    all_rows = Window.partitionBy()
    sums = [F.sum(c).over(all_rows).alias(f"_{c}") for c in ("total_orders", "shipping_days_sum", "shipping_days_squares")]
    df = df.select("*", *sums).select("*", F.expr(sql_spread("_total_orders", "_shipping_days_sum", "_shipping_days_squares")).alias("global_shipping_days_stddev"))
    df = _speed_ranks(df, shipping_consistency_rank="shipping_days_stddev asc")
    return present(df.orderBy("shipping_speed_rank", "country"), LAYOUT["country_logistics"])


def country_mode_share(book: Book) -> DataFrame:
    df = small_share(by_mode(book.orders, ["country"], _NO_COUNT), {"country_ship_mode_percentage": "total_orders"}, ("country",))
    return present(df.orderBy("country", F.desc("total_orders"), "ship_mode"),
                   "country ship_mode total_orders country_ship_mode_percentage average_shipping_days")


_PACE = ("same_day_percentage", "two_day_or_less_percentage", "eight_plus_day_percentage", "unknown_ship_mode_percentage")


def _paced(book: Book, keys: list[str], order: list[str], distinct: dict | None = None) -> DataFrame:
    """Logistics measures per period with the values of the period before."""
    df = derive(order_rollup(book.orders, keys, distinct), *_PACE)
    watched = ("total_orders", "average_shipping_days", "shipping_days_stddev", *_PACE)
    return with_previous(df, order, {f"p_{w}": w for w in watched})


def _step(column: str) -> Column:
    return F.col(column) - F.col(f"p_{column}")


def annual_logistics(book: Book) -> DataFrame:
    df = _paced(book, ["order_year"], ["order_year"])
    df = df.select(
        "*", growth("total_orders", "p_total_orders").alias("yoy_order_growth_percentage"),
        _step("average_shipping_days").alias("yoy_average_shipping_days_change"),
        _step("shipping_days_stddev").alias("yoy_shipping_stddev_change"),
        *[_step(p).alias(f"yoy_{p.removesuffix('_percentage')}_change_points") for p in _PACE])
    return present(df.orderBy("order_year"), LAYOUT["annual_logistics"])


def logistics_evolution(book: Book) -> DataFrame:
    df = _paced(book, ["order_year"], ["order_year"], _NO_COUNT)
    days, fast, slow = _step("average_shipping_days"), _step("two_day_or_less_percentage"), _step("eight_plus_day_percentage")
    label = (F.when(F.col("p_average_shipping_days").isNull(), EVOLUTION["base"])
             .when((days < 0) & (fast > 0) & (slow < 0), EVOLUTION["better"])
             .when((days > 0) & (fast < 0) & (slow > 0), EVOLUTION["worse"]).otherwise(EVOLUTION["mixed"]))
    df = df.select("*", days.alias("average_shipping_days_change"), fast.alias("two_day_or_less_change_points"),
                   slow.alias("eight_plus_day_change_points"), label.alias("logistics_evolution"))
    return present(df.orderBy("order_year"), LAYOUT["logistics_evolution"])


def annual_mode_usage(book: Book) -> DataFrame:
    df = small_share(by_mode(book.orders, ["order_year"], _NO_COUNT), {"annual_ship_mode_percentage": "total_orders"}, ("order_year",))
    return present(df.orderBy("order_year", F.desc("total_orders"), "ship_mode"),
                   "order_year ship_mode total_orders annual_ship_mode_percentage average_shipping_days")


def order_year_coverage(book: Book) -> DataFrame:
    return book.orders.agg(F.count_distinct("order_year").alias("observed_years"), F.min("order_year").alias("first_year"),
                           F.max("order_year").alias("last_year"), F.count(F.lit(1)).alias("total_orders"))


def annual_order_conservation(book: Book) -> DataFrame:
    return _orders_kept(book, ["order_year"], "annual_orders")


def monthly_logistics(book: Book) -> DataFrame:
    df = _paced(book, ["order_year", "order_month", "order_year_month"], ["order_year", "order_month"])
    df = df.select("*", _step("average_shipping_days").alias("mom_average_shipping_days_change"),
                   _step("two_day_or_less_percentage").alias("mom_two_day_or_less_change_points"),
                   _step("eight_plus_day_percentage").alias("mom_eight_plus_day_change_points"))
    return present(df.orderBy("order_year", "order_month"), LAYOUT["monthly_logistics"])


def _calendar(book: Book) -> DataFrame:
    df = order_rollup(book.orders.withColumnRenamed("order_month", "calendar_month"), ["calendar_month"], {"observed_years": ["order_year"]})
    return derive(df, "eight_plus_day_percentage").select("*", month_name("calendar_month").alias("month_name"))


def logistics_seasonality(book: Book) -> DataFrame:
    return present(_speed_ranks(_calendar(book)).orderBy("calendar_month"), LAYOUT["logistics_seasonality"])


def months_by_shipping_time(book: Book) -> DataFrame:
    order = [F.desc("average_shipping_days"), F.desc("eight_plus_day_percentage"), "calendar_month"]
    return present(_calendar(book).orderBy(*order), LAYOUT["months_by_shipping_time"])


def calendar_coverage(book: Book) -> DataFrame:
    return book.orders.groupBy(F.col("order_month").alias("calendar_month")).agg(
        F.count_distinct("order_year").alias("observed_years"), F.count(F.lit(1)).alias("total_orders")).orderBy("calendar_month")


def calendar_size(book: Book) -> DataFrame:
    months = book.orders.select("order_month", "order_year_month").distinct()
    return months.agg(F.count_distinct("order_month").alias("calendar_months"),
                      F.count_distinct("order_year_month").alias("observed_year_months"))


def shipping_vs_commercial(book: Book) -> DataFrame:
    df = order_rollup(with_band(book.orders), ["shipping_time_group", "shipping_time_order"])
    value = _global("global_average_complete_order_value", "complete_sales", "complete_sales_orders")
    margin = pct(F.sum("comparable_profit").over(Window.partitionBy()), F.sum("comparable_sales").over(Window.partitionBy()))
    df = df.select("*", value, margin.alias("global_comparable_profit_margin_percentage"))
    df = df.select("*", F.expr("average_complete_order_value - global_average_complete_order_value AS order_value_vs_global_average"),
                   F.expr("comparable_profit_margin_percentage - global_comparable_profit_margin_percentage AS margin_vs_global_average_points"))
    df = small_share(df, {"order_share_percentage": "total_orders"})
    df = small_ranks(df, {"average_order_value_rank": "average_complete_order_value desc",
                          "profitability_rank": "comparable_profit_margin_percentage desc"})
    return present(df.orderBy("shipping_time_order"), LAYOUT["shipping_vs_commercial"])


def commercial_by_day(book: Book) -> DataFrame:
    df = small_share(order_rollup(book.orders, ["shipping_days"], _NO_COUNT), {"order_share_percentage": "total_orders"})
    return present(df.orderBy("shipping_days"), LAYOUT["commercial_by_day"])


def logistics_extremes(book: Book) -> DataFrame:
    group = F.when(F.col("shipping_days") <= 2, "0-2 días").when(F.col("shipping_days") >= 8, "8+ días")
    orders = book.orders.where("shipping_days <= 2 OR shipping_days >= 8").select("*", group.alias("logistics_group"))
    return present(order_rollup(orders, ["logistics_group"], _NO_COUNT).orderBy("logistics_group"), LAYOUT["logistics_extremes"])


def _against_mode(book: Book, key: str, distinct: dict | None = None) -> DataFrame:
    df = by_mode(book.orders, [key], distinct)
    df = df.select("*", _global("ship_mode_average_shipping_days", "shipping_days_sum", "total_orders", ("ship_mode",)))
    apart = F.col("average_shipping_days") - F.col("ship_mode_average_shipping_days")
    return df.select("*", apart.alias("shipping_days_vs_ship_mode_average"), apart.alias("shipping_days_above_ship_mode_average"))


def region_mode(book: Book) -> DataFrame:
    df = small_share(_against_mode(book, "region"), {"regional_ship_mode_percentage": "total_orders"}, ("region",))
    df = small_share(df, {"ship_mode_region_percentage": "total_orders"}, ("ship_mode",))
    rank = "regional_speed_rank_within_ship_mode"
    df = small_ranks(df, {rank: "average_shipping_days asc"}, {rank: ("ship_mode",)})
    return present(df.orderBy("is_unknown_ship_mode", "ship_mode", rank, "region"), LAYOUT["region_mode"])


def slow_region_modes(book: Book) -> DataFrame:
    df = _against_mode(book, "region", _NO_COUNT).where("average_shipping_days > ship_mode_average_shipping_days")
    order = [F.desc("shipping_days_above_ship_mode_average"), F.desc("total_orders"), "ship_mode", "region"]
    return present(df.orderBy(*order), LAYOUT["slow_region_modes"])


def country_mode(book: Book) -> DataFrame:
    rank = "country_speed_rank_within_ship_mode"
    df = small_ranks(_against_mode(book, "country", _NO_COUNT), {rank: "average_shipping_days asc"}, {rank: ("ship_mode",)})
    return present(df.orderBy("ship_mode", rank, "country"), LAYOUT["country_mode"])


def region_mode_matrix(book: Book) -> DataFrame:
    """Average delay per region, one column per known mode and one for unknown."""
    known = list(MODE_COLUMNS)
    grouped = by_mode(book.orders, ["region"], _NO_COUNT)
    wide = grouped.groupBy("region").pivot("ship_mode", [*known, "Unknown"]).agg(F.max("average_shipping_days"))
    wide = wide.select("region", *[F.col(f"`{m}`").alias(c) for m, c in MODE_COLUMNS.items()], F.col("Unknown").alias("unknown_average_days"))
    return present(wide.orderBy("region"), " ".join(wide.columns))


def region_mode_conservation(book: Book) -> DataFrame:
    return _orders_kept(book, ["region", "mode"], "classified_orders", "observed_region_ship_mode_combinations")


def logistics_levels(book: Book) -> DataFrame:
    orders = with_band(book.orders).select("*", mode_or_unknown().alias("mode"))
    return levels_against_total(orders, {
        "Ship Mode": ["mode"], "Shipping Time Group": ["shipping_time_group"], "Region": ["region"],
        "Country": ["country"], "Year": ["order_year"]}, "analysis_level", "observed_groups")


def date_coherence(book: Book) -> DataFrame:
    c = F.col
    df = book.orders.agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum(flag(c("ship_date") < c("order_date"))).alias("orders_with_invalid_dates"),
        F.sum(flag(c("shipping_days") < 0)).alias("orders_with_negative_shipping_days"),
        F.sum(flag(c("shipping_days") != F.date_diff("ship_date", "order_date"))).alias("shipping_day_mismatches"),
        F.min("shipping_days").alias("minimum_shipping_days"), F.max("shipping_days").alias("maximum_shipping_days"),
        mean_of("shipping_days").alias("average_shipping_days"))
    return present(df, " ".join(df.columns))


def ship_mode_fixed_order(book: Book) -> DataFrame:
    df = small_share(by_mode(book.orders, distinct=_NO_COUNT).groupBy("ship_mode").agg(F.sum("total_orders").alias("total_orders")),
                     {"order_share_percentage": "total_orders"})
    place = F.array_position(F.array(*[F.lit(m) for m in MODE_ORDER]), F.col("ship_mode"))
    return present(df.orderBy(F.when(place > 0, place).otherwise(len(MODE_ORDER) + 1), "ship_mode"),
                   "ship_mode total_orders order_share_percentage")


def logistics_summary(book: Book) -> DataFrame:
    return present(order_rollup(book.orders, [], _NO_COUNT), LAYOUT["logistics_summary"])


def observed_period(book: Book) -> DataFrame:
    days = book.orders.groupBy("order_year", "order_year_month").agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    return days.agg(F.min("a").alias("first_order_date"), F.max("b").alias("last_order_date"),
                    F.count_distinct("order_year").alias("observed_years"),
                    F.count_distinct("order_year_month").alias("observed_year_months"))


REPORTS = {f.__name__: f for f in (
    ship_mode_ranking, ship_mode_distribution, ship_mode_conservation, ship_mode_share_check, shipping_bands,
    shipping_day_histogram, long_shipping_orders, shipping_band_check, mode_by_band, mode_band_wide, same_day_histogram,
    mode_band_check, region_logistics, slow_regions, region_day_histogram, region_order_conservation, country_logistics,
    slow_countries, country_day_histogram, country_mode_share, country_order_conservation, annual_logistics,
    logistics_evolution, annual_mode_usage, order_year_coverage, annual_order_conservation, monthly_logistics,
    logistics_seasonality, months_by_shipping_time, calendar_coverage, calendar_size, shipping_vs_commercial,
    commercial_by_day, logistics_extremes, region_mode, slow_region_modes, country_mode, region_mode_matrix,
    region_mode_conservation, logistics_levels, date_coherence, ship_mode_fixed_order, logistics_summary, observed_period)}
