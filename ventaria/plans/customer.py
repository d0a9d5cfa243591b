"""Customer reports: ranking, segmentation, RFM, recurrence, cohorts, segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import (
    flag, mean_of, mean_of_fine, month_start, months_apart, pct, ratio, rounded)
from ventaria.functions.measures import order_rollup
from ventaria.functions.present import derive, present
from ventaria.operators.ordering import dense_ranks, small_ranks, small_share, tiles
from ventaria.operators.quadrant import against_mean, profile_order, quadrant_label
from ventaria.operators.reconcile import compare_totals, count_against, uniqueness
from ventaria.operators.scalars import attach
from ventaria.plans.book import Book, narrow
from ventaria.plans.layouts import CUSTOMER as LAYOUT
from ventaria.plans.views import CUSTOMER
from ventaria.session import settle

# Published labels.
LOSS_STATUS = ("Beneficio acumulado conocido negativo", "Presenta pedidos completos con pérdidas",
               "Sin pérdidas completas conocidas")
RECURRENCE = ("Recurrente multianual", "Recurrente dentro de un año", "Recurrente en un solo mes", "Compra única")
RFM = {"best": "Clientes de alto valor", "recent": "Clientes recientes", "loyal": "Clientes leales",
       "at_risk": "Clientes valiosos en riesgo", "inactive": "Clientes inactivos", "other": "Clientes intermedios"}

_DISPLAY = ["total_orders", "first_order_date", "last_order_date", "purchase_span_days", "distinct_locations",
            "total_order_lines", "total_product_references", "total_sales", "total_quantity", "total_profit",
            "average_complete_order_value", "comparable_profit_margin_percentage", "average_shipping_days",
            "complete_loss_making_orders", "orders_with_unknown_sales", "orders_with_unknown_profit",
            "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines"]


def _customers(book: Book) -> DataFrame:
    """Customer measures without the location count: one grouping step."""
    return order_rollup(book.orders, CUSTOMER, {})


def customer_ranking(book: Book) -> DataFrame:
    df = settle(narrow(book.customers, *CUSTOMER, *_DISPLAY))
    df = attach(df, df.agg(F.sum("total_sales").alias("_all")))
    df = df.select("*", pct("total_sales", "_all").alias("global_sales_share_percentage"))
    df = dense_ranks(df, "customer_id", {
        "profit_rank": "total_profit desc", "order_frequency_rank": "total_orders desc",
        "average_order_value_rank": "average_complete_order_value desc", "sales_rank": "total_sales desc"})
    df = df.select("*", (F.col("profit_rank") - F.col("sales_rank")).alias("sales_profit_rank_gap"))
    return present(df.orderBy("sales_rank", "customer_name", "customer_id"), LAYOUT["customer_ranking"])


def top_customers_by_sales(book: Book) -> DataFrame:
    df = _customers(book).orderBy(F.desc("total_sales"), "customer_name", "customer_id").limit(20)
    return present(df, LAYOUT["top_customers_by_sales"])


def customer_count_check(book: Book) -> DataFrame:
    seen = book.star.headers.join(book.star.lines.select("order_key"), "order_key", "left_semi")
    return count_against(book.star.customers, seen.select("customer_id").distinct(),
                         ("customers_model", "customers_analysed", "difference"))


def customer_uniqueness(book: Book) -> DataFrame:
    return uniqueness(_customers(book), ["customer_id"], "total_customers", "unique_customers", "duplicates")


def _value_frequency(book: Book, *columns: str) -> DataFrame:
    df = narrow(_customers(book), *CUSTOMER, "total_orders", "total_sales", "total_profit", *columns)
    df = tiles(settle(df.where("total_sales IS NOT NULL")), "customer_id",
               {"value_group": "total_sales asc", "frequency_group": "total_orders asc"}, 2)
    value = F.when(F.col("value_group") == 2, "Alto valor").otherwise("Bajo valor")
    often = F.when(F.col("frequency_group") == 2, "Alta frecuencia").otherwise("Baja frecuencia")
    return df.select("*", F.concat(value, F.lit(" - "), often).alias("customer_profile"))


def customer_value_frequency(book: Book) -> DataFrame:
    df = _value_frequency(book, *_DISPLAY)
    return present(df.orderBy("customer_profile", F.desc("total_sales"), "customer_name"),
                   LAYOUT["customer_value_frequency"])


def _profile_summary(df: DataFrame, by: str, extra: list[Column] = ()) -> DataFrame:
    df = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_customers"), *extra, mean_of("total_orders").alias("average_orders"),
        mean_of("total_sales").alias("average_customer_sales"), F.sum("total_sales").alias("total_sales"),
        F.sum("total_profit").alias("total_profit"))
    return small_share(df, {"sales_share_percentage": "total_sales", "customer_percentage": "total_customers"})


_SUMMARY = "average_orders average_customer_sales total_sales total_profit sales_share_percentage"


def customer_profile_summary(book: Book) -> DataFrame:
    df = _profile_summary(_value_frequency(book), "customer_profile")
    return present(df.orderBy("customer_profile"), f"customer_profile total_customers {_SUMMARY}")


def _known_sales_count(book: Book, known: bool, name: str) -> DataFrame:
    test = F.col("total_sales").isNotNull() if known else F.col("total_sales").isNull()
    return _customers(book).agg(F.count_if(test).alias(name))


def customers_without_sales(book: Book) -> DataFrame:
    return _known_sales_count(book, False, "customers_without_known_sales")


def customers_with_sales(book: Book) -> DataFrame:
    return _known_sales_count(book, True, "customers_with_known_sales")


def rfm_segment(risk_first: bool = False) -> Column:
    """Label of an RFM score.

    In the published order 'at risk' can never be reached, because 'loyal' is
    asked first; ``risk_first`` swaps the two.
    """
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    rich = (f >= 3) & (m >= 3)
    tests = [("best", rich & (r >= 3)), ("recent", (r == 4) & (f >= 2)), ("loyal", rich),
             ("at_risk", rich & (r <= 2)), ("inactive", (r <= 2) & (f <= 2))]
    if risk_first:
        tests[2], tests[3] = tests[3], tests[2]
    out = F.lit(RFM["other"])
    for name, test in reversed(tests):
        out = F.when(test, RFM[name]).otherwise(out)
    return out


def rfm_scores(customers: DataFrame) -> DataFrame:
    base = settle(customers.where("total_sales IS NOT NULL"))
    df = attach(base, base.agg(F.max("last_order_date").alias("analysis_reference_date")))
    df = df.select("*", F.date_diff("analysis_reference_date", "last_order_date").alias("recency_days"))
    return tiles(df, "customer_id", {"recency_score": "recency_days desc", "frequency_score": "total_orders asc",
                                     "monetary_score": "total_sales asc"}, 4)


def customer_rfm(book: Book) -> DataFrame:
    df = rfm_scores(narrow(_customers(book), *CUSTOMER, *_DISPLAY))
    scores = ["recency_score", "frequency_score", "monetary_score"]
    df = df.select("*", F.expr(" + ".join(scores)).alias("rfm_total_score"),
                   F.concat(*[F.col(s).cast("string") for s in scores]).alias("rfm_code"),
                   rfm_segment().alias("rfm_segment"))
    order = [F.desc("rfm_total_score"), F.desc("total_sales"), "customer_name"]
    return present(df.orderBy(*order), LAYOUT["customer_rfm"])


def customer_rfm_summary(book: Book) -> DataFrame:
    slim = narrow(_customers(book), "customer_id", "total_orders", "total_sales", "total_profit", "last_order_date")
    df = rfm_scores(slim).select("*", rfm_segment().alias("rfm_segment"))
    df = _profile_summary(df, "rfm_segment", [mean_of("recency_days").alias("average_recency_days")])
    return present(df.orderBy(F.desc("total_sales")), f"rfm_segment total_customers average_recency_days {_SUMMARY}")


def loss_status() -> Column:
    return (F.when(F.col("total_profit") < 0, LOSS_STATUS[0])
            .when(F.col("complete_loss_making_orders") > 0, LOSS_STATUS[1]).otherwise(LOSS_STATUS[2]))


def _against_mean(book: Book) -> DataFrame:
    return against_mean(narrow(_customers(book), *CUSTOMER, *_DISPLAY), known_sales_only=True)


def customer_profitability(book: Book) -> DataFrame:
    df = _against_mean(book).select("*", quadrant_label("valor", unknown_sales=True).alias("profitability_profile"),
                                    loss_status().alias("loss_status"))
    order = [profile_order("profitability_profile", "valor"), F.desc("total_sales"), "customer_name"]
    return present(df.orderBy(*order), LAYOUT["customer_profitability"])


def customer_high_sales_low_margin(book: Book) -> DataFrame:
    df = _against_mean(book).where("double(total_sales) >= sales_benchmark AND comparable_profit_margin_percentage < margin_benchmark")
    order = [F.desc("total_sales"), "comparable_profit_margin_percentage", "customer_name"]
    return present(df.orderBy(*order), LAYOUT["customer_high_sales_low_margin"])


def customer_negative_profit(book: Book) -> DataFrame:
    df = _customers(book).where("total_profit < 0")
    return present(df.orderBy("total_profit", F.desc("total_sales"), "customer_name"), LAYOUT["customer_negative_profit"])


def customer_loss_orders(book: Book) -> DataFrame:
    df = _customers(book).where("total_orders - orders_with_unknown_profit > 0 AND complete_loss_making_orders > 0")
    df = derive(df, "complete_loss_making_order_percentage")
    order = [F.desc("complete_loss_making_order_percentage"), F.desc("complete_loss_making_orders"),
             F.desc("total_sales"), "customer_name"]
    return present(df.orderBy(*order), LAYOUT["customer_loss_orders"])


def _activity(book: Book) -> DataFrame:
    """Months and years with orders: first one row per customer and month."""
    per_month = order_rollup(book.orders, [*CUSTOMER, "order_year", "order_month"], {})
    df = per_month.groupBy(*CUSTOMER).agg(
        *[F.sum(c).alias(c) for c in ("total_orders", "total_sales", "total_profit", "total_order_lines",
                                      "unknown_sales_lines", "unknown_profit_lines")],
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"),
        F.count(F.lit(1)).alias("active_months"), F.count_distinct("order_year").alias("active_years"))
    profile = (F.when(F.col("total_orders") == 1, RECURRENCE[3]).when(F.col("active_months") == 1, RECURRENCE[2])
               .when(F.col("active_years") == 1, RECURRENCE[1]).otherwise(RECURRENCE[0]))
    return df.select("*", profile.alias("recurrence_profile"),
                     F.date_diff("last_order_date", "first_order_date").alias("customer_lifetime_days"),
                     ratio("total_sales", "total_orders").alias("average_known_sales_per_order"))


def _recurrence_place() -> Column:
    return F.array_position(F.array(*[F.lit(r) for r in RECURRENCE]), F.col("recurrence_profile"))


def customer_recurrence(book: Book) -> DataFrame:
    order = [_recurrence_place(), F.desc("total_orders"), F.desc("total_sales"), "customer_name"]
    return present(_activity(book).orderBy(*order), LAYOUT["customer_recurrence"])


def customer_recurrence_summary(book: Book) -> DataFrame:
    days = mean_of("customer_lifetime_days").alias("average_customer_lifetime_days")
    df = _profile_summary(_activity(book), "recurrence_profile", [days])
    return present(df.orderBy(_recurrence_place()), "recurrence_profile total_customers customer_percentage "
                   "average_orders average_customer_lifetime_days average_customer_sales total_sales total_profit sales_share_percentage")


def repeat_customers(book: Book) -> DataFrame:
    n = F.col("total_orders")
    df = book.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_orders")).agg(
        F.count(F.lit(1)).alias("total_customers"), F.count_if(n > 1).alias("repeat_customers"),
        F.count_if(n == 1).alias("one_time_customers"))
    return df.select("*", rounded(pct("repeat_customers", "total_customers")).alias("repeat_customer_percentage"))


def _cohorts(book: Book) -> DataFrame:
    """(cohort, months since, customers): one row per customer and month, and the
    first month of a customer is the minimum over its own rows, so the base data
    is read once and there is no self-join."""
    active = book.orders.select("customer_id", month_start("order_date").alias("activity_month")).distinct()
    first = active.groupBy("customer_id").agg(F.min("activity_month").alias("cohort_month"))
    return active.join(first, "customer_id").groupBy("cohort_month", "activity_month").agg(
        F.count(F.lit(1)).alias("active_customers"))


def _cohort_table(book: Book) -> DataFrame:
    df = _cohorts(book).select("*", months_apart("cohort_month", "activity_month").alias("months_since_first_order"))
    size = F.max(F.when(F.col("months_since_first_order") == 0, F.col("active_customers")))
    return df, size


def cohort_retention(book: Book) -> DataFrame:
    df, size = _cohort_table(book)
    df = settle(df)
    sizes = df.groupBy("cohort_month").agg(size.alias("cohort_size"))
    out = df.join(sizes, "cohort_month")
    return out.select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"), "months_since_first_order", "cohort_size",
        "active_customers", rounded(pct("active_customers", "cohort_size")).alias("retention_percentage"),
    ).orderBy("cohort_month", "months_since_first_order")


def cohort_milestones(book: Book) -> DataFrame:
    """Retention after 1, 3, 6 and 12 months, only where that month was observed."""
    df, size = _cohort_table(book)
    df = settle(df)
    after = lambda m: F.max(F.when(F.col("months_since_first_order") == m, F.col("active_customers"))).alias(f"m{m}")
    wide = df.groupBy("cohort_month").agg(size.alias("cohort_size"), *[after(m) for m in (1, 3, 6, 12)])
    wide = attach(wide, df.agg(F.max("activity_month").alias("last_month")))
    wide = wide.select("*", months_apart("cohort_month", "last_month").alias("observable_months"))
    kept = [F.when(F.col("observable_months") >= m,
                   rounded(pct(F.coalesce(F.col(f"m{m}"), F.lit(0)), F.col("cohort_size"))))
            .alias(f"retention_month_{m}_percentage") for m in (1, 3, 6, 12)]
    return wide.select(F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"), "cohort_size",
                       "observable_months", *kept).orderBy("cohort_month")


def _first_months(book: Book) -> DataFrame:
    return book.orders.groupBy("customer_id").agg(month_start(F.min("order_date")).alias("cohort"))


def new_customers(book: Book) -> DataFrame:
    df = _first_months(book).groupBy("cohort").agg(F.count(F.lit(1)).alias("new_customers"))
    return df.select(F.date_format("cohort", "yyyy-MM").alias("cohort_month"), "new_customers").orderBy("cohort_month")


def cohort_check(book: Book) -> DataFrame:
    df = _first_months(book).agg(F.count(F.lit(1)).alias("customers_in_cohorts"),
                                 F.count_distinct("customer_id").alias("unique_customers"))
    df = attach(df, book.star.customers.agg(F.count(F.lit(1)).alias("customers_model")))
    return df.select("*", (F.col("customers_in_cohorts") - F.col("customers_model")).alias("difference"))


def segment_comparison(book: Book) -> DataFrame:
    """Segment measures at customer grain (margin over fully known customers)."""
    c = F.col
    known = (c("unknown_sales_lines") == 0) & (c("unknown_profit_lines") == 0)
    df = _customers(book).groupBy("segment").agg(
        F.count(F.lit(1)).alias("total_customers"), F.sum("total_orders").alias("total_orders"),
        mean_of("total_orders").alias("average_orders_per_customer"),
        F.sum("total_order_lines").alias("total_order_lines"), F.sum("total_sales").alias("total_sales"),
        mean_of("total_sales").alias("average_sales_per_customer"), F.sum("total_profit").alias("total_profit"),
        mean_of("total_profit").alias("average_profit_per_customer"),
        mean_of_fine("average_complete_order_value").alias("average_customer_order_value"),
        pct(F.sum(F.when(known, c("total_profit"))), F.sum(F.when(known, c("total_sales")))).alias("comparable_profit_margin_percentage"),
        F.sum(flag(c("total_orders") > 1)).alias("repeat_customers"),
        F.sum(flag(c("total_orders") == 1)).alias("one_time_customers"),
        F.sum(flag(F.year("first_order_date") < F.year("last_order_date"))).alias("multi_year_customers"),
        mean_of("purchase_span_days").alias("average_purchase_span_days"),
        F.sum(flag(c("total_profit") < 0)).alias("customers_with_negative_profit"),
        *[F.sum(n).alias(n) for n in ("complete_loss_making_orders", "unknown_sales_lines", "unknown_profit_lines")])
    df = df.select("*", pct("repeat_customers", "total_customers").alias("repeat_customer_percentage"),
                   pct("multi_year_customers", "total_customers").alias("multi_year_customer_percentage"),
                   pct("customers_with_negative_profit", "total_customers").alias("negative_profit_customer_percentage"))
    df = small_ranks(df, {"sales_rank": "total_sales desc", "profit_rank": "total_profit desc",
                          "customer_value_rank": "average_sales_per_customer desc"})
    return present(df.orderBy("sales_rank", "segment"), LAYOUT["segment_comparison"])


def segment_share(book: Book) -> DataFrame:
    df = _customers(book).groupBy("segment").agg(
        F.count(F.lit(1)).alias("total_customers"), F.sum("total_sales").alias("total_sales"),
        F.sum("total_profit").alias("total_profit"))
    df = small_share(df, {"customer_share_percentage": "total_customers", "sales_share_percentage": "total_sales"})
    return present(df.orderBy(F.desc("total_sales")), "segment total_customers customer_share_percentage "
                   "total_sales sales_share_percentage total_profit")


def segment_conservation(book: Book) -> DataFrame:
    customers = _customers(book)
    sums = [F.sum(c).alias(c) for c in ("total_orders", "total_sales", "total_profit")]
    n = F.count(F.lit(1)).alias("total_customers")
    segments = customers.groupBy("segment").agg(n, *sums)
    return compare_totals(customers.agg(n, *sums), segments.agg(F.sum("total_customers").alias("total_customers"), *sums), {
        "total_customers": ("customers_original", "customers_segmented", "customer_difference"),
        "total_orders": ("orders_original", "orders_segmented", "order_difference"),
        "total_sales": ("sales_original", "sales_segmented", "sales_difference"),
        "total_profit": ("profit_original", "profit_segmented", "profit_difference")})


REPORTS = {f.__name__: f for f in (
    customer_ranking, top_customers_by_sales, customer_count_check, customer_uniqueness, customer_value_frequency,
    customer_profile_summary, customers_without_sales, customers_with_sales, customer_rfm, customer_rfm_summary,
    customer_profitability, customer_high_sales_low_margin, customer_negative_profit, customer_loss_orders,
    customer_recurrence, customer_recurrence_summary, repeat_customers, cohort_retention, cohort_milestones,
    new_customers, cohort_check, segment_comparison, segment_share, segment_conservation)}
