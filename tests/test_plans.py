"""Shape of the physical plans."""

import pytest

from __spark_entry__ import entry, queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


HEAVY = ["view_order_summary", "view_product_performance", "view_customer_performance", "product_ranking", "city_abc", "customer_rfm",
         "product_quadrant", "period_top_products", "category_discount_bands", "cohort_retention", "order_change_log", "business_overview"]


@pytest.mark.parametrize("name", [n for n in HEAVY if n in queries()])
def test_no_nested_loop_or_cartesian_join(spark, small, name):
    text = plan(queries()[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["product_ranking", "product_pareto", "customer_rfm", "city_ranking", "city_loss_concentration"])
def test_large_grains_never_sort_in_one_task(spark, small, name):
    """Only aggregated one-row-per-slice frames may meet in a single partition."""
    from pyspark.sql import DataFrame
    seen = []
    import ventaria.operators.ordering as ordering
    keep = ordering.settle

    def spy(df: DataFrame) -> DataFrame:
        seen.append(plan(df))
        return keep(df)

    ordering.settle = spy
    try:
        queries()[name](spark, small)
    finally:
        ordering.settle = keep
    assert seen and all("rangepartitioning" in text for text in seen)
    windows = [part for text in seen for part in text.split("Window ")[1:]]
    assert windows and all("_slice" in part.split("\n")[0] for part in windows)


def test_scan_reads_only_needed_columns(spark, small):
    text = plan(queries()["product_observed_years"](spark, small))
    line = next(part for part in text.split("FileScan parquet ") if part.startswith("[l_orderkey"))
    assert line.startswith("[l_orderkey#") and "l_extendedprice" not in line.split("]")[0]


def test_period_filter_reaches_the_order_scan(spark, small):
    text = plan(queries()["period_sales_summary_1997"](spark, small))
    assert "1997-01-01" in text.split("o_orderdate")[-1] or "PushedFilters: [IsNotNull(o_orderdate)" in text


def test_entry(spark):
    assert entry(spark).count() > 0
