"""Invariants, edge rows and argument errors of the reports."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ventaria.functions.expressions import discount_band, growth, pct, shipping_band
from ventaria.operators.concentration import abc_class, cumulate, milestones
from ventaria.operators.growth import with_previous
from ventaria.plans import customer, period
from ventaria.plans.book import Book


@pytest.fixture(scope="module")
def book(spark, small):
    return Book.open(spark, small)


@pytest.mark.parametrize("call", [
    lambda b: period.period_sales_summary(b, "1998-12-31", "1998-01-01"),
    lambda b: period.period_sales_summary(b, start="2300-01-01"),
    lambda b: period.period_sales_summary(b, end="1900-01-01"),
    lambda b: period.period_category_performance(b, category="Categoria Inventada"),
    lambda b: period.period_geographic_performance(b, region="Region Inventada"),
    lambda b: period.period_geographic_performance(b, country="Nowhere"),
    lambda b: period.period_logistics_performance(b, ship_mode="Entrega Teletransportada"),
    lambda b: period.period_top_products(b, n=0),
    lambda b: period.period_top_customers(b, n=1001),
])
def test_bad_arguments(book, call):
    with pytest.raises(ValueError):
        call(book)


def test_one_day_period_has_inclusive_bounds(book):
    day = book.orders.agg(F.max("order_date")).first()[0]
    row = period.period_sales_summary(book, day, day).first()
    assert row["first_observed_order_date"] == row["last_observed_order_date"] == day and row["total_orders"] >= 1


def test_top_n_is_respected(book):
    assert period.period_top_customers(book, n=7).count() == 7


def test_bands(spark):
    values = [Decimal(v) for v in ("0", "0.01", "0.10", "0.20", "0.30", "0.50", "0.51")]
    df = spark.createDataFrame([(v,) for v in values], "d decimal(4,2)").select(discount_band("d")[1].alias("p"))
    assert [r["p"] for r in df.collect()] == [1, 2, 2, 3, 4, 5, 6]
    days = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 4, 5, 7, 8)], "d int").select(shipping_band("d")[0].alias("b"))
    assert [r["b"] for r in days.collect()] == ["Mismo día", "1-2 días", "1-2 días", "3-4 días", "3-4 días", "5-7 días", "5-7 días", "8+ días"]


def test_ratio_of_zero_and_unknown(spark):
    row = spark.range(1).select(pct(F.lit(1), F.lit(0)).alias("z"), pct(F.lit(None).cast("int"), F.lit(2)).alias("u"), growth(F.lit(3), F.lit(2)).alias("g")).first()
    assert row.asDict() == {"z": None, "u": None, "g": 50.0}


def test_previous_is_the_last_available_year(spark):
    df = spark.createDataFrame([("a", 2020, 1), ("a", 2022, 5), ("b", 2021, 2)], "k string, y int, v int")
    got = {(r["k"], r["y"]): r["p"] for r in with_previous(df, ["y"], {"p": "v"}, ("k",)).collect()}
    assert got == {("a", 2020): None, ("a", 2022): 1, ("b", 2021): None}


def test_one_item_above_the_limit_is_never_class_a(spark):
    df = spark.createDataFrame([("x", Decimal(90)), ("y", Decimal(10)), ("z", None)], "k string, total_sales decimal(15,6)")
    out = cumulate(df, "total_sales", "k", position="n", share="s", cumulative="c").select("k", "n", abc_class(F.col("c")).alias("cls"))
    assert {r["k"]: (r["n"], r["cls"]) for r in out.collect()} == {"x": (1, "B"), "y": (2, "C"), "z": (3, "C")}


def test_milestones(spark):
    df = spark.createDataFrame([(i, Decimal(10)) for i in range(10)], "k int, total_sales decimal(15,6)")
    out = cumulate(df, "total_sales", "k", position="n", share="s", cumulative="c")
    assert tuple(out.agg(*milestones(out, "c", "n", ["a", "b", "z"])).first()) == (5, 8, 10)


def test_rfm_label_order(spark):
    score = spark.createDataFrame([(1, 4, 4), (4, 2, 1), (3, 3, 3), (1, 1, 4), (3, 1, 4)], "recency_score int, frequency_score int, monetary_score int")
    labels = lambda **a: [r[0] for r in score.select(customer.rfm_segment(**a)).collect()]
    assert labels() == ["Clientes leales", "Clientes recientes", "Clientes de alto valor", "Clientes inactivos", "Clientes intermedios"]
    assert labels(risk_first=True)[0] == "Clientes valiosos en riesgo"


def test_young_cohort_is_unknown_not_zero(spark):
    orders = spark.createDataFrame([("a", dt.date(2023, 1, 5)), ("a", dt.date(2023, 2, 1)), ("b", dt.date(2023, 2, 7))], "customer_id string, order_date date")
    stub = type("Stub", (), {"orders": orders})()
    rows = {r["cohort_month"]: r for r in customer.cohort_milestones(stub).collect()}
    assert rows["2023-01"]["retention_month_1_percentage"] == 100.0 and rows["2023-01"]["retention_month_3_percentage"] is None
    assert rows["2023-02"]["retention_month_1_percentage"] is None


def test_shares_add_up(book):
    from ventaria.plans import category, geography
    assert category.category_share_totals(book).first()["sales_share_total"] == 100.0
    assert geography.city_share_check(book).first()["total_sales_share_percentage"] == 100.0
