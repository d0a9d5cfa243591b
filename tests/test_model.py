"""Normalisation keeps every row and every unknown; views agree over both forms."""

import datetime as dt
from decimal import Decimal

import pytest

from ventaria.operators.normalise import extend, normalise, star_of
from ventaria.operators.reconcile import count_unmatched, unmatched
from ventaria.plans import views
from ventaria.plans.quality import Sheets
from ventaria.sources import staging

KINDS = ("row_id long, order_id string, order_date date, ship_date date, ship_mode string, customer_id string, customer_name string, "
         "segment string, country string, city string, state string, postal_code string, region string, product_id string, category string, "
         "sub_category string, product_name string, sales decimal(15,6), quantity long, discount decimal(4,2), profit decimal(15,6)")


def row(i, order="O1", mode="First Class", customer="A", city="X", code="P1", name="Chair", sales="10", profit="1", quantity=1):
    money = lambda v: None if v is None else Decimal(v)
    return (i, order, dt.date(2023, 1, 4), dt.date(2023, 1, 6), mode, customer, f"n{customer}", "Consumer", "US", city, "CA", "9", "West",
            code, "Furniture", "Chairs", name, money(sales), quantity, Decimal("0.10"), money(profit))


@pytest.fixture(scope="module")
def model(spark):
    clean = spark.createDataFrame([
        row(1), row(2, name="Sofa"), row(3, order="O2", mode=None, sales=None), row(4, order="O2", mode=None, city="Y", profit=None),
        row(5, order="O2", mode=None, city="Y", quantity=None, customer="B")], KINDS)
    return normalise(clean)


def test_one_code_two_names_are_two_products(model):
    assert sorted((r["product_key"], r["product_name"]) for r in model.products.collect()) == [(1, "Chair"), (2, "Sofa")]


def test_one_order_id_over_places_and_customers(model):
    assert model.orders.where("source_order_id = 'O2'").count() == 3


def test_details_attach_when_mode_is_unknown(model):
    assert model.order_details.count() == 5
    assert model.ship_modes.count() == 1 and model.orders.where("ship_mode_id IS NULL").count() == 3


def test_keys_are_dense(model):
    for df, key in ((model.orders, "order_key"), (model.locations, "location_id"), (model.order_details, "order_detail_key")):
        assert sorted(r[0] for r in df.select(key).collect()) == list(range(1, df.count() + 1))


def test_unknown_stays_unknown(model):
    orders = views.order_summary(star_of(model))
    total = orders.where("order_id = 'O2' AND city = 'X'").first()
    assert total["total_sales"] is None and total["unknown_sales_lines"] == 1
    modes = {r["ship_mode"]: r["total_orders"] for r in views.ship_mode_performance(orders).collect()}
    assert modes == {"First Class": 1, "Unknown": 3}


def test_extend_keeps_keys_and_adds_new(spark, model):
    more = spark.createDataFrame([("West",), ("East",), ("North",)], "region_name string")
    out = extend(model.regions, more, "region_id", ["region_name"], "region_name")
    assert sorted((r["region_id"], r["region_name"]) for r in out.collect()) == [(1, "West"), (2, "East"), (3, "North")]


def test_unmatched_reports_disagreement(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    target = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "k int, v string")
    assert [r["k"] for r in unmatched(source, target, ["k"], ["v"]).collect()] == [2]


@pytest.mark.parametrize("agree", [["v"], []])
def test_unmatched_rows_are_folded_before_they_are_compared(spark, agree):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (2, None), (3, None), (4, "c"), (4, "c"), (None, "a"), (None, "a")], "k int, v string")
    target = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (None, "a")], "k int, v string")
    found = count_unmatched(source, target, ["k"], agree)
    assert found.first()["unmatched"] == unmatched(source, target, ["k"], agree).count() == (7 if agree else 4)
    assert count_unmatched(source.where("k = 1"), target, ["k"], agree).first()["unmatched"] == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("count(1)")


def test_views_over_the_normalised_tables(spark, small):
    sheets = Sheets.open(spark, small)
    star = star_of(sheets.model)
    assert views.sales_detail(star).count() == sheets.clean.count()
    orders = views.order_summary(star)
    got = orders.agg({"total_sales": "sum", "total_profit": "sum", "total_order_lines": "sum"}).first()
    want = sheets.clean.agg({"sales": "sum", "profit": "sum", "row_id": "count"}).first()
    assert (got["sum(total_sales)"], got["sum(total_profit)"], got["sum(total_order_lines)"]) == (want["sum(sales)"], want["sum(profit)"], want["count(row_id)"])


def test_reload_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for _ in range(2):
        staging.reload_table(df, path)
    staging.append_new(spark.createDataFrame([(2, "z"), (3, "c")], "k int, v string"), path, ["k"])
    assert sorted(tuple(r) for r in staging.read_table(spark, path).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert staging.load_check(df, 2, 2).first()["status"] == "OK" and staging.load_check(df, 3, 2).first()["status"] == "REVISAR"
    staging.register_views({"stage_t": df})
    assert spark.sql("SELECT count(*) FROM stage_t").first()[0] == 2
