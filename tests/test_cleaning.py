"""Hand-made dirty rows and the results the cleaning rules must give."""

import pytest
from pyspark.sql import functions as F

from ventaria.functions.expressions import collated
from ventaria.operators import cleaning as C, profiling as P
from ventaria.sources.sales_text import COLUMNS, SCHEMA, read_raw_csv

BASE = dict(row_id="1", order_id="O1", order_date="2023-01-04", ship_date="2023-01-06", ship_mode="First Class", customer_id="A-1",
            customer_name="Ann", segment="Consumer", country="US", city="Encinitas", state="CA", postal_code="92024", region="West",
            product_id="P1", category="Furniture", sub_category="Chairs", product_name="Chair", sales="20", quantity="2", discount="0.1", profit="4")


def frame(spark, *changes):
    rows = [tuple({**BASE, "row_id": str(i + 1), **change}[c] for c in COLUMNS) for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, SCHEMA)


def cleaned(spark, *changes):
    return {r["row_id"]: r.asDict() for r in C.clean_text(frame(spark, *changes)).collect()}


def test_copies_are_dropped(spark):
    assert C.drop_copies(frame(spark, {"row_id": "1"}, {"row_id": "1"}, {"row_id": "2"})).count() == 2


def test_blank_and_padding(spark):
    row = C.blank_to_null(frame(spark, {"ship_mode": "  ", "category": " Furniture "})).first()
    assert row["ship_mode"] is None and row["category"] == "Furniture"


def test_segment_spellings(spark):
    words = ["Counsumer", "CONSUMR", "corp.", "Corperate", "home-office", "HomeOffice", "Other"]
    out = frame(spark, *[{"segment": w} for w in words]).select(C.standardise("segment", C.SEGMENT_SPELLINGS).alias("s"))
    assert [r["s"] for r in out.collect()] == ["Consumer"] * 2 + ["Corporate"] * 2 + ["Home Office"] * 2 + ["Other"]


@pytest.mark.parametrize("text,want", [
    ("2023-01-04", "2023-01-04"), ("2023-01-04 00:00:00", "2023-01-04"), ("04-Jan-2023", "2023-01-04"), ("04-JAN-2023", "2023-01-04"),
    ("03.01.2023", "2023-01-03"), ("20230106", "2023-01-06"), ("Jan 4", "Jan 4"), ("99.99.2023", None)])
def test_dates(spark, text, want):
    assert frame(spark, {"order_date": text}).select(C.normal_date("order_date")).first()[0] == want


def test_ship_mode_filled_only_from_one_known_mode(spark):
    out = cleaned(spark, {"ship_mode": None}, {}, {"order_id": "O2", "ship_mode": None}, {"order_id": "O2"}, {"order_id": "O2", "ship_mode": "Same Day"},
                  {"order_id": "O3", "ship_mode": None})
    assert [out[str(i)]["ship_mode"] for i in (1, 3, 6)] == ["First Class", None, None]


def test_discount_scale(spark):
    assert cleaned(spark, {"discount": "5.5"}, {"discount": "0.2"})["1"]["discount"] == "0.55"


def test_sales_and_quantity_from_single_price(spark):
    out = cleaned(spark, {}, {"sales": None, "quantity": "3"}, {"sales": "50", "quantity": None}, {"sales": "55", "quantity": None})
    assert float(out["2"]["sales"]) == 30 and out["3"]["quantity"] == "5" and out["4"]["quantity"] is None


def test_two_prices_recover_nothing(spark):
    out = cleaned(spark, {}, {"sales": "22"}, {"sales": None})
    assert out["3"]["sales"] is None


def test_profit_needs_two_rows_with_one_margin(spark):
    once = cleaned(spark, {}, {"profit": None, "sales": "40", "quantity": "4"})
    twice = cleaned(spark, {}, {"sales": "30", "quantity": "3", "profit": "6"}, {"profit": None, "sales": "40", "quantity": "4"})
    assert once["2"]["profit"] is None and float(twice["3"]["profit"]) == 8


def test_recovered_sales_take_part_in_margins(spark):
    rows = [{}, {"sales": None, "quantity": "3", "profit": "6"}, {"profit": None, "sales": "40", "quantity": "4"}]
    assert float(cleaned(spark, *rows)["3"]["profit"]) == 8


def with_found_maps(spark, *changes):
    tidy = C.tidy_rows(frame(spark, *changes))
    return C.complete_text(tidy, C.alias_map(tidy), C.usual_value(tidy, "postal_code", "city"))


def found(spark, *changes):
    return {r["row_id"]: r.asDict() for r in with_found_maps(spark, *changes).collect()}


def test_without_maps_people_and_towns_stay_apart(spark):
    out = cleaned(spark, {"customer_id": "A-2", "city": "San Diego"}, {"customer_id": "A-1"}, {})
    assert [out[str(i)]["customer_id"] for i in (1, 2)] == ["A-2", "A-1"] and out["1"]["city"] == "San Diego" != out["2"]["city"]


def test_alias_ids_become_the_first_seen(spark):
    out = found(spark, {"customer_id": "A-2", "order_date": "2024-01-01"}, {"customer_id": "A-1", "order_date": "2023-01-01"},
                  {"customer_id": "A-3", "order_date": "Jan 4"}, {"customer_name": "Bob", "customer_id": "B-1"})
    assert [out[str(i)]["customer_id"] for i in range(1, 5)] == ["A-1", "A-1", "A-1", "B-1"]


def test_one_id_that_is_an_alias_under_two_names(spark):
    """Each name has its own canonical id, and no row is doubled."""
    rows = [{"customer_name": n, "customer_id": i, "order_date": d} for n, i, d in (
        ("X", "B", "2023-01-01"), ("X", "A", "2023-02-01"), ("Y", "C", "2023-01-01"), ("Y", "A", "2023-02-01"))]
    text = with_found_maps(spark, *rows).collect()
    assert sorted((r["row_id"], r["customer_id"]) for r in text) == [("1", "B"), ("2", "B"), ("3", "C"), ("4", "C")]


def test_one_city_per_postal_code(spark):
    out = found(spark, {}, {}, {"city": "San Diego"}, {"postal_code": "1", "city": "X"})
    assert [out[str(i)]["city"] for i in range(1, 5)] == ["Encinitas"] * 3 + ["X"]


def test_given_maps_are_used(spark):
    aliases = spark.createDataFrame([("Ann", "A-9", "A-1")], "_name string, _alias string, _canonical string")
    cities = spark.createDataFrame([("92024", "Leucadia")], "_key string, _usual string")
    row = C.clean_text(frame(spark, {"customer_id": "A-9"}), aliases, cities).first()
    assert (row["customer_id"], row["city"]) == ("A-1", "Leucadia")


def test_typed_load_and_quarantine(spark):
    text = frame(spark, {"quantity": "2.6"}, {"discount": "1.5"}, {"ship_date": "2023-01-01", "segment": "Retail"}, {"order_date": "Jan 4"},
                 {"sales": None, "quantity": None, "profit": None, "ship_mode": None}, {"row_id": "1"}, {"sales": "-1"})
    loaded = C.load(text)
    assert [r["row_id"] for r in loaded.valid.collect()] == [5]
    broken = {}
    for r in loaded.quarantine.collect():
        broken.setdefault(r["row_id"], []).append(sorted(r["broken_rules"]))
    assert broken[2] == [["discount_range"]] and broken[3] == [["segment_domain", "ship_before_order"]]
    assert broken[4] == [["order_date_missing"]] and broken[7] == [["sales_not_positive"]] and broken[1] == [["row_id_repeated"]] * 2
    assert C.typed(text).where("row_id = 1 AND quantity = 3").count() == 1  # rounds, does not cut


def test_unreadable_measures_and_broken_records_are_rejected(spark, tmp_path):
    text = frame(spark, {"sales": "12,50"}, {"quantity": "two"}, {"profit": "abc", "sales": "1e99"}, {})
    loaded = C.load(text)
    assert [r["row_id"] for r in loaded.valid.collect()] == [4]
    assert {r["row_id"]: r["broken_rules"] for r in loaded.quarantine.collect()} == {
        1: ["sales_unreadable"], 2: ["quantity_unreadable"], 3: ["sales_unreadable", "profit_unreadable"]}
    assert sorted((r["row_id"], r["measure"], r["found"]) for r in C.rejected_casts(text).collect()) == [
        ("1", "sales", "12,50"), ("2", "quantity", "two"), ("3", "profit", "abc"), ("3", "sales", "1e99")]
    good = [str(v) for v in frame(spark, {}).first()]
    lines = [",".join(good), ",".join(["2", *good[1:], "surplus"]), ",".join(["3", *good[1:-1]]), ",".join(["4", *good[1:]])]
    (tmp_path / "x.csv").write_text("\n".join([",".join(frame(spark, {}).columns), *lines]))
    read = C.load(read_raw_csv(spark, str(tmp_path / "x.csv")))
    assert [r["row_id"] for r in read.valid.collect()] == [1, 4] or {r["row_id"] for r in read.valid.collect()} == {1, 4}
    assert all("corrupt_record" in r["broken_rules"] for r in read.quarantine.collect()) and read.quarantine.count() == 2
    assert read.valid.columns == frame(spark, {}).columns


def test_rows_that_would_double_a_model_key_are_kept_out(spark):
    text = frame(spark, {}, {"sub_category": "Other"}, {"order_id": "O-2", "customer_id": "Q", "product_id": "P-2"},
                 {"order_id": "O-3", "customer_id": "Q", "customer_name": "Zoe", "product_id": "P-3"},
                 {"order_id": "O-4", "product_id": "P-4", "ship_mode": "Same Day"}, {"order_id": "O-4", "product_id": "P-5", "ship_mode": None},
                 {"order_id": "O-5", "product_id": "P-6"})
    loaded = C.load(text)
    assert [r["row_id"] for r in loaded.valid.collect()] == [7]
    assert {r["row_id"]: r["broken_rules"] for r in loaded.quarantine.collect()} == {
        1: ["product_conflict"], 2: ["product_conflict"], 3: ["customer_conflict"], 4: ["customer_conflict"], 5: ["order_conflict"], 6: ["order_conflict"]}


def test_profile_counts(spark):
    df = frame(spark, {"sales": None, "city": " "}, {"sales": "x"}, {})
    assert P.null_counts(df, ["sales"]).first()["sales_null"] == 1
    assert P.blank_counts(df, ["city"]).first()["city_blank"] == 1
    assert P.violations(df, {"bad": ~F.col("sales").rlike(P.SIGNED_NUMBER)}).first()["bad"] == 1
    found = P.distinct_counts(df, {"row_id": "n"}, approximate=0.05).first()["n"]
    assert 2 <= found <= 4


def test_collation_option(spark):
    df = spark.createDataFrame([("Ana ",), ("ANA",), ("aná",)], "name string")
    assert df.distinct().count() == 3 and collated(df, ["name"]).distinct().count() == 1


def test_days_are_cast_as_the_format_reads_them(spark):
    texts = ["2023-01-04", "2023-02-29", "2024-02-29", "0000-01-01", "0001-01-01", "2023-1-4", "2023-01-4", " 2023-01-04", "2023-01-04 ", "2023-01-04\n", "2023-01-0\n", "2023-01-04T00",
             "+2023-01-04", "-2023-01-04", "12023-01-04", "2023-13-01", "2023-00-10", "2023-01-00", "99.99.2023", "Jan 4", "", "9999-12-31", "1000-10-05", "1582-10-10", None]
    df = spark.createDataFrame([(t,) for t in texts], "order_date string")
    found = df.select("order_date", F.expr(C.CASTS["order_date"]).cast("string").alias("a"), F.try_to_date("order_date", "yyyy-MM-dd").cast("string").alias("b"))
    assert [(r[0], r["a"]) for r in found.collect()] == [(r[0], r["b"]) for r in found.collect()]
