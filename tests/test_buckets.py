"""Wide rows that stay in the buckets of their order: the same rows as by moving them, and no exchange of theirs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ventaria.operators import changelog as L, cleaning as C, heavy, profiling as P, refresh as R
from ventaria.operators.heavy import join_lookup
from ventaria.operators.normalise import product_code, shared_codes, with_product
from ventaria.operators.ordering import number_rows
from ventaria.plans.quality import Sheets
from ventaria.plans.refreshed import HOME, Refreshed, keyed_lines, later_lines
from ventaria.plans.views import sales_detail
from ventaria.session import OPEN_FILES, by_key, parted_by_one, settle_by
from ventaria.sources.sales_text import COLUMNS, raw_sales
from ventaria.sources.staging import arrivals, contradictory, only_new
from ventaria.sources.tpch import Star


def exchanges(df) -> int:
    with parted_by_one(df.sparkSession):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def told(df) -> list[str]:
    return sorted(map(str, df.collect()))


def line(n: int, order: str | None, **known: str | None) -> tuple:
    row = dict(row_id=str(n), order_id=order, order_date="2020-01-02", ship_date="2020-01-05", ship_mode="First Class", customer_id="C1",
               customer_name="Ann", segment="Consumer", country="X", city="Y", state="Z", postal_code="1", region="R", product_id="P1",
               category="Furniture", sub_category="B", product_name="chair", sales="20.0", quantity="2", discount="0.1", profit="4.0")
    return tuple({**row, **known}[c] for c in COLUMNS)


@pytest.fixture
def tidy(spark):
    rows = [line(n, f"O{n % 4}", ship_mode=None if n % 3 else "First Class", customer_id=f"C{n % 2}") for n in range(12)]
    rows += [line(20, "O1", sales=None), line(21, "O1", quantity=None), line(22, "O2", profit=None), line(23, None, sales=None), line(24, None, ship_mode=None),
             line(25, "O9", ship_mode=None, profit=None), line(26, "O9", product_id=None, sales=None), line(27, "O9", discount=None, profit=None),
             line(28, "O8", customer_name=None, city="Y2"), line(20, "O7"), line(29, "O8", sales="x", profit=None), line(30, "O8", sales=None, quantity=None, profit=None)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))


def test_rows_in_buckets_are_completed_and_judged_like_moved_rows(spark, tidy):
    home = settle_by(by_key(tidy, "order_id"), "order_id")
    text = [C.complete_text(df, C.alias_map(df), C.usual_value(df, "postal_code", "city"), key) for df, key in ((tidy, None), (home, "order_id"))]
    assert told(text[0]) == told(text[1])
    judged = [C.split_by_rules(C.typed(df), home=key) for df, key in ((text[0], None), (settle_by(text[1], "order_id"), "order_id"))]
    assert told(judged[0]) == told(judged[1])
    assert judged[1].where(F.array_contains("broken_rules", "row_id_repeated")).count() == 2


def test_faults_told_with_the_text_are_not_told_again(spark, tidy):
    odd = [line(40, "O1", segment="Retail", sales="y", quantity="0"), line(41, "O5", order_date="2020-02-30"), line(20, "O6", discount="2", profit="z"),
           line(42, "O5", ship_date="2019-12-31"), line(43, "O5", category=None, ship_mode="Boat"), line(44, "O2", segment="Corporate")]
    text = tidy.unionByName(spark.createDataFrame(odd, tidy.schema))
    written = settle_by(by_key(C.row_faults(text), "order_id"), "order_id")
    assert told(written.drop(C.UNREADABLE, C.RULES)) == told(text)
    judged = C.split_by_rules(C.typed(written), home="order_id")
    assert told(judged) == told(C.split_by_rules(C.typed(text)))
    assert "segment_domain" not in judged._jdf.queryExecution().optimizedPlan().toString()
    broken = {r["row_id"]: r["broken_rules"] for r in judged.where("row_id >= 40 OR row_id = 20 AND order_id = 'O6'").collect()}
    assert broken[40] == ["segment_domain", "quantity_not_positive", "sales_unreadable"]
    assert broken[20] == ["discount_range", "row_id_repeated", "profit_unreadable"]
    assert broken[43] == ["category_missing", "ship_mode_domain"]


def test_lists_of_faults_are_made_in_compiled_code(spark, tidy):
    plan = C.row_faults(tidy)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan


def test_a_task_that_writes_few_buckets_does_not_sort_them(spark, tidy):
    ordered = tidy.coalesce(1).where("order_id IS NOT NULL").orderBy(F.desc("row_id")).coalesce(1)
    few = ordered.where("order_id IN ('O1', 'O2')")
    assert len({r[0] for r in few.select("order_id").distinct().collect()}) <= OPEN_FILES
    kept = settle_by(few, "order_id")
    assert told(kept) == told(few)
    for order in ("O1", "O2"):
        ids = [r["row_id"] for r in kept.where(F.col("order_id") == order).coalesce(1).collect()]
        assert ids == [r["row_id"] for r in few.where(F.col("order_id") == order).collect()]
    many = spark.range(5000).selectExpr("id", "string(id % 700) AS k").coalesce(1)  # more buckets than a task holds open
    assert settle_by(many, "k").agg(F.count("id"), F.sum("id"), F.count_distinct("k")).first() == many.agg(F.count("id"), F.sum("id"), F.count_distinct("k")).first()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


@pytest.mark.parametrize("match", [{"customer_name": "_n", "customer_id": "_i"}, {"order_id": "_n", "city": "_i"}])
def test_a_large_lookup_comes_to_the_rows(spark, tidy, match):
    home = settle_by(by_key(tidy, "order_id"), "order_id")
    keys = list(match)
    lookup = tidy.select(*keys).dropna().distinct().where(F.col(keys[0]) != "O3").select(*[F.col(c).alias(m) for c, m in match.items()], F.lit("v").alias("_v"))
    fetched = join_lookup(home, lookup, match, most_bytes=0, home="order_id")
    assert told(fetched) == told(join_lookup(tidy, lookup, match))


def test_a_large_lookup_leaves_completed_rows_in_their_buckets(spark, tidy, monkeypatch):
    monkeypatch.setattr(heavy, "bytes_of", lambda lookup: 1 << 40)
    home = settle_by(by_key(tidy, "order_id"), "order_id")
    maps = [(C.alias_map(df), C.usual_value(df, "postal_code", "city")) for df in (tidy, home)]
    placed = C.replace_by_map(home.where("order_id IS NOT NULL"), "customer_id", maps[1][0], "_canonical", {"customer_name": "_name", "customer_id": "_alias"}, "order_id")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    assert told(C.complete_text(tidy, *maps[0])) == told(C.complete_text(home, *maps[1], "order_id"))


def test_a_group_of_buckets_moves_nothing(spark, tidy):
    home = settle_by(by_key(tidy, "order_id"), "order_id")
    assert exchanges(home.groupBy("order_id").agg(F.max("ship_mode"))) == 0


def test_the_sheets_lie_in_buckets_of_their_order(spark, small):
    sheets = Sheets.open(spark, small)
    for rows in (sheets.tidy, sheets.text, sheets.judged):
        assert exchanges(rows.groupBy("order_id", "customer_id").agg(F.count(F.lit(1)))) == 0


ARRIVING = [(1, "z", None), (2, "c", 1), (2, "b", 2), (2, "c", 1), (None, "n", 1), (None, "m", 1), (3, None, 1), (3, "q", 1), (4, "x", 5), (4, "x", 5)]


@pytest.mark.parametrize("have", [[], [(1, "a", 1)], [(None, "a", 1), (4, "y", None)]])
def test_arrivals_are_the_new_rows_and_the_contradictory_ones(spark, have):
    schema = "k int, v string, w int"
    arriving, existing = spark.createDataFrame(ARRIVING, schema), spark.createDataFrame(have, schema)
    found = arrivals(arriving, existing, ["k"])
    assert told(found.where("_taken").drop("_taken")) == told(only_new(arriving, existing, ["k"]))
    assert told(found.where("NOT _taken").drop("_taken")) == told(contradictory(arriving, existing, ["k"]))


def test_arriving_rows_move_once(spark):
    arriving = spark.createDataFrame(ARRIVING, "k int, v string, w int")
    assert exchanges(arrivals(arriving, arriving.where("k = 1"), ["k"]).groupBy("k").agg(F.count_if("_taken"))) == 1


def test_cells_and_headers_of_the_refreshed_views_lie_in_buckets_of_their_order(spark, small):
    r = Refreshed.open(spark, small)
    for rows in (r.cells, r.headers, r.orders, *r._touched):
        assert exchanges(rows.groupBy("order_key").agg(F.count(F.lit(1)))) == 0


def test_the_logs_compare_lines_and_orders_in_their_buckets(spark, small):
    r = Refreshed.open(spark, small)
    assert exchanges(keyed_lines(r.star)) == 1
    assert exchanges(r.line_log) == 0
    assert exchanges(r.order_log) == 1  # of the orders added under other keys
    lines = keyed_lines(r.star)
    whole = L.change_log(lines.drop(HOME), later_lines(lines).drop(HOME), "line_key", "order_details", changed_by="x")
    shown = ["table_name", "record_key", "action_type", "old_data", "new_data"]
    assert told(r.line_log.select(*shown)) == told(whole.select(*shown))
    whole = L.change_log(r.star.headers, r.later.headers, "order_key", "orders", changed_by="x")
    assert told(r.order_log.select(*shown)) == told(whole.select(*shown))


def test_keys_of_lines_with_unknown_parts_meet_in_one_home(spark):
    rows = [(1, 5, None), (1, None, 5), (2, 5, None), (3, None, None), (3, None, None), (4, 7, 5), (4, 7, 5), (5, 1, 9), (6, 11, 9), (6, -5, 3)]
    lines = spark.createDataFrame([(o, p, s, None, n, None, None) for n, (o, s, p) in enumerate(rows)],
                                  "order_key long, product_key long, source_row_id long, sales decimal(15,6), quantity int, discount decimal(4,2), profit decimal(15,6)")
    keyed = keyed_lines(Star(lines, None, None, None, None))
    assert keyed.where(F.col(HOME).isNull()).count() == 0
    assert keyed.groupBy("line_key").agg(F.count_distinct(HOME).alias("n")).where("n > 1").count() == 0
    logs = [L.change_log(a, later_lines(a) if h else later_lines(keyed).drop(HOME), "line_key", "t", "x", home=h).select("record_key", "action_type", "old_data", "new_data")
            for a, h in ((keyed.drop(HOME), None), (keyed, HOME))]
    assert told(logs[0]) == told(logs[1])


def test_stored_rows_and_changes_add_up_in_their_buckets(spark):
    rows = spark.createDataFrame([(k % 5, k % 3, 1, k, 1) for k in range(30)], "order_key long, product_key long, _rows long, total_order_lines long, _known_total_order_lines long")
    ledger = R.Ledger(["order_key", "product_key"], [("total_order_lines", "1L")])
    parts = [rows, rows.where("order_key = 2").withColumn("_rows", F.lit(-1).cast("long"))]
    kept = [settle_by(by_key(df, "order_key"), "order_key") for df in parts]
    found = ledger.merged(*kept, False, "order_key").select(*rows.columns)
    assert exchanges(found) == 0
    assert told(found) == told(ledger.merged(*parts, False).select(*rows.columns)) and found.count() == 12


def test_the_touched_orders_are_named_once(spark, small):
    r = Refreshed.open(spark, small)
    assert r._touched[0].groupBy("order_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").count() == 0
    assert len(r._touched[0].collect()) == len({x["order_key"] for x in r._touched[0].collect()})


def test_conflicts_of_several_attributes_move_no_row_of_a_bucket(spark):
    rows = [("a", "1", "x"), ("a", "2", None), ("b", "1", "x"), ("b", "1", None), ("c", None, "x"), ("c", None, "y"), ("c", "3", "z"), (None, "1", "x"), (None, "2", "y"), ("d", None, None)]
    df = spark.createDataFrame(rows, "k string, u string, v string")
    found = P.fd_conflicts(settle_by(by_key(df, "k"), "k"), ["k"], ["u", "v"])
    assert told(found) == told(spark.createDataFrame([("a", 2, 1), ("c", 1, 3)], "k string, total_u long, total_v long"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("Expand")  # below: only conflicting keys are written several times


def moved(df) -> list[tuple[str, str]]:
    """Each exchange by hash, where no table is broadcast, and the step below it."""
    df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        df.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return [(one, below) for one, below in zip(plan, plan[1:]) if "Exchange hashpartitioning" in one]


def test_the_order_text_does_not_travel_with_the_lines(spark, small):
    lines, = (below for _, below in moved(raw_sales(spark, small)) if "l_orderkey" in below and "p_name" in below)
    assert "concat" not in lines


def test_raw_lines_lie_where_their_order_is_grouped(spark, small):
    found = [one for one, _ in moved(by_key(raw_sales(spark, small), "order_id").dropDuplicates())]
    assert not any("order_id" in one for one in found) and sum("concat(OR-" in one for one in found) == 2


CONFLICTS = [("a", "1", "x"), ("a", "1", None), ("b", "1", "x"), ("b", "1", "x"), ("c", None, None), ("c", None, None), (None, "1", "x"), (None, "2", "x"),
             ("d", "1", "y"), ("d", "2", "y"), ("e", None, "x")]


def test_conflicting_keys_are_counted_without_sorting_texts(spark):
    df = spark.createDataFrame(CONFLICTS, "k string, u string, v string")
    found = C.conflicting_keys(df, ["k"], ["u", "v"])
    assert told(found) == told(spark.createDataFrame([("a",), (None,), ("d",)], "k string"))
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


GOODS = [("P1", "chair"), ("P1", "sofa"), ("P2", "chair"), ("P3", None), (None, "lamp"), ("P4", "desk")]


@pytest.mark.parametrize("code", [product_code, lambda ident, name: F.when(F.col(ident).isNotNull() & F.col(name).isNotNull(), F.length(name).cast("long"))])
def test_rows_meet_products_by_number(spark, code):
    rows = spark.createDataFrame([(n, *g) for n, g in enumerate(GOODS * 2)], "n int, product_id string, product_name string")
    products = spark.createDataFrame([(1, "P1", "chair"), (2, "P1", "sofa"), (3, "P2", "chair")], "product_key int, source_product_id string, product_name string")
    shared = shared_codes(rows, code)
    assert bool(shared) == (code is not product_code)
    met = with_product(rows, products, shared, code).select("n", "product_key")
    plain = rows.alias("r").join(products.alias("p"), F.expr("r.product_id = p.source_product_id AND r.product_name = p.product_name")).select("n", "product_key")
    if not shared:
        below, = (below for one, below in moved(met) if "hashpartitioning(_code#" in one)
        assert "product_name" not in re.sub("CASE WHEN .* END", "", below)
    assert told(met) == told(plain)


def test_numbered_rows_know_their_size(spark):
    df = spark.range(1000).selectExpr("string(id % 17) AS v", "id")
    placed = number_rows(df, "v, id", position="at")
    assert "Join" not in placed._jdf.queryExecution().optimizedPlan().toString()
    assert [r["at"] for r in placed.orderBy("v", "id").collect()] == list(range(1, 1001))


def test_wide_headers_are_moved_by_one_join_only(spark):
    lines = spark.createDataFrame([(1, 1, 1, 1.0, 1, 0.1, 1.0)], "order_key long, product_key long, source_row_id long, sales double, quantity int, discount double, profit double")
    names = ["order_id", "order_date", "ship_date", "shipping_days", "ship_mode", "customer_id", "customer_name", "segment", "country", "state", "city", "postal_code", "region"]
    headers = spark.createDataFrame([(1, *names)], "order_key long, " + ", ".join(f"{c} string" for c in names))
    products = spark.createDataFrame([(1, "P", "n", "c", "s")], "product_key long, product_id string, product_name string, category string, sub_category string")
    df = sales_detail(Star(lines, headers, products, headers, headers))
    assert df.count() == 1
    assert [re.search(r"\((\w+)#", one).group(1) for one, _ in moved(df)] == ["order_key", "product_key", "product_key", "order_key"]
