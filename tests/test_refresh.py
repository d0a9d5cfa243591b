"""Views from signed rows against full rebuilds, and tables replaced as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from ventaria.operators import refresh as R
from ventaria.plans import refreshed as V
from ventaria.plans import views
from ventaria.sources import staging

LEDGER = R.Ledger(["k"], [("total", "v"), ("rows", "1L")], {"people": ["p"], "pairs": ["p", "q"]}, {"least": ("min", "v"), "most": ("max", "v"), "first_day": ("min", "order_date")})
SCHEMA = "k string, v int, p string, q string, order_date date"


def rows(seed, n):
    import datetime

    r = random.Random(seed)
    return [(r.choice([None, "a", "b", "c", f"k{r.randrange(4)}"]), r.choice([None, r.randrange(-5, 30)]), r.choice([None, "x", "y", "z"]), r.choice([None, "1", "2"]),
             datetime.date(2020, 1, 1) + datetime.timedelta(days=r.randrange(400))) for _ in range(n)]


def rebuilt(df):
    return df.groupBy("k").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("rows"), F.count_distinct("p").alias("people"), F.count_distinct("p", "q").alias("pairs"),
                               F.min("v").alias("least"), F.max("v").alias("most"), F.min("order_date").alias("first_day"))


def told(df):
    return sorted((tuple(r) for r in df.select("k", "total", "rows", "people", "pairs", "least", "most", "first_day").collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_ledger_after_rows_leave_and_come(spark, seed):
    old, come = rows(seed, 60), rows(seed + 50, 15)
    gone = old[:25] if seed % 2 else [x for x in old if x[0] in ("a", None)]  # whole keys vanish
    frame = lambda x: spark.createDataFrame(x, SCHEMA)
    before = frame(old).withColumn(R.SIGN, F.lit(1))
    totals, members = LEDGER.totals(before), LEDGER.members(before)
    shown = LEDGER.view(totals, members)
    assert told(shown) == told(rebuilt(frame(old)))
    kept = R.Stored(LEDGER, totals, members, shown)
    left = list(old)
    for x in gone:
        left.remove(x)
    assert told(kept.refreshed(R.signed(frame(gone), frame(come)))) == told(rebuilt(frame(left + come)))


def test_refreshed_views_equal_a_rebuild(spark, small):
    r = V.Refreshed.open(spark, small)
    later = V.Star(r.later.lines.drop("line_key"), r.later.headers, r.later.products, r.later.customers, r.later.regions)
    wanted = views.product_performance(later)
    made = V._BUILD["view_product_performance"](r)
    key = lambda df: sorted((x.product_key, x.total_orders, x.distinct_customers, x.total_sales, str(x.first_order_date)) for x in df.collect())
    assert key(made) == key(wanted)


def test_the_plan_reads_no_fact(spark, small):
    r = V.Refreshed.open(spark, small)
    for name in ("view_monthly_performance", "view_category_performance", "view_order_summary"):
        text = V._BUILD[name](r)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in text and "orders.parquet" not in text and "Cartesian" not in text


def table(spark, path):
    return sorted((tuple(x) for x in staging.read_table(spark, path).collect()), key=str)


def test_a_failing_reload_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    staging.reload_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path)
    broken = spark.range(100).select(F.expr("int(id)").alias("k"), F.expr("if(id < 99, 'x', raise_error('no'))").alias("v"))
    with pytest.raises(Exception):
        staging.reload_table(broken, path)
    assert table(spark, path) == [(1, "a"), (2, "b")]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_reload_may_read_its_own_target(spark, tmp_path):
    path = str(tmp_path / "t")
    staging.reload_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path)
    staging.reload_table(staging.read_table(spark, path).where("k = 2").withColumn("v", F.upper("v")), path)
    assert table(spark, path) == [(2, "B")]


def test_different_rows_of_one_new_key(spark, tmp_path):
    path = str(tmp_path / "t")
    staging.reload_table(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    arriving = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b"), (2, "c"), (None, "n"), (None, "m"), (3, None), (3, "q")], "k int, v string")
    staging.append_new(arriving, path, ["k"])
    assert sorted(table(spark, path), key=str) == sorted([(1, "a"), (2, "b"), (3, None), (None, "m")], key=str)
    assert sorted(table(spark, staging.refused_rows(path)), key=str) == sorted([(2, "c"), (3, "q"), (None, "n")], key=str)
    only_keys = spark.createDataFrame([(1,), (5,), (5,)], "k int")
    assert [tuple(x) for x in staging.only_new(only_keys, only_keys.where("k = 1"), ["k"]).collect()] == [(5,)]
