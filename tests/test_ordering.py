"""Distributed ranks, totals and tiles against plain windows, with heavy skew."""

import random

import pytest
from pyspark.sql import Window, functions as F

from ventaria.operators import ordering
from ventaria.operators.ordering import dense_ranks, number_rows, sort_key, tiles


pytestmark = pytest.mark.usefixtures("many_slices")


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the values equal, a third unknown; one group holds most rows."""
    rng = random.Random(3)
    data = []
    for i in range(3000):
        kind = i % 3
        value = 7 if kind == 0 else None if kind == 1 else rng.randint(-50, 400)
        data.append((i, "hot" if i % 4 else f"g{i % 37}", value))
    return spark.createDataFrame(data, "id int, g string, v int").repartition(7).cache()


def test_rows_really_cross_slices(rows, monkeypatch):
    seen = []
    keep = ordering.settle
    monkeypatch.setattr(ordering, "settle", lambda df: seen.append(keep(df)) or seen[-1])
    number_rows(rows, "v desc, id", position="p").count()
    assert seen[0].select(ordering.SLICE).distinct().count() >= 6


def collect(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("partition", [(), ("g",)])
def test_rank_position_total_previous(rows, direction, partition):
    got = number_rows(rows, f"v {direction}, id", partition=partition, position="p", dense_rank="d", running=("v", "s"), previous=("v", "b"))
    w = Window.partitionBy(*partition).orderBy(sort_key("v", direction), "id")
    want = rows.select("*", F.row_number().over(w).cast("long").alias("p"),
                       F.dense_rank().over(Window.partitionBy(*partition).orderBy(sort_key("v", direction))).cast("long").alias("d"),
                       F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.lag("v").over(w).alias("b"))
    key = lambda df: sorted(df.select("id", "p", "d", "s", "b").collect(), key=lambda r: r["id"])
    assert key(got) == key(want)


@pytest.mark.parametrize("k", [2, 4, 7])
@pytest.mark.parametrize("n", [1, 3, 10, 2999])
def test_tiles(rows, k, n):
    some = rows.where(F.col("id") < n)
    got = tiles(some, "id", {"up": "v asc", "down": "v desc"}, k)
    want = some.select("*", F.ntile(k).over(Window.orderBy(sort_key("v", "asc"), "id")).alias("up"),
                       F.ntile(k).over(Window.orderBy(sort_key("v", "desc"), "id")).alias("down"))
    assert collect(got, "id", "up", "down") == collect(want, "id", "up", "down")


def test_many_ranks_at_once(rows):
    some = rows.select("*", (F.col("v").cast("double") / 3).alias("r"), F.col("v").cast("decimal(15,6)").alias("m"))
    orders = {"a": "v desc", "b": "r asc", "c": "m desc", "d": "r desc"}
    got = dense_ranks(some, "id", orders, {"c": ("g",)})
    rank = lambda c, way, *p: F.dense_rank().over(Window.partitionBy(*p).orderBy(sort_key(c, way))).cast("long")
    want = some.select("*", rank("v", "desc").alias("a"), rank("r", "asc").alias("b"), rank("m", "desc", "g").alias("c"), rank("r", "desc").alias("d"))
    assert collect(got, "id", "a", "b", "c", "d") == collect(want, "id", "a", "b", "c", "d")


def test_null_partition_key(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x", i % 5) for i in range(200)], "id int, g string, v int")
    got = number_rows(df, "v desc, id", partition=("g",), position="p")
    want = df.select("*", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")).cast("long").alias("p"))
    assert collect(got, "id", "p") == collect(want, "id", "p")


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, v int")
    assert number_rows(df, "v desc, id", position="p", dense_rank="d").count() == 0
    assert tiles(df, "id", {"t": "v asc"}, 4).count() == 0 and dense_ranks(df, "id", {"t": "v asc"}).count() == 0
