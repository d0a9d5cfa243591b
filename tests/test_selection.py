"""Ranks of a few rows against plain dense ranks over all rows, with ties and unknown values."""

import random

import pytest
from pyspark.sql import Window, functions as F

from ventaria.operators.ordering import first_rows
from ventaria.operators.selection import cuts_up_to, ranks_of

RANKS = {"whole_rank": "whole desc", "exact_rank": "exact desc", "real_rank": "real desc"}


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the values equal, some unknown, signs mixed."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        value = None if i % 11 == 4 else 7 if i % 3 == 0 else rng.randint(-300, 300)
        data.append((i, value, None if value is None else value / 4, None if i % 7 == 2 else rng.choice([-0.5, 0.0, -0.0, rng.random()])))
    df = spark.createDataFrame(data, "id int, whole long, quarter double, real double")
    return df.selectExpr("id", "whole", "CAST(quarter AS decimal(20,6)) AS exact", "real").repartition(7).cache()


def plain(rows):
    return rows.select("*", *[F.dense_rank().over(Window.orderBy(F.col(way.split()[0]).desc_nulls_last())).cast("long").alias(name)
                              for name, way in RANKS.items()])


@pytest.mark.parametrize("order", ["whole desc, id", "real desc, id", "exact, id", "id"])
@pytest.mark.parametrize("n", [1, 60, 3000])
def test_ranks_of_some_rows(rows, order, n):
    some = first_rows(rows, order, n, "position").cache()
    got = {r["id"]: r for r in ranks_of(some, rows, "id", RANKS, n).collect()}
    want = {r["id"]: r for r in plain(rows).collect()}
    assert len(got) == min(n, 3000)
    for i, row in got.items():
        assert all(row[name] == want[i][name] for name in RANKS)


def test_no_rows_and_no_table(rows):
    assert ranks_of(rows.limit(0), rows, "id", RANKS, 5).isEmpty()
    assert ranks_of(rows.limit(0), rows.limit(0), "id", RANKS, 5).isEmpty()


def test_plan_has_no_range_exchange(rows, capsys):
    ranks_of(rows.where("id < 9"), rows, "id", RANKS, 9).explain()
    assert "rangepartitioning" not in capsys.readouterr().out


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 7, 8, 9])
def test_search_in_cuts(spark, size):
    cuts = [3 * i for i in range(size)]
    df = spark.range(-1, 3 * size + 2).select("id", F.array(*[F.lit(c).cast("long") for c in cuts]).cast("array<bigint>").alias("c"))
    for r in df.select("id", cuts_up_to(F.col("c"), F.col("id"), size).alias("at")).collect():
        assert r["at"] == sum(c <= r["id"] for c in cuts)
