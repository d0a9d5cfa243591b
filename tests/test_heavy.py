"""Lookup joins with a heavy key: the same rows, and no task with the whole key."""

from pyspark.sql import functions as F

from ventaria.operators import cleaning as C
from ventaria.operators import heavy as H


def people(spark, n=30_000):
    return spark.range(n, numPartitions=8).select(
        F.col("id").alias("row"), F.expr("if(id % 3 = 0, 'hot', if(id % 7 = 1, NULL, concat('k', id % 500)))").alias("name"), F.expr("id % 2").alias("kind"))


def test_heavy_keys_are_found(spark):
    found = H.heavy_hashes(people(spark), ["name"], share=10)
    assert found == [people(spark).where("name = 'hot'").select(F.xxhash64("name")).first()[0]]
    assert H.heavy_hashes(people(spark).where("row < 0"), ["name"]) == []


def test_same_rows_as_a_plain_join(spark):
    rows = people(spark)
    lookup = spark.createDataFrame([("hot", 0, "a"), ("hot", 1, "b"), ("k4", 0, "c"), ("k7", 1, "d"), ("absent", 0, "e")], "_name string, _kind long, value string")
    assert "BroadcastHashJoin" in H.join_lookup(rows, lookup, {"name": "_name"})._jdf.queryExecution().executedPlan().toString()
    for share in (2, 10, 1_000, 5_000):
        made = H.join_lookup(rows, lookup, {"name": "_name", "kind": "_kind"}, share, most_bytes=0)
        plain = rows.join(lookup, (F.col("name") == F.col("_name")) & (F.col("kind") == F.col("_kind")), "left")
        assert made.count() == rows.count() and made.exceptAll(plain.select(*made.columns)).isEmpty()


def test_a_heavy_key_does_not_travel(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = people(spark).where("name is not null").select(F.col("name").alias("_name")).distinct().withColumn("value", F.lit("v"))
        made = H.join_lookup(people(spark), lookup, {"name": "_name"}, 10, most_bytes=0)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        assert made.where("value is not null").count() == people(spark).where("name is not null").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ids_of_a_frequent_name_are_unified(spark):
    rows = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, "Ann").otherwise(F.concat(F.lit("N"), F.col("id") % 40)).alias("customer_name"),
                                     F.concat(F.lit("C"), F.col("id") % 4).alias("customer_id"))
    mapping = spark.createDataFrame([("Ann", "C1", "C0"), ("Ann", "C2", "C0"), ("N5", "C1", "C3")], "_name string, _alias string, _canonical string")
    made = C.replace_by_map(rows, "customer_id", mapping, "_canonical", {"customer_name": "_name", "customer_id": "_alias"})
    assert made.where("customer_name = 'Ann'").select("customer_id").distinct().count() == 2 and made.count() == 6_000
    assert made.where("customer_name = 'N5' and customer_id = 'C1'").count() == 0
