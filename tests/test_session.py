import pytest
from pyspark.sql import functions as F

from ventaria import session


def stub(master="yarn", named=None, set_dir=None):
    conf = type("Conf", (), {"get": lambda self, key, default=None: named if key == "spark.checkpoint.dir" else default})()
    context = type("Context", (), {"master": master, "getCheckpointDir": lambda self: set_dir, "applicationId": "app"})()
    return type("Session", (), {"conf": conf, "sparkContext": context})()


def test_folder_named_by_the_session_comes_first():
    assert session.checkpoint_folder(stub(named="hdfs://shared/", set_dir="/other")) == "hdfs://shared/ventaria/app"
    assert session.checkpoint_folder(stub(set_dir="hdfs://set")) == "hdfs://set/ventaria/app"


def test_cluster_without_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.checkpoint_folder(stub())


def test_settled_rows_keep_types_and_values(spark):
    df = spark.range(5).select("id", F.expr("CAST(id / 3 AS DECIMAL(25,6))").alias("d"), F.expr("nullif(id, 2)").alias("n"))
    kept = session.settle(df)
    assert kept.schema.simpleString() == df.schema.simpleString() and sorted(kept.collect()) == sorted(df.collect())


def test_stages_are_made_anew_after_a_drop(spark, small):
    from ventaria.plans import quality

    before = quality.raw_row_count(quality.Sheets.open(spark, small)).collect()
    assert quality.Sheets.open(spark, small) is quality.Sheets.open(spark, small)
    session.drop_settled(spark)
    assert quality.raw_row_count(quality.Sheets.open(spark, small)).collect() == before
