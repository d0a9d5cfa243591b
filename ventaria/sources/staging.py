"""Written tables between the stages of the load."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ventaria.functions.expressions import all_of


def reload_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table as a whole; running it again gives the same table.

    The new rows are written beside the table and take its place only when all
    are there: a reload that fails leaves the old table, and ``df`` may read the
    table it replaces. The exchange is two renames, each atomic on a file system
    such as HDFS; should the second fail, the old table is put back.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    folder = spark._jvm.org.apache.hadoop.fs.Path
    old, fresh, aside = folder(path), folder(f"{path.rstrip('/')}__new_{mark}"), folder(f"{path.rstrip('/')}__old_{mark}")
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer = df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(fresh.toString())
        had = files.exists(old)
        if had and not files.rename(old, aside):
            raise OSError(f"cannot move {path} aside")
        if not files.rename(fresh, old):
            if had:
                files.rename(aside, old)
            raise OSError(f"cannot put the new table at {path}")
        if had:
            files.delete(aside, True)
    finally:
        files.delete(fresh, True)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def missing_rows(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates whose key is not yet present (NULL keys compare as equal)."""
    known = existing.select(*[F.col(k).alias(f"_e_{k}") for k in keys])
    same = all_of([F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in keys])
    return candidates.join(known, same, "left_anti")


def only_new(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key that is not yet present: the least of its rows, folded per task before they move."""
    others = [c for c in candidates.columns if c not in keys]
    folded = candidates.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")) if others else candidates.distinct()
    return missing_rows(folded, existing, keys).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in candidates.columns])


def contradictory(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct candidates of new keys that differ from the row :func:`only_new` takes."""
    others = [c for c in candidates.columns if c not in keys]
    if not others:
        return candidates.where("false")
    distinct = missing_rows(candidates.distinct(), existing, keys)
    least = candidates.groupBy(*[F.col(k).alias(f"_l_{k}") for k in keys]).agg(F.min(F.struct(*others)).alias("_row"))
    same = all_of([F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in keys])
    return distinct.join(least, same & ~F.struct(*others).eqNullSafe(F.col("_row")), "left_semi")


def arrivals(candidates: DataFrame, existing: DataFrame, keys: list[str], taken: str = "_taken") -> DataFrame:
    """The rows of :func:`only_new` and of :func:`contradictory` together, ``taken`` telling them apart; the candidates move once."""
    others = [c for c in candidates.columns if c not in keys]
    if not others:
        return only_new(candidates, existing, keys).withColumn(taken, F.lit(True))
    marked = candidates.withColumn("_known", F.lit(False)).unionByName(existing.select(*keys).withColumn("_known", F.lit(True)), allowMissingColumns=True)
    alike, row = Window.partitionBy(*keys), F.struct(*others)
    seen = marked.repartition(*keys).select("*", F.max("_known").over(alike).alias("_has"), F.min(F.when(~F.col("_known"), row)).over(alike).alias("_row"))
    return seen.where("NOT _has").select(*candidates.columns, row.eqNullSafe(F.col("_row")).alias(taken)).distinct()


def refused_rows(path: str) -> str:
    """Where rows that contradict an appended one are kept."""
    return f"{path.rstrip('/')}_contradictory"


def append_new(candidates: DataFrame, path: str, keys: list[str]) -> None:
    """Insert only the rows that are missing; of different rows with one new key the others go to the side table."""
    existing = candidates.sparkSession.read.schema(candidates.schema).parquet(path)
    contradictory(candidates, existing, keys).write.mode("append").parquet(refused_rows(path))
    only_new(candidates, existing, keys).write.mode("append").parquet(path)


def load_check(df: DataFrame, rows: int, columns: int) -> DataFrame:
    """Row and column count of a load against the expected size."""
    counted = df.agg(F.count(F.lit(1)).alias("total_rows")).withColumn("total_columns", F.lit(len(df.columns)))
    good = (F.col("total_rows") == rows) & (F.col("total_columns") == columns)
    return counted.select("*", F.when(good, "OK").otherwise("REVISAR").alias("status"))


def register_views(named: dict[str, DataFrame]) -> None:
    """Make frames available to SQL by name."""
    for name, df in named.items():
        df.createOrReplaceTempView(name)
