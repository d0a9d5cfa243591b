"""Data-quality profiling; every function reads the data once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import any_of, flag

# Accepted text formats.
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SIGNED_NUMBER = r"^-?[0-9]+([.][0-9]+)?$"
WHOLE_NUMBER = r"^[0-9]+([.]0+)?$"
RAW_DATE_FORMATS = {
    "YYYY-MM-DD HH:MM:SS": r"^[0-9]{4}-[0-9]{2}-[0-9]{2} 00:00:00$",
    "DD-MMM-YYYY": r"^[0-9]{2}-[A-Za-z]{3}-[0-9]{4}$",
    "DD.MM.YYYY": r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$",
    "YYYYMMDD": r"^[0-9]{8}$",
}
OTHER_FORMAT = "OTRO"
VALUE_SEPARATOR = " | "


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in columns])


def blank_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.trim(c) == "").alias(f"{c}_blank") for c in columns])


def duplicate_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """Groups of equal rows, rows in them and rows in excess."""
    repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_groups"), F.sum("n").alias("rows_involved"),
                        F.sum(F.col("n") - 1).alias("excess_rows"))


def distinct_counts(df: DataFrame, columns: dict[str, str], approximate: float | None = None) -> DataFrame:
    """``{column: name}``. With ``approximate`` (relative error) each column costs
    a fixed-size sketch; the exact form counts each column's own distinct values,
    one narrow column at a time, so no row is multiplied."""
    if approximate is not None:
        return df.agg(*[F.approx_count_distinct(c, approximate).alias(n) for c, n in columns.items()])
    from ventaria.operators.scalars import attach

    out = None
    for column, name in columns.items():
        one = df.select(column).distinct().agg(F.count(column).alias(name))
        out = one if out is None else attach(out, one)
    return out


def domain(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def frequency(df: DataFrame, column: str, null_as: str | None = None, count: str = "total") -> DataFrame:
    shown = F.col(column) if null_as is None else F.coalesce(F.col(column), F.lit(null_as)).alias(column)
    return df.groupBy(shown).agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), column)


def classify_format(column: str, formats: dict[str, str], other: str = OTHER_FORMAT) -> Column:
    out = F.lit(other)
    for name, pattern in reversed(formats.items()):
        out = F.when(F.col(column).rlike(pattern), name).otherwise(out)
    return out


def violations(df: DataFrame, rules: dict[str, Column], total: str | None = None) -> DataFrame:
    """How many rows break each rule; a rule that is unknown (NULL) is not broken."""
    counted = [F.count_if(test).alias(name) for name, test in rules.items()]
    return df.agg(*([F.count(F.lit(1)).alias(total)] if total else []), *counted)


def missing_patterns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per combination of missing values."""
    marks = [flag(F.col(c).isNull()).alias(f"{c}_missing") for c in columns]
    return df.select(*marks).groupBy(*[f"{c}_missing" for c in columns]).agg(F.count(F.lit(1)).alias("total"))


def fd_conflicts(df: DataFrame, key: list[str], attributes: list[str]) -> DataFrame:
    """Keys with more than one value of an attribute, with the distinct counts.

    Distinct combinations are formed first, so a key that fills a third of the
    rows is folded before it is moved. Several counts at once write every
    combination several times, so then only keys whose least and greatest value
    differ take part.
    """
    if len(key) == 1 and len(attributes) > 1:
        several = df.groupBy(*key).agg(any_of([F.min(a) != F.max(a) for a in attributes]).alias("_several")).where("_several").select(*key)
        df = df.select(*key, *attributes).join(several, key, "left_semi")
    known = df.where(F.col(key[0]).isNotNull()).select(*key, *attributes).distinct() if len(key) == 1 else df.select(*key, *attributes).distinct()
    counted = known.groupBy(*key).agg(*[F.count_distinct(a).alias(f"total_{a}") for a in attributes])
    return counted.where(any_of([F.col(f"total_{a}") > 1 for a in attributes]))


def fd_violations(df: DataFrame, dependencies: dict[str, tuple[str, str]]) -> DataFrame:
    """``{name: (key, attribute)}`` -> number of keys with several values."""
    from ventaria.operators.scalars import attach

    out = None
    for name, (key, attribute) in dependencies.items():
        pairs = df.where(F.col(key).isNotNull() & F.col(attribute).isNotNull()).select(key, attribute).distinct()
        broken = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias(name))
        out = broken if out is None else attach(out, broken)
    return out


def joined_values(column: str) -> Column:
    """Distinct values as one ordered text; apply to rows already made distinct."""
    return F.array_join(F.array_sort(F.collect_set(column)), VALUE_SEPARATOR)
