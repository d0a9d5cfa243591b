"""Conservation checks between two levels of the same data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import all_of, dbl, ratio
from ventaria.operators.scalars import attach
from ventaria.session import settle

OK, REVIEW = "OK", "REVISAR"  # fixed values: published states


def compare_totals(whole: DataFrame, parts: DataFrame, names: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Two one-row frames side by side: ``{column: (left name, right name, difference name)}``."""
    left = whole.select(*[F.col(c).alias(l) for c, (l, _, _) in names.items()])
    right = parts.select(*[F.col(c).alias(r) for c, (_, r, _) in names.items()])
    out = []
    for l, r, diff in names.values():
        out += [F.col(l), F.col(r), (F.col(r) - F.col(l)).alias(diff)]
    return doubles(attach(left, right).select(*out))


def doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as double, all others unchanged."""
    return df.select(*[dbl(f.name).alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])


def control(name: str, expected: DataFrame, obtained: DataFrame) -> DataFrame:
    """One control row from two one-row, one-column frames."""
    e, o = expected.columns[0], obtained.columns[0]
    both = attach(expected.select(F.col(e).alias("expected")), obtained.select(F.col(o).alias("obtained")))
    return both.select(F.lit(name).alias("control"), F.col("expected"), F.col("obtained"))


def stack_controls(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def state(expected: Column, obtained: Column) -> Column:
    return F.when(expected.eqNullSafe(obtained), OK).otherwise(REVIEW)


def unpivot_counts(one_row: DataFrame, labels: dict[str, str], label_col: str, value_col: str) -> DataFrame:
    """One-row counters as (label, value) rows; the data is read once for all of them."""
    pairs = ", ".join(f"'{label}', `{name}`" for name, label in labels.items())
    return one_row.select(F.expr(f"stack({len(labels)}, {pairs}) AS ({label_col}, {value_col})"))


def unmatched(source: DataFrame, target: DataFrame, keys: list[str], agree: list[str] = ()) -> DataFrame:
    """Source rows without partner in ``target``, or whose partner disagrees on
    ``agree`` (compared null-safely). Keys of ``source`` with NULL never match."""
    if not agree:
        return source.join(target.select(*keys).distinct(), list(keys), "left_anti")
    right = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *[F.col(a).alias(f"_t_{a}") for a in agree])
    same = all_of([F.col(k) == F.col(f"_t_{k}") for k in keys]
                  + [F.col(a).eqNullSafe(F.col(f"_t_{a}")) for a in agree])
    return source.join(right, same, "left_anti")


def count_unmatched(source: DataFrame, target: DataFrame, keys: list[str], agree: list[str] = ()) -> DataFrame:
    """How many rows :func:`unmatched` gives; equal rows are folded and counted before they meet the target."""
    folded = source.groupBy(*keys, *agree).agg(F.count(F.lit(1)).alias("_n"))
    return unmatched(folded, target, keys, agree).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("unmatched"))


def levels_against_total(orders: DataFrame, levels: dict[str, list[str]], level_name: str, groups_name: str) -> DataFrame:
    """Sum every level of grouping and set it against the grand total, in one pass over the orders.

    The orders are folded once to one row per combination of the levels' keys;
    GROUPING SETS over that small cube give all levels and the total.
    """
    measures = ("total_orders", "total_order_lines", "total_sales", "total_quantity", "total_profit")
    keys = list(dict.fromkeys(k for level in levels.values() for k in level))
    cube = orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_orders"), *[F.sum(m).alias(m) for m in measures[1:]])
    sets = [[F.col(k) for k in level] for level in [*levels.values(), []]]
    grouped = cube.groupingSets(sets, *keys).agg(F.grouping_id(*keys).alias("_set"), *[F.sum(m).alias(m) for m in measures])
    bits = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in level) for name, level in levels.items()}
    whole = (1 << len(keys)) - 1
    per_set = settle(grouped.groupBy("_set").agg(F.count(F.lit(1)).alias(groups_name), *[F.sum(m).alias(m) for m in measures]))
    names = F.create_map(*[F.lit(x) for name, b in bits.items() for x in (b, name)])
    shown = per_set.where(F.col("_set") != whole).select(names[F.col("_set").cast("int")].alias(level_name), groups_name, *measures)
    total = per_set.where(F.col("_set") == whole).select(*[F.col(m).alias(m.replace("total_", "global_")) for m in measures])
    both = attach(shown, total)
    out = [F.col(level_name), F.col(groups_name)]
    for own, other, diff in (
        ("total_orders", "global_orders", "order_difference"),
        ("total_order_lines", "global_order_lines", "order_line_difference"),
        ("total_sales", "global_sales", "sales_difference"),
        ("total_quantity", "global_quantity", "quantity_difference"),
        ("total_profit", "global_profit", "profit_difference"),
    ):
        money = own in ("total_sales", "total_profit")
        wrap = dbl if money else (lambda c: c)
        out += [wrap(F.col(own)).alias(own), wrap(F.col(other)).alias(other),
                wrap(F.col(own) - F.col(other)).alias(diff)]
    return both.select(*out)


def uniqueness(df: DataFrame, keys: list[str], total: str, unique: str, duplicates: str) -> DataFrame:
    """Rows, distinct keys and their difference."""
    counted = df.agg(F.count(F.lit(1)).alias(total), F.count_distinct(*[F.col(k) for k in keys]).alias(unique))
    return counted.select("*", (F.col(total) - F.col(unique)).alias(duplicates))


def count_against(expected: DataFrame, obtained: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """Row counts of two frames and their difference (obtained - expected)."""
    left = expected.agg(F.count(F.lit(1)).alias(names[0]))
    both = attach(left, obtained.agg(F.count(F.lit(1)).alias(names[1])))
    return both.select("*", (F.col(names[1]) - F.col(names[0])).alias(names[2]))


def share_total(parts: DataFrame, whole: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Sum of the parts in percent of the whole: ``{column: name}``."""
    left = parts.agg(*[F.sum(c).alias(c) for c in columns])
    right = whole.agg(*[F.sum(c).alias(f"_w_{c}") for c in columns])
    both = attach(left, right)
    return both.select(*[F.round(F.lit(100.0) * ratio(c, f"_w_{c}"), 2).alias(n) for c, n in columns.items()])
