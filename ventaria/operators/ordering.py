"""Ranks, row numbers, running totals and tiles that scale past one task.

A window without PARTITION BY sends every row to one task.  Here the rows are
range-partitioned by the sort keys (the last key is unique, so equal values,
however many, can be cut anywhere), each slice is numbered by its own window,
and one small row per slice tells the later slices where to go on counting.
No slice count is fixed: adaptive execution merges neighbouring small slices,
which keeps their order.
The same works for a partitioned window whose groups may be very large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, DoubleType

from ventaria.functions.expressions import all_of
from ventaria.operators.scalars import attach
from ventaria.session import in_differences, settle

SLICE = "_slice"
_START = Window.unboundedPreceding


def sort_key(name: str, direction: str) -> Column:
    return F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_first()


def parse_order(order: str) -> list[tuple[str, str]]:
    """'total_sales desc, product_key' -> pairs."""
    out = []
    for item in order.split(","):
        words = item.split()
        out.append((words[0], words[1].lower() if len(words) > 1 else "asc"))
    return out


def number_rows(
    df: DataFrame,
    order: str,
    *,
    partition: tuple[str, ...] = (),
    position: str | None = None,
    dense_rank: str | tuple[str, int] | None = None,
    running: tuple[str, str] | None = None,
    previous: tuple[str, str] | None = None,
) -> DataFrame:
    """Add order-dependent columns over ``order`` (its last key must be unique).

    position    row number
    dense_rank  dense rank of the first key of ``order``, or (name, n) of the first n keys
    running     (source column, name): running sum up to and including the row
    previous    (source column, name): value of the preceding row (LAG 1)
    """
    keys = parse_order(order)
    sort = [sort_key(*k) for k in keys]
    parts = list(partition)
    if position and not (parts or dense_rank or running or previous):
        return positions(df, sort, position)

    ranged = df.repartitionByRange(*[F.col(p) for p in parts], *sort)
    ranged = ranged.withColumn(SLICE, F.spark_partition_id())
    inside = Window.partitionBy(SLICE, *parts).orderBy(*sort)
    local = [F.row_number().over(inside).cast("long").alias("_n")]
    dense_rank, width = dense_rank if isinstance(dense_rank, tuple) else (dense_rank, 1)
    if dense_rank:
        by_value = Window.partitionBy(SLICE, *parts).orderBy(*sort[:width])
        local.append(F.dense_rank().over(by_value).cast("long").alias("_d"))
    if running:
        local.append(F.sum(running[0]).over(inside.rowsBetween(_START, 0)).alias("_s"))
    if previous:
        local.append(F.lag(previous[0]).over(inside).alias("_p"))
    numbered = settle(ranged.select("*", *local))

    value = F.struct(*[F.col(name) for name, _ in keys[:width]])
    facts = [F.max("_n").alias("n")]
    if dense_rank:
        facts += [F.max("_d").alias("d"), F.min_by(value, "_n").alias("head"),
                  F.max_by(value, "_n").alias("tail")]
    if running:
        facts.append(F.max_by("_s", "_n").alias("s"))
    if previous:
        facts.append(F.max_by(previous[0], "_n").alias("end"))
    slices = numbered.groupBy(SLICE, *parts).agg(*facts)

    in_order = Window.partitionBy(*parts).orderBy(SLICE)
    before = in_order.rowsBetween(_START, -1)
    offsets = [F.sum("n").over(before).alias("_n0")]
    if running:
        offsets.append(F.sum("s").over(before).alias("_s0"))
    if previous:
        offsets.append(F.lag("end").over(in_order).alias("_p0"))
    if dense_rank:
        shared = F.lag(F.lit(1)).over(in_order).isNotNull() & F.lag("tail").over(in_order).eqNullSafe(F.col("head"))
        slices = slices.select("*", F.when(shared, 1).otherwise(0).alias("bridge"))
        offsets.append((F.sum("d").over(before) - F.sum("bridge").over(in_order.rowsBetween(_START, 0))).alias("_d0"))
    # Only slices that continue a group remain: at most one per range partition.
    carried = (
        slices.select(F.col(SLICE).alias("_slice0"), *[F.col(p).alias(f"_key{i}") for i, p in enumerate(parts)], *offsets)
        .where(F.col("_n0").isNotNull())
    )
    match = all_of([F.col(SLICE) == F.col("_slice0")]
                   + [F.col(p).eqNullSafe(F.col(f"_key{i}")) for i, p in enumerate(parts)])
    # A value carried forward may be a long text: then the rows are written, and their size decides how they are joined.
    joined = numbered.join(settle(carried) if previous else F.broadcast(carried), match, "left")

    row_number = F.col("_n") + F.coalesce(F.col("_n0"), F.lit(0))
    added = []
    if position:
        added.append(row_number.alias(position))
    if dense_rank:
        added.append((F.col("_d") + F.coalesce(F.col("_d0"), F.lit(0))).alias(dense_rank))
    if running:
        total = F.coalesce(F.col("_s") + F.col("_s0"), F.col("_s"), F.col("_s0"))
        added.append(total.alias(running[1]))
    if previous:
        crossing = (F.col("_n") == 1) & F.col("_n0").isNotNull()
        added.append(F.when(crossing, F.col("_p0")).otherwise(F.col("_p")).alias(previous[1]))
    return joined.select(*[F.col(c) for c in df.columns], *added)


def positions(df: DataFrame, sort: list[Column], name: str) -> DataFrame:
    """Row numbers alone: one range exchange and a sort inside each slice, no window and no second exchange.

    A row's slice and place in it are the upper and lower bits of its running id,
    which is written before anything is counted.
    """
    bits = 33
    at = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*sort).sortWithinPartitions(*sort).select("*", at.alias("_at"))
    with in_differences():
        placed = settle(placed.select(*[F.col(c) for c in df.columns], F.shiftright("_at", bits).cast("int").alias(SLICE),
                                      (F.col("_at").bitwiseAND((1 << bits) - 1) + 1).alias("_n")))
    slices = placed.groupBy(F.col(SLICE).alias("_slice0")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_slice0").rowsBetween(_START, -1)
    offsets = slices.select("_slice0", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n0"))
    # One row for all slices, as a value and not as a join: what reads the numbered rows sees their size, not a product of sizes.
    starts = offsets.agg(F.map_from_entries(F.collect_list(F.struct("_slice0", "_n0"))).alias("_at"), F.max("_slice0").alias("_last"))
    starts = settle(starts.selectExpr("transform(sequence(0, _last), s -> _at[s]) AS _starts"))
    return attach(placed, starts).select(*[F.col(c) for c in df.columns], (F.col("_n") + F.get("_starts", F.col(SLICE))).alias(name))


def first_rows(df: DataFrame, order: str, n: int, name: str) -> DataFrame:
    """The first ``n`` rows and their positions; each task keeps at most ``n``, and only these meet in one task."""
    sort = [sort_key(*k) for k in parse_order(order)]
    return df.orderBy(*sort).limit(n).select("*", F.row_number().over(Window.orderBy(*sort)).cast("long").alias(name))


def tile_of(row_number: Column, rows: Column, k: int) -> Column:
    """NTILE(k) from a row number: the first ``rows % k`` tiles get one row more."""
    size = F.floor(rows / k).cast("long")
    larger = rows % k
    edge = larger * (size + 1)
    head = F.floor((row_number - 1) / (size + 1)) + 1
    tail = larger + F.floor((row_number - 1 - edge) / F.when(size > 0, size)) + 1
    return F.when(row_number <= edge, head).otherwise(tail).cast("int")


_SORT = "_unknown, _exact, _real"


def _melted(df: DataFrame, ids: list[str], orders: dict[str, str], partitions: dict[str, tuple[str, ...]]) -> DataFrame:
    """One narrow row per entity and ordering, all sorted by the same three keys.

    Descending orders are negated; exact numbers and reals keep their own column,
    so equal stays equal. The scope is the ordering and its partition.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for name, order in orders.items():
        (column, way), = parse_order(order)
        sign = "-" if way == "desc" else ""
        unknown = F.expr(f"if({column} IS NULL, {'1, 0' if way == 'desc' else '0, 1'})")
        kind = kinds[column]
        exact = F.datediff(F.col(column), F.lit("1970-01-01")) if isinstance(kind, DateType) else F.col(column)
        real = isinstance(kind, DoubleType)
        signed = lambda c: -c if sign else c
        scope = F.concat_ws("\u0001", F.lit(name), *[F.coalesce(F.col(p).cast("string"), F.lit("\u0002")) for p in partitions.get(name, ())])
        rows.append(F.struct(
            F.lit(name).alias("_name"), scope.alias("_scope"), unknown.alias("_unknown"),
            (F.lit(None) if real else signed(exact)).cast("decimal(38,6)").alias("_exact"),
            (signed(F.col(column)) if real else F.lit(None)).cast("double").alias("_real")))
    return df.select(*ids, F.explode(F.array(*rows)).alias("_m")).select(*ids, "_m.*")


def _beside(df: DataFrame, ids: list[str], melted: DataFrame, names: list[str], value: Column) -> DataFrame:
    """Back to one row per entity, next to its other columns."""
    wide = melted.groupBy(*[F.col(i).alias(f"_id{n}") for n, i in enumerate(ids)]).agg(
        *[F.max(F.when(F.col("_name") == name, value)).alias(name) for name in names])
    match = all_of([F.col(i).eqNullSafe(F.col(f"_id{n}")) for n, i in enumerate(ids)])
    return df.join(wide, match).select(*df.columns, *names)


def dense_ranks(df: DataFrame, unique: str, ranks: dict[str, str], partitions: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Several dense ranks ``{rank name: 'measure desc'}`` in one distributed pass.

    ``df`` is read twice: settle it first. The entities are sorted as narrow rows,
    all orderings together, however many entities and ties there are.
    """
    ids = [name for name, _ in parse_order(unique)]
    melted = _melted(df, ids, ranks, partitions or {})
    ranked = number_rows(melted, f"{_SORT}, {unique}", partition=("_scope",), dense_rank=("_rank", 3))
    return _beside(df, ids, ranked, list(ranks), F.col("_rank"))


def tiles(df: DataFrame, unique: str, orders: dict[str, str], k: int) -> DataFrame:
    """Several NTILE(k) in one distributed pass; ties are cut by ``unique``."""
    ids = [name for name, _ in parse_order(unique)]
    placed = number_rows(_melted(df, ids, orders, {}), f"{_SORT}, {unique}", partition=("_scope",), position="_place")
    out = attach(_beside(df, ids, placed, list(orders), F.col("_place")), df.agg(F.count(F.lit(1)).alias("_rows")))
    return out.select(*df.columns, *[tile_of(F.col(name), F.col("_rows"), k).alias(name) for name in orders])


def small_ranks(df: DataFrame, ranks: dict[str, str], partitions: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Dense ranks for frames whose row count is bounded by a small domain
    (months, categories, regions, ship modes); larger frames use dense_ranks."""
    partitions = partitions or {}
    out = []
    for name, order in ranks.items():
        over = Window.partitionBy(*partitions.get(name, ())).orderBy(*[sort_key(*k) for k in parse_order(order)])
        out.append(F.dense_rank().over(over).cast("long").alias(name))
    return df.select("*", *out)


def small_share(df: DataFrame, shares: dict[str, str], partition: tuple[str, ...] = ()) -> DataFrame:
    """``{name: column}`` as percent of the column total, bounded frames only."""
    from ventaria.functions.expressions import pct

    over = Window.partitionBy(*partition)
    return df.select("*", *[pct(c, F.sum(c).over(over)).alias(n) for n, c in shares.items()])
