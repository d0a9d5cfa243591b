"""Ranks of a few asked rows, without sorting the rows they are ranked among.

A dense rank is one more than the number of different values ahead.  The values
of the asked rows cut the axis into intervals; every task finds the interval of
its values by binary search in these few cuts and only counts per interval move
on.  The one exchange of all entities is by hash of narrow values, to meet equal
ones; there is no range exchange, no sort and no written copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ventaria.operators.ordering import _beside, _melted, parse_order


def _key() -> Column:
    return F.struct("_unknown", "_exact", "_real").alias("_key")


def cuts_up_to(cuts: Column, value: Column, most: int) -> Column:
    """How many of the sorted ``cuts`` (at most ``most``) are not above ``value``."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at))


def ranks_of(rows: DataFrame, df: DataFrame, unique: str, ranks: dict[str, str], most: int) -> DataFrame:
    """``rows`` with dense ranks ``{rank name: 'measure desc'}`` among all of ``df``.

    ``rows`` are rows of ``df``, at most ``most``; both are read more than once:
    settle them first. Unknown values rank as in ``dense_ranks``. Without rows
    the result is empty.
    """
    ids = [name for name, _ in parse_order(unique)]
    asked = _melted(rows, ids, ranks, {}).select(*ids, "_name", _key())
    cuts = asked.groupBy("_name").agg(F.array_sort(F.collect_set("_key")).alias("_cuts"))  # a row per rank, ``most`` keys in it
    place = cuts_up_to(F.col("_cuts"), F.col("_key"), most).alias("_at")

    values = _melted(df, [], ranks, {}).select("_name", _key()).distinct()
    counts = values.join(F.broadcast(cuts), "_name").select("_name", place).groupBy("_name", "_at").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("_name").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)  # at most ``most`` + 1 rows
    ranked = counts.select("_name", "_at", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) + 1).alias("_rank"))

    placed = asked.join(F.broadcast(cuts), "_name").select(*ids, "_name", place)
    return _beside(rows, ids, placed.join(ranked, ["_name", "_at"]), list(ranks), F.col("_rank"))
