"""Grouped views kept up to date from signed rows.

A ledger stores, per key, sums with the number of known values behind each, and
per (key, member) how many rows support the member. Rows that leave a table
enter with sign -1, rows that come with +1, so sums and counts follow by
addition, a distinct count follows from members whose support reaches or leaves
zero, and a least or greatest value is looked up among the members left, which
a stored minimum alone could not tell. Ratios are formed at the very end.

A refresh reads the ledger rows of touched keys and the signed rows; the tables
behind the view are not read, and untouched keys pass on as they are stored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType

from ventaria.functions.expressions import all_of
from ventaria.operators.scalars import attach
from ventaria.session import united

SIGN, ROWS, KNOWN = "_sign", "_rows", "_known_"


def signed(before: DataFrame, after: DataFrame, home: str | None = None) -> DataFrame:
    """Rows that leave (-1) and rows that come (+1); parted by ``home``, those of one home stay in one task, where equal ones cancel early."""
    parts = [before.withColumn(SIGN, F.lit(-1)), after.withColumn(SIGN, F.lit(1))]
    return parts[0].unionByName(parts[1]) if home is None else united(parts, home)


def signed_images(log: DataFrame, schema: str) -> DataFrame:
    """Rows of a change log: before images with sign -1, after images with sign +1."""
    images = F.explode(F.array(F.struct(F.lit(-1).alias(SIGN), F.col("old_data").alias("data")), F.struct(F.lit(1).alias(SIGN), F.col("new_data").alias("data"))))
    rows = log.select(images.alias("i")).where("i.data IS NOT NULL")
    return rows.select(F.from_json("i.data", schema).alias("r"), f"i.{SIGN}").select("r.*", SIGN)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return all_of([left[k].eqNullSafe(right[f"_t_{k}"]) for k in keys])


def touched_only(rows: DataFrame, touched: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows whose keys are (``left_semi``) or are not (``left_anti``) among the touched ones, NULL being equal to NULL."""
    named = touched.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    return rows.join(named, same_keys(rows, named, keys), how)


def netted(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


@dataclass(frozen=True)
class Ledger:
    """What a view keeps for each key: ``sums`` as (name, value per row), ``distinct`` as {name: columns}, ``extremes`` as {name: (min or max, column)}."""

    keys: list[str]
    sums: list[tuple[str, str]]
    distinct: dict[str, list[str]] = field(default_factory=dict)
    extremes: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def measures(self) -> list[str]:
        return [ROWS, *[n for n, _ in self.sums], *[KNOWN + n for n, _ in self.sums]]

    def totals(self, rows: DataFrame) -> DataFrame:
        """Signed sums per key."""
        out = [F.sum(SIGN).cast("long").alias(ROWS)]
        for name, value in self.sums:
            out += [F.expr(f"sum(if({SIGN} > 0, {value}, -({value})))").alias(name),
                    F.expr(f"sum(if(({value}) IS NULL, 0, {SIGN}))").cast("long").alias(KNOWN + name)]
        return rows.groupBy(*self.keys).agg(*out)

    def members(self, rows: DataFrame) -> DataFrame:
        """Signed support per key and member: of a distinct count by its text, of an extreme by its number."""
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        told = []
        for name, columns in self.distinct.items():
            whole = F.when(all_of([F.col(c).isNotNull() for c in columns]), F.to_json(F.struct(*columns)))
            told.append(F.struct(F.lit(name).alias("kind"), whole.alias("label"), F.lit(None).cast("long").alias("number")))
        for column in dict.fromkeys(c for _, c in self.extremes.values()):
            number = F.datediff(F.col(column), F.lit("1970-01-01")) if isinstance(kinds[column], DateType) else F.col(column)
            told.append(F.struct(F.lit(column).alias("kind"), F.lit(None).cast("string").alias("label"), number.cast("long").alias("number")))
        each = rows.select(*self.keys, SIGN, F.explode(F.array(*told)).alias("m")).where("m.label IS NOT NULL OR m.number IS NOT NULL")
        return each.groupBy(*self.keys, "m.kind", "m.label", "m.number").agg(F.sum(SIGN).cast("long").alias("support"))

    def merged(self, stored: DataFrame, change: DataFrame, members: bool, home: str | None = None) -> DataFrame:
        """Stored rows and their changes added up; what has no row left is gone. Parted by the key ``home``, both stay where they are."""
        by, names = ([*self.keys, "kind", "label", "number"], ["support"]) if members else (self.keys, self.measures)
        both = stored.unionByName(change) if home is None else united([stored, change], home)
        return netted(both, by, names).where(F.col(names[0]) > 0)

    def view(self, totals: DataFrame, members: DataFrame, dates: frozenset[str] = frozenset({"order_date"})) -> DataFrame:
        """One row per key: sums (unknown where no value is known), distinct counts and extremes."""
        sums = [F.when(F.col(KNOWN + n) > 0, F.col(n)).alias(n) for n, _ in self.sums]
        rows = totals.select(*self.keys, *sums)
        out = [F.count_if(F.col("kind") == n).alias(n) for n in self.distinct]
        for name, (how, column) in self.extremes.items():
            found = (F.min if how == "min" else F.max)(F.when(F.col("kind") == column, F.col("number"))).cast("int")
            out.append((F.date_add(F.lit("1970-01-01").cast("date"), found) if column in dates else found).alias(name))
        if not out:
            return rows
        told = members.groupBy(*self.keys).agg(*out).withColumnsRenamed({k: f"_t_{k}" for k in self.keys})
        if not self.keys:
            return attach(rows, told)
        names = [*self.distinct, *self.extremes]
        joined = rows.join(told, same_keys(rows, told, self.keys), "left")
        return joined.select(*rows.columns, *[F.coalesce(n, F.lit(0)).alias(n) if n in self.distinct else F.col(n) for n in names])


@dataclass
class Stored:
    """A view's ledger as written, and the view it gives."""

    ledger: Ledger
    totals: DataFrame
    members: DataFrame
    shown: DataFrame

    def refreshed(self, change: DataFrame) -> DataFrame:
        """The view after signed rows: touched keys anew, all others as stored."""
        keys, led = self.ledger.keys, self.ledger
        totals, members = led.totals(change), led.members(change)
        if not keys:
            return led.view(led.merged(self.totals, totals, False), led.merged(self.members, members, True))
        touched = change.select(*keys).distinct()
        now = led.view(led.merged(touched_only(self.totals, touched, keys, "left_semi"), totals, False),
                       led.merged(touched_only(self.members, touched, keys, "left_semi"), members, True))
        kinds = {f.name: f.dataType for f in self.shown.schema.fields}
        now = now.select(*[F.col(c).cast(kinds[c]).alias(c) for c in self.shown.columns])
        return touched_only(self.shown, touched, keys, "left_anti").unionByName(now)
