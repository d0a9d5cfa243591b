"""Small column expressions used across reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Labels and limits that must equal the published ones.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
DISCOUNT_BANDS = (
    ("0.00", "Sin descuento"), ("0.10", "01 - 10%"), ("0.20", "11 - 20%"),
    ("0.30", "21 - 30%"), ("0.50", "31 - 50%"), (None, "Más de 50%"),
)
SHIPPING_BANDS = (
    (0, "Mismo día"), (2, "1-2 días"), (4, "3-4 días"), (7, "5-7 días"), (None, "8+ días"),
)
UNKNOWN_SHIP_MODE = "Unknown"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: Column | str) -> Column:
    return col(c).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient in double; NULL when the divisor is zero or unknown."""
    if isinstance(numerator, str) and isinstance(denominator, str):
        return F.expr(sql_ratio(numerator, denominator))
    d = dbl(denominator)
    return F.when(d != 0, dbl(numerator) / d)


def pct(numerator: Column | str, denominator: Column | str) -> Column:
    if isinstance(numerator, str) and isinstance(denominator, str):
        return F.expr(sql_pct(numerator, denominator))
    d = dbl(denominator)
    return F.when(d != 0, F.lit(100.0) * dbl(numerator) / d)


def growth(current: Column | str, previous: Column | str) -> Column:
    """Change against the previous value, in percent of it."""
    if isinstance(current, str) and isinstance(previous, str):
        return F.expr(sql_pct(f"{current} - {previous}", previous))
    return pct(col(current) - col(previous), previous)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def rounded(c: Column | str, digits: int = 2) -> Column:
    if isinstance(c, str):
        return F.expr(f"double(round({c}, {digits}))")
    return F.round(col(c), digits).cast("double")


def fine(c: Column | str) -> Column:
    """A double as a fixed-point number, so that sums do not depend on order."""
    return dbl(c).cast("decimal(28,12)")


def mean_of(c: Column | str) -> Column:
    """Average of an exact (integer or decimal) column, as double."""
    return dbl(F.sum(c)) / F.count(c)


def mean_of_fine(c: Column | str) -> Column:
    return dbl(F.sum(fine(c))) / F.count(c)


def banded(value: Column | str, bands, kind: str) -> tuple[Column, Column]:
    """Label and 1-based order of the first band whose upper limit holds ``value``."""
    v = col(value)
    last = len(bands)
    label, place = F.lit(bands[-1][1]), F.lit(last)
    for at in range(last - 1, 0, -1):
        limit, text = bands[at - 1]
        inside = v <= F.lit(limit).cast(kind)
        label = F.when(inside, text).otherwise(label)
        place = F.when(inside, at).otherwise(place)
    return label, place


def discount_band(value: Column | str) -> tuple[Column, Column]:
    return banded(value, DISCOUNT_BANDS, "decimal(4,2)")


def shipping_band(value: Column | str) -> tuple[Column, Column]:
    return banded(value, SHIPPING_BANDS, "int")


def month_name(month: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), col(month))


def month_start(day: Column | str) -> Column:
    return F.trunc(col(day), "month")


def months_apart(earlier: Column | str, later: Column | str) -> Column:
    """Whole months between two month starts."""
    a, b = col(earlier), col(later)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def mode_or_unknown(c: Column | str = "ship_mode") -> Column:
    return F.coalesce(col(c), F.lit(UNKNOWN_SHIP_MODE))


def sql_ratio(numerator: str, denominator: str) -> str:
    """SQL text of :func:`ratio`; text is cheaper to build than column objects."""
    return f"(double({numerator}) / nullif(double({denominator}), 0D))"


def sql_pct(numerator: str, denominator: str) -> str:
    return f"(100D * double({numerator}) / nullif(double({denominator}), 0D))"


def sql_spread(count: str, total: str, squares: str) -> str:
    """Population standard deviation from integer sums: exact and mergeable."""
    n, s, q = (f"CAST({c} AS DECIMAL(19,0))" for c in (count, total, squares))
    return f"(sqrt(double({n} * {q} - {s} * {s})) / nullif(double({count}), 0D))"


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def collated(df, columns: list[str], collation: str = "UNICODE_CI_AI_RTRIM"):
    """Compare the given text columns without regard to case, accents and
    trailing blanks: DISTINCT, GROUP BY and joins on them follow the collation."""
    return df.withColumns({c: F.collate(c, collation) for c in columns})
