"""Cleaning steps; each is DataFrame -> DataFrame and they run in a fixed order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import all_of, any_of
from ventaria.operators.heavy import join_lookup
from ventaria.operators.profiling import ISO_DATE
from ventaria.session import by_key, settle
from ventaria.sources.sales_text import COLUMNS, CORRUPT

# Spellings, domains, date formats, corrections and tolerances.
SEGMENT_SPELLINGS = {
    "consumer": "Consumer", "counsumer": "Consumer", "consumr": "Consumer",
    "corporate": "Corporate", "corp.": "Corporate", "corperate": "Corporate",
    "home office": "Home Office", "home-office": "Home Office", "homeoffice": "Home Office",
}
SEGMENTS = ("Consumer", "Corporate", "Home Office")
CATEGORIES = ("Furniture", "Office Supplies", "Technology")
SHIP_MODES = ("Standard Class", "Second Class", "First Class", "Same Day")
DATE_FORMATS = (
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^[0-9]{2}-[A-Za-z]{3}-[0-9]{4}$", "dd-MMM-yyyy"),
    (r"^[0-9]{2}[.][0-9]{2}[.][0-9]{4}$", "dd.MM.yyyy"),
    (r"^[0-9]{8}$", "yyyyMMdd"),
)
DISCOUNT_CORRECTIONS = {"5.5": "0.55"}
WHOLE_TOLERANCE = "0.000001"
LEAST_MARGIN_ROWS = 2


def drop_copies(df: DataFrame) -> DataFrame:
    """One of every set of fully equal rows."""
    return df.dropDuplicates()


def blank_to_null(df: DataFrame, columns=COLUMNS) -> DataFrame:
    return df.select(*[F.expr(f"nullif(trim(`{c}`), '')").alias(c) if c in columns else F.col(c) for c in df.columns])


def standardise(column: str, spellings: dict[str, str]) -> Column:
    """Known spellings (any letter case) to their target, others unchanged."""
    pairs = [F.lit(x) for pair in spellings.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(column)), F.col(column))


def normal_date(column: str) -> Column:
    """ISO text for the known formats; NULL for impossible dates, others unchanged."""
    c = F.col(column)
    month = F.concat(F.substring(c, 1, 3), F.upper(F.substring(c, 4, 1)), F.lower(F.substring(c, 5, 2)), F.substring(c, 7, 5))
    out = c
    for pattern, form in reversed(DATE_FORMATS):
        text = month if "MMM" in form else c
        day = F.try_to_timestamp(text, F.lit(form)) if "HH" in form else F.try_to_date(text, form)
        out = F.when(c.rlike(pattern), F.date_format(day, "yyyy-MM-dd")).otherwise(out)
    return F.when(c.rlike(ISO_DATE), c).otherwise(out)


def single_value(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, value) where all known values of a key agree.

    Equal pairs are folded by hash first; only one row per pair is sorted.
    """
    pairs = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(key, column).distinct()
    found = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("_v")).where("n = 1")
    return found.select(F.col(key).alias("_k"), "_v")


def only_where(df: DataFrame, needed: str, step) -> DataFrame:
    """Apply ``step`` to the rows that need it; all others skip its shuffle.

    Complete rows never take part in the lookup join, so a key that is frequent
    among them does not gather in one task.
    """
    return step(df.where(needed)).unionByName(df.where(f"NOT coalesce({needed}, false)"))


def fill_from_group(df: DataFrame, key: str, column: str, known: DataFrame | None = None) -> DataFrame:
    """Fill NULLs of ``column`` from the one value known in the same group."""
    known = single_value(df, key, column) if known is None else known
    joined = df.join(known, F.col(key) == F.col("_k"), "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.col("_v"))).select(*df.columns)


def correct_scale(column: str, corrections: dict[str, str]) -> Column:
    """Values known to be mis-scaled, compared as numbers."""
    out = F.col(column)
    number = F.expr(f"try_cast({column} AS DECIMAL(10,4))")
    for wrong, right in corrections.items():
        out = F.when(number == F.lit(wrong).cast("decimal(10,4)"), right).otherwise(out)
    return out


def _number(column: str, kind: str = "DECIMAL(20,6)") -> str:
    return f"try_cast({column} AS {kind})"


DISCOUNT_KEY = "try_cast(discount AS DECIMAL(10,4))"


def unit_prices(df: DataFrame) -> DataFrame:
    """(product, discount) with exactly one unit price."""
    price = f"round({_number('sales')} / {_number('quantity')}, 6)"
    rows = df.where(f"sales IS NOT NULL AND {DISCOUNT_KEY} IS NOT NULL AND {_number('quantity')} > 0")
    return (rows.selectExpr("product_id AS _k", f"{DISCOUNT_KEY} AS _d", f"CAST({price} AS DECIMAL(20,6)) AS price")
            .groupBy("_k", "_d").agg(F.min("price").alias("unit_price"), F.max("price").alias("hi"))
            .where("unit_price = hi").select("_k", "_d", "unit_price"))


def unit_margins(df: DataFrame) -> DataFrame:
    """(product, discount) with at least two complete rows and one profit margin."""
    margin = f"CAST(round({_number('profit')} / {_number('sales')}, 10) AS DECIMAL(20,10))"
    rows = df.where(f"product_id IS NOT NULL AND {DISCOUNT_KEY} IS NOT NULL AND profit IS NOT NULL AND {_number('sales')} != 0")
    return (rows.selectExpr("product_id AS _k", f"{DISCOUNT_KEY} AS _d", f"{margin} AS m").groupBy("_k", "_d")
            .agg(F.min("m").alias("margin"), F.max("m").alias("hi"), F.count(F.lit(1)).alias("n"))
            .where(f"margin = hi AND n >= {LEAST_MARGIN_ROWS}").select("_k", "_d", "margin"))


def with_lookup(df: DataFrame, table: DataFrame) -> DataFrame:
    """Left join of a (product, discount) table; unknown keys match nothing."""
    return df.join(table, (F.col("product_id") == F.col("_k")) & (F.expr(DISCOUNT_KEY) == F.col("_d")), "left")


QUANTITY_FOUND = (f"quantity IS NULL AND sales IS NOT NULL AND unit_price > 0 AND round({_number('sales')} / unit_price) > 0 AND "
                  f"abs({_number('sales')} / unit_price - round({_number('sales')} / unit_price)) < {WHOLE_TOLERANCE}")
SALES_FOUND = "sales IS NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL"
PROFIT_FOUND = "profit IS NULL AND sales IS NOT NULL AND margin IS NOT NULL"


_FILLED = {
    "sales": f"if({SALES_FOUND}, string(CAST({_number('quantity')} * unit_price AS DECIMAL(20,6))), sales)",
    "quantity": f"if({QUANTITY_FOUND}, string(CAST(round({_number('sales')} / unit_price) AS BIGINT)), quantity)",
    "profit": f"if({PROFIT_FOUND}, string(CAST(round({_number('sales')} * margin, 6) AS DECIMAL(20,6))), profit)",
}


def _fill(df: DataFrame, *columns: str) -> DataFrame:
    return df.selectExpr(*[f"{_FILLED[c]} AS {c}" if c in columns else c for c in df.columns])


def fill_measures(df: DataFrame, prices: DataFrame, margins: DataFrame | None = None) -> DataFrame:
    """sales = quantity x price; quantity = sales / price when that is whole;
    then, with ``margins``, profit = sales x margin."""
    table = prices if margins is None else prices.join(margins, ["_k", "_d"], "full")
    out = _fill(with_lookup(df, table), "sales", "quantity")
    return (out if margins is None else _fill(out, "profit")).select(*df.columns)


def alias_map(df: DataFrame, name: str = "customer_name", ident: str = "customer_id", seen: str = "order_date") -> DataFrame:
    """(name, alias, canonical): of several ids with one name the first seen is kept.

    The name stays part of the key: one id may be an alias under several names.
    """
    first = df.where(f"{name} IS NOT NULL AND {ident} IS NOT NULL").groupBy(name, ident).agg(
        F.min(F.try_to_date(seen, "yyyy-MM-dd")).alias("first"))
    rank = F.struct(F.col("first").isNull(), F.col("first"), F.col(ident))
    best = first.groupBy(name).agg(F.min_by(ident, rank).alias("_canonical"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return first.join(best, name).where(F.col(ident) != F.col("_canonical")).select(
        F.col(name).alias("_name"), F.col(ident).alias("_alias"), "_canonical")


def replace_by_map(df: DataFrame, column: str, mapping: DataFrame, value: str, match: dict[str, str], home: str | None = None) -> DataFrame:
    """Overwrite ``column`` by ``value`` of the mapping row that agrees on
    ``match`` ({column: mapping column}); the mapping has one row per key. ``home`` is never NULL."""
    joined = join_lookup(df, mapping, match, home=home, homeless=False)
    return joined.withColumn(column, F.coalesce(F.col(value), F.col(column))).select(*df.columns)


def usual_value(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """(key, most frequent value) for keys with several values."""
    n = df.where(f"{key} IS NOT NULL AND {attribute} IS NOT NULL").groupBy(key, attribute).agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy(key).agg(F.max_by(attribute, F.struct("n", attribute)).alias("_usual"), F.count(F.lit(1)).alias("k"))
    return best.where("k > 1").select(F.col(key).alias("_key"), "_usual")


def tidy_rows(raw: DataFrame) -> DataFrame:
    """The steps that look at one row only, after the removal of copies."""
    df = blank_to_null(drop_copies(raw))
    return df.withColumns({
        "segment": standardise("segment", SEGMENT_SPELLINGS), "order_date": normal_date("order_date"),
        "discount": correct_scale("discount", DISCOUNT_CORRECTIONS)})


def clean_text(raw: DataFrame, aliases: DataFrame | None = None, cities: DataFrame | None = None) -> DataFrame:
    """All steps in their order; later steps see the results of earlier ones."""
    return complete_text(settle(tidy_rows(raw)), aliases, cities)


def complete_at_home(base: DataFrame, home: str, modes: DataFrame, prices: DataFrame, margins: DataFrame) -> DataFrame:
    """Modes and measures for rows parted by ``home`` (the order of ``modes``, never NULL here), which stay where they are.

    A filled measure follows from the five columns asked for, so their distinct
    values travel to the prices and margins, and what was found comes back.
    """
    measures = ["sales", "quantity", "profit"]
    asked = base.where("sales IS NULL OR quantity IS NULL OR profit IS NULL").where("product_id IS NOT NULL AND discount IS NOT NULL")
    asked = asked.select(home, "product_id", "discount", *measures).distinct().select("*", *[F.col(c).alias(f"_was_{c}") for c in measures])
    kept = all_of([F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in measures])
    found = fill_measures(asked, prices, margins).where(~kept).select(
        F.col(home).alias("_home"), F.col("product_id").alias("_product"), F.col("discount").alias("_discount"),
        *[F.col(f"_was_{c}") for c in measures], *[F.col(c).alias(f"_new_{c}") for c in measures])
    same = all_of([F.col(home) == F.col("_home"), F.col("product_id") == F.col("_product"), F.col("discount") == F.col("_discount"),
                   *[F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in measures]])
    out = base.join(by_key(found, "_home").hint("shuffle_hash"), same, "left").join(by_key(modes, "_k").hint("shuffle_hash"), F.col(home) == F.col("_k"), "left")
    new = {"ship_mode": F.coalesce("ship_mode", "_v"), **{c: F.coalesce(c, f"_new_{c}") for c in measures}}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in base.columns])


def complete_text(base: DataFrame, aliases: DataFrame | None = None, cities: DataFrame | None = None, home: str | None = None) -> DataFrame:
    """The steps that look at other rows, over settled tidy rows.

    Every lookup (mode per order, price, margin, alias, city) is a grouping of a
    few columns of ``base``, so the rows themselves pass through the joins once;
    only the margins need a second, narrow pass, because recovered sales take
    part in them.

    ``aliases`` (_name, _alias, _canonical) and ``cities`` (_key, _usual) are decisions
    of the caller: without them every id and every city stays as it is, since two
    people may share a name and two towns a code. ``alias_map`` and ``usual_value``
    propose such maps. ``home`` is ``order_id`` where ``base`` is settled in its buckets.
    """
    if home:  # read for the rows with an order and for those without
        aliases, cities = (None if m is None else settle(m) for m in (aliases, cities))
    modes = single_value(base, "order_id", "ship_mode")
    prices = settle(unit_prices(base))
    measures = base.select("product_id", "discount", "sales", "quantity", "profit")
    recovered = only_where(measures, "sales IS NULL OR quantity IS NULL", lambda rows: fill_measures(rows, prices))
    margins = unit_margins(recovered)

    def complete(rows: DataFrame) -> DataFrame:
        return fill_measures(fill_from_group(rows, "order_id", "ship_mode", modes), prices, margins)

    def completed(rows: DataFrame) -> DataFrame:
        return only_where(rows, "ship_mode IS NULL OR sales IS NULL OR quantity IS NULL OR profit IS NULL", complete)

    def replaced(df: DataFrame, home: str | None) -> DataFrame:
        if aliases is not None:
            df = replace_by_map(df, "customer_id", aliases, "_canonical", {"customer_name": "_name", "customer_id": "_alias"}, home)
        return df if cities is None else replace_by_map(df, "city", cities, "_usual", {"postal_code": "_key"}, home)

    if home is None:
        return replaced(completed(base), None)
    placed = complete_at_home(base.where(F.col(home).isNotNull()), home, modes, prices, margins)
    return replaced(placed, home).unionByName(replaced(completed(base.where(F.col(home).isNull())), None))


def _day(column: str) -> str:
    """``try_to_date`` by the ISO format; texts that plainly have it are cast, which costs less than the parser of formats."""
    return (f"if(length({column}) = 10 AND {column} RLIKE '^[1-9][0-9]{{3}}-[0-9]{{2}}-[0-9]{{2}}$', try_cast({column} AS DATE), "
            f"try_to_date({column}, 'yyyy-MM-dd'))")


CASTS = {
    "row_id": "try_cast(row_id AS BIGINT)", "order_date": _day("order_date"), "ship_date": _day("ship_date"), "sales": "try_cast(sales AS DECIMAL(15,6))",
    "quantity": "CAST(round(try_cast(quantity AS DECIMAL(20,6))) AS BIGINT)",
    "discount": "try_cast(discount AS DECIMAL(4,2))", "profit": "try_cast(profit AS DECIMAL(15,6))"}
MAY_BE_UNKNOWN = ("sales", "quantity", "profit")
UNREADABLE, RULES = "_unreadable", "_rules"  # what a row breaks by itself


def told(texts: list[Column]) -> Column:
    """Those of the different texts that are known. A row with none is told by plain tests; arrays are made only for the others,
    without lambda functions, which would take the rows out of compiled code."""
    known = F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))
    return F.when(any_of([t.isNotNull() for t in texts]), known).otherwise(F.array().cast("array<string>"))


def rejected_casts(text: DataFrame) -> DataFrame:
    """Each known measure text that is no number of the column's type; an unknown measure must stay told from an unreadable one."""
    found = F.array_compact(F.array(*[F.when(F.expr(f"{c} IS NOT NULL AND {CASTS[c]} IS NULL"), F.struct(F.lit(c).alias("measure"), F.col(c).alias("found")))
                                      for c in MAY_BE_UNKNOWN]))
    return text.select("row_id", "order_id", F.explode(found).alias("_r")).select("row_id", "order_id", "_r.measure", "_r.found")


def typed(text: DataFrame) -> DataFrame:
    """Explicit casts of the clean text; what cannot be cast becomes NULL, and measures among it are listed in ``_unreadable``."""
    if UNREADABLE in text.columns:  # told before
        return text.select(*[F.expr(CASTS[c]).alias(c) if c in CASTS else F.col(c) for c in text.columns if c != CORRUPT])
    lost = [f"if({c} IS NOT NULL AND {CASTS[c]} IS NULL, '{c}_unreadable', NULL)" for c in MAY_BE_UNKNOWN]
    if CORRUPT in text.columns:
        lost.append(f"if({CORRUPT} IS NOT NULL, 'corrupt_record', NULL)")
    return text.select(*[F.expr(CASTS[c]).alias(c) if c in CASTS else F.col(c) for c in text.columns if c != CORRUPT],
                       told([F.expr(e) for e in lost]).alias(UNREADABLE))


REQUIRED = [c for c in COLUMNS if c not in ("ship_mode", "sales", "quantity", "profit")]


def load_rules() -> dict[str, Column]:
    """Name -> test that is true for a row that breaks the rule."""
    c = F.col
    rules = {f"{name}_missing": c(name).isNull() for name in REQUIRED}
    rules.update({
        "ship_before_order": c("ship_date") < c("order_date"),
        "segment_domain": ~c("segment").isin(*SEGMENTS),
        "category_domain": ~c("category").isin(*CATEGORIES),
        "ship_mode_domain": ~c("ship_mode").isin(*SHIP_MODES),
        "sales_not_positive": c("sales") <= 0,
        "quantity_not_positive": c("quantity") <= 0,
        "discount_range": ~c("discount").between(0, 1),
    })
    return rules


def row_faults(text: DataFrame) -> DataFrame:
    """The text with what each row breaks by itself, told from its typed values: written with the text, it is told once for all
    that reads it (:func:`typed` and :func:`split_by_rules` take it from there)."""
    rows = typed(text.select("*", F.struct(*text.columns).alias("_text")))
    return rows.select("_text.*", UNREADABLE, told([F.when(test, rule) for rule, test in load_rules().items()]).alias(RULES))


@dataclass
class Loaded:
    valid: DataFrame
    quarantine: DataFrame


# Keys of the model, and what must be one value for each.
MODEL_KEYS = {
    "customer_conflict": (["customer_id"], ["customer_name", "segment"]),
    "product_conflict": (["product_id", "product_name"], ["category", "sub_category"]),
    "order_conflict": (["order_id", "customer_id", "region", "country", "state", "city", "postal_code"], ["order_date", "ship_date", "ship_mode"]),
}


def conflicting_keys(rows: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Keys under which an attribute has several values, or both a value and none.

    Each text of a key and its attributes moves once: what is distinct is counted, with no least and greatest value beside.
    """
    distinct = rows.select(*keys, *attributes).distinct()
    return distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")


def mark_conflicts(judged: DataFrame, name: str, home: str | None = None) -> DataFrame:
    """Rows that break no rule by themselves but would give one model key two rows.

    Keys are judged from their own columns, and ``judged`` is written (or parted by
    ``home``), so the wide rows meet the conflicting keys only; a heavy key does not gather in one task.
    """
    good, rest = judged.where(F.size(name) == 0), judged.where(F.size(name) > 0)
    conflicts = {rule: (keys, conflicting_keys(good, keys, attributes).select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.lit(rule).alias("_rule")))
                 for rule, (keys, attributes) in MODEL_KEYS.items()}
    marked = F.when(F.col("_rule").isNotNull(), F.array_append(name, F.col("_rule"))).otherwise(F.col(name))
    if home:  # in one pass: the rows are not written before
        out = judged.withColumn("_good", F.size(name) == 0)
        for keys, bad in conflicts.values():
            out = join_lookup(out, bad, {k: f"_c_{k}" for k in keys}, home=home).withColumn(
                name, F.when(F.col("_good"), marked).otherwise(F.col(name))).select(*judged.columns, "_good")
        return out.drop("_good")
    out = good
    for keys, bad in conflicts.values():
        out = join_lookup(out, bad, {k: f"_c_{k}" for k in keys}, home=home).withColumn(name, marked).select(*judged.columns)
    return out.unionByName(rest)


def split_by_rules(df: DataFrame, unique: str = "row_id", name: str = "broken_rules", home: str | None = None) -> DataFrame:
    """Add the list of broken rules, including a repeated key, an unreadable measure and a conflict with other rows."""
    repeated = df.where(F.col(unique).isNotNull()).groupBy(unique).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = join_lookup(df, repeated.select(F.col(unique).alias("_repeated")), {unique: "_repeated"}, home=home)
    own = F.col(RULES) if RULES in df.columns else told([F.when(test, rule) for rule, test in load_rules().items()])
    twice = F.when(F.col("_repeated").isNotNull(), F.array(F.lit(f"{unique}_repeated"))).otherwise(F.array().cast("array<string>"))
    broken = F.concat(own, twice, F.col(UNREADABLE))
    judged = marked.select(*[c for c in df.columns if c not in (UNREADABLE, RULES)], broken.alias(name))
    return mark_conflicts(judged if home else settle(judged), name, home)


def load(text: DataFrame) -> Loaded:
    """Rows that satisfy every rule, and the others with the rules they break."""
    judged = split_by_rules(typed(text))
    return Loaded(judged.where(F.size("broken_rules") == 0).drop("broken_rules"), judged.where(F.size("broken_rules") > 0))
