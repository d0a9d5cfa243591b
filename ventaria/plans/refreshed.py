"""The views kept up to date from the change log of lines and orders.

Stored are the cells (order, product) with their sums, the order rows, and a
ledger for each view. The log names the touched orders; their cells before and
after the changes give signed rows for every view above, so no line of an
untouched order is read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ventaria.functions.expressions import flag, mode_or_unknown, pct, ratio
from ventaria.functions.measures import LINE_PARTS, LINE_RATIOS, ORDER_PARTS, ORDER_RATIOS, finish
from ventaria.functions.present import present
from ventaria.operators import changelog as L
from ventaria.operators import refresh as R
from ventaria.operators.scalars import attach
from ventaria.plans.layouts import VIEWS
from ventaria.plans.views import CUSTOMER, PLACE, dimension_sizes
from ventaria.session import by_key, in_differences, settle, settle_by, stage_key, united
from ventaria.sources.tpch import Star, read_star

MOVED = 1_000_000_000_000  # key offset of added rows
RUN = {"changed_by": "nightly-load", "connection_id": 7}


HOME = "_home"


def keyed_lines(star: Star) -> DataFrame:
    """Lines with a key of their own; in the source neither the row number nor the row number and product are unique.

    They are parted by the first number of their key, which later versions of a line keep."""
    home = F.coalesce("source_row_id", "product_key", F.lit(0).cast("long"))
    lines = by_key(star.lines, home).withColumn(HOME, home)
    alike = Window.partitionBy(HOME, "source_row_id", "product_key").orderBy("sales", "quantity", "discount", "profit")  # a handful of rows each
    return lines.withColumn("line_key", F.concat_ws("-", "source_row_id", "product_key", F.row_number().over(alike)))


def later_lines(keyed: DataFrame) -> DataFrame:
    """Lines with their key after a day of changes."""
    lines = keyed.where("order_key % 20 != 0 AND source_row_id % 10 != 7").selectExpr(
        "order_key", "if(source_row_id % 10 = 5 AND product_key > 1, product_key - 1, product_key) AS product_key", "source_row_id",
        "if(source_row_id % 10 = 1, CAST(sales + 25 AS DECIMAL(15,6)), sales) AS sales", "quantity", "discount",
        "if(source_row_id % 10 = 3, NULL, profit) AS profit", "line_key", HOME,
        f"explode(if(order_key % 20 = 2, array(0L, {MOVED}L), array(0L))) AS shift")
    return lines.selectExpr("order_key + shift AS order_key", "product_key", "source_row_id + shift AS source_row_id", "sales", "quantity", "discount", "profit",
                            "if(shift > 0, concat(line_key, '+'), line_key) AS line_key", HOME)


def later_headers(headers: DataFrame, key: str = "order_key") -> DataFrame:
    """Order rows after a day of changes, under the given key."""
    changed = {
        "order_key": key, "order_id": f"string({key})", "order_date": "if(order_key % 20 = 6, date_add(order_date, 40), order_date)",
        "ship_date": "if(order_key % 20 = 6, date_add(ship_date, 40), if(order_key % 10 = 1, date_add(ship_date, 1), ship_date))",
        "shipping_days": "if(order_key % 10 = 1, shipping_days + 1, shipping_days)", "ship_mode": "if(order_key % 10 = 3, NULL, ship_mode)"}
    return headers.where("order_key % 20 != 0").selectExpr(*[f"{changed.get(c, c)} AS {c}" for c in headers.columns if c != "shift"])


def later_star(star: Star) -> Star:
    """The same tables (lines with their key) after a day of changes: orders and lines are added, changed and removed by fixed rules over their keys."""
    headers = star.headers.selectExpr("*", f"explode(if(order_key % 20 = 2, array(0L, {MOVED}L), array(0L))) AS shift")
    return Star(later_lines(keyed_lines(star)).drop(HOME), later_headers(headers, "order_key + shift"), star.products, star.customers, star.regions)


_SUMS = [(n, v) for n, how, v in LINE_PARTS if how == "sum"]
CELLS = R.Ledger(["order_key", "product_key"], [("total_order_lines", "1L"), *[(n, v) for n, v in _SUMS if n != "total_order_lines"]])
_DAYS = {"first_order_date": ("min", "order_date"), "last_order_date": ("max", "order_date")}
_SPEED = {"minimum_shipping_days": ("min", "shipping_days"), "maximum_shipping_days": ("max", "shipping_days")}


def order_ledger(keys: list[str], distinct: dict[str, list[str]]) -> R.Ledger:
    sums = [(n, "1L" if v == "1" else v) for n, how, v in ORDER_PARTS if how == "sum"]
    return R.Ledger(keys, sums, distinct, {**_DAYS, **_SPEED})


def line_ledger(keys: list[str], distinct: dict[str, list[str]]) -> R.Ledger:
    return R.Ledger(keys, [(n, n) for n, _ in _SUMS], {"distinct_customers": ["customer_id"], **distinct}, _DAYS)


_BUYERS = {"distinct_customers": ["customer_id"]}
ORDER_VIEWS = {
    "view_monthly_performance": order_ledger(["order_year", "order_month", "order_year_month"], _BUYERS),
    "view_customer_performance": order_ledger(CUSTOMER, {"distinct_locations": ["country", "state", "city", "postal_code", "region"]}),
    "view_geographic_performance": order_ledger(PLACE, {"distinct_postal_codes": ["postal_code"], **_BUYERS}),
    "view_segment_performance": order_ledger(["segment"], _BUYERS),
    "view_ship_mode_performance": order_ledger(["raw_mode"], _BUYERS),
    "view_business_overview": order_ledger([], {"total_customers": ["customer_id"]}),
}
LINE_VIEWS = {
    "view_product_performance": line_ledger(["product_key"], {}),
    "view_subcategory_performance": line_ledger(["category", "sub_category"], {"distinct_products": ["product_key"]}),
    "view_category_performance": line_ledger(["category"], {"distinct_products": ["product_key"], "distinct_subcategories": ["sub_category"]}),
}


def order_rows(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Order view rows from cells; the columns of the order view and the raw mode."""
    names = [n for n, _ in _SUMS if n in ("total_order_lines", "total_sales", "total_quantity", "total_profit", "discount_sum", "discount_lines",
                                          "unknown_sales_lines", "unknown_quantity_lines", "unknown_profit_lines")]
    folded = cells.groupBy("order_key").agg(*[F.sum(n).alias(n) for n in names], F.count(F.lit(1)).alias("distinct_products"))
    day = F.col("order_date")
    return folded.join(headers, "order_key").select(
        "*", F.year(day).alias("order_year"), F.month(day).alias("order_month"), F.date_format(day, "yyyy-MM").alias("order_year_month"),
        F.col("ship_mode").alias("raw_mode"), ratio("discount_sum", "discount_lines").alias("average_line_discount"))


def line_rows(cells: DataFrame, headers: DataFrame, products: DataFrame) -> DataFrame:
    """Cells beside the customer and day of their order and the attributes of their product."""
    return (cells.join(headers.select("order_key", "customer_id", "order_date"), "order_key")
            .join(products.select("product_key", "category", "sub_category"), "product_key"))


class Refreshed:
    """Stored views of a data set, what a change log changes of them, and the views after it; each written once per session.

    Cells, headers and what changes of them lie in buckets of their order, so folding
    and joining by it moves none of them."""

    _open: dict[tuple, "Refreshed"] = {}

    def __init__(self, star: Star, later: Star):
        self.star, self.later = star, later
        self._stored: dict[str, R.Stored] = {}

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> "Refreshed":
        key = stage_key(spark, folder)
        if key not in cls._open:
            star = read_star(spark, folder)
            cls._open[key] = cls(star, later_star(star))
        return cls._open[key]

    # ---- stored before the changes

    @cached_property
    def cells(self) -> DataFrame:
        return settle_by(CELLS.totals(by_key(self.star.lines, "order_key").withColumn(R.SIGN, F.lit(1))), "order_key")

    @cached_property
    def headers(self) -> DataFrame:
        return settle_by(by_key(self.star.headers, "order_key"), "order_key")

    @cached_property
    def orders(self) -> DataFrame:
        return settle_by(order_rows(self._known(self.cells), self.headers), "order_key")

    def _known(self, cells: DataFrame) -> DataFrame:
        return CELLS.view(cells, cells)

    def stored(self, name: str) -> R.Stored:
        if name not in self._stored:
            ledger = ORDER_VIEWS.get(name) or LINE_VIEWS[name]
            rows = self.orders if name in ORDER_VIEWS else line_rows(self._known(self.cells), self.headers, self.star.products)
            rows = rows.withColumn(R.SIGN, F.lit(1))
            totals = ledger.totals(rows)
            if name in LINE_VIEWS:
                totals = self._with_orders(ledger, totals, rows)
            totals, members = settle(totals, "zstd"), settle(ledger.members(rows), "zstd")
            self._stored[name] = R.Stored(self._counting(ledger, name), totals, members, settle(self._counting(ledger, name).view(totals, members)))
        return self._stored[name]

    # ---- the changes; a log is read once, for what is kept of it

    @cached_property
    def lines(self) -> DataFrame:
        with in_differences():  # in the order of their keys
            return settle_by(keyed_lines(self.star), HOME)

    @property
    def line_log(self) -> DataFrame:
        return L.change_log(self.lines, later_lines(self.lines), "line_key", "order_details", home=HOME, **RUN)

    @property
    def order_log(self) -> DataFrame:
        """Only the orders added under other keys come to the buckets of those."""
        added = by_key(later_headers(self.headers.where("order_key % 20 = 2"), f"order_key + {MOVED}L"), "order_key")
        return L.change_log(self.headers, united([later_headers(self.headers), added], "order_key"), "order_key", "orders", **RUN)

    @cached_property
    def _touched(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
        """Touched orders, their cells before and after (read from the stored cells and their changes), their headers before and after."""
        kinds = lambda df: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        lines = R.signed_images(self.line_log, kinds(self.later.lines))
        heads = settle_by(by_key(R.signed_images(self.order_log, kinds(self.star.headers)), "order_key"), "order_key")
        change = settle_by(CELLS.totals(by_key(lines, "order_key")), "order_key")
        touched = settle_by(united([change.select("order_key"), heads.select("order_key")], "order_key").distinct(), "order_key")
        before = self.cells.join(touched, "order_key", "left_semi")
        after = CELLS.merged(before, change, False, "order_key")
        old = self.headers.join(touched, "order_key", "left_semi")
        new = old.join(heads.select("order_key").distinct(), "order_key", "left_anti").unionByName(heads.where(f"{R.SIGN} > 0").drop(R.SIGN))
        return (touched, self._known(before), self._known(after), settle_by(old, "order_key"), settle_by(new, "order_key"))

    @cached_property
    def order_change(self) -> DataFrame:
        _, before, after, old, new = self._touched
        return settle(R.signed(order_rows(before, old), order_rows(after, new), "order_key"), "zstd")

    @cached_property
    def line_change(self) -> DataFrame:
        _, before, after, old, new = self._touched
        return settle(R.signed(line_rows(before, old, self.star.products), line_rows(after, new, self.star.products), "order_key"), "zstd")

    # ---- the views after them

    @staticmethod
    def _counting(ledger: R.Ledger, name: str) -> R.Ledger:
        """Line views also add up their orders."""
        return ledger if name in ORDER_VIEWS else R.Ledger(ledger.keys, [*ledger.sums, ("total_orders", "0")], ledger.distinct, ledger.extremes)

    @staticmethod
    def _with_orders(ledger: R.Ledger, totals: DataFrame, rows: DataFrame) -> DataFrame:
        """Signed number of orders per key: all cells of a touched order are known, so an order counts once before and once after."""
        each = rows.groupBy(*ledger.keys, "order_key", R.SIGN).agg(F.lit(1).alias("one"))
        counted = each.groupBy(*ledger.keys).agg(F.sum(R.SIGN).cast("long").alias("total_orders")).withColumnsRenamed({k: f"_t_{k}" for k in ledger.keys})
        joined = totals.join(counted, R.same_keys(totals, counted, ledger.keys))
        return joined.select(*totals.columns, "total_orders", F.col(R.ROWS).alias(f"{R.KNOWN}total_orders"))

    def view(self, name: str) -> DataFrame:
        kept = self.stored(name)
        if name in ORDER_VIEWS:
            return finish(kept.refreshed(self.order_change), ORDER_RATIOS)
        change, led = self.line_change, kept.ledger
        plain = LINE_VIEWS[name]
        totals = self._with_orders(plain, plain.totals(change), change)
        touched = change.select(*led.keys).distinct()
        now = led.view(led.merged(R.touched_only(kept.totals, touched, led.keys, "left_semi"), totals, False),
                       led.merged(R.touched_only(kept.members, touched, led.keys, "left_semi"), led.members(change), True))
        kinds = {f.name: f.dataType for f in kept.shown.schema.fields}
        now = now.select(*[F.col(c).cast(kinds[c]).alias(c) for c in kept.shown.columns])
        return finish(R.touched_only(kept.shown, touched, led.keys, "left_anti").unionByName(now), LINE_RATIOS)


def order_summary(r: Refreshed) -> DataFrame:
    """Stored rows of untouched orders beside the touched ones as they are now."""
    touched, _, after, _, new = r._touched
    return r.orders.join(touched, "order_key", "left_anti").unionByName(order_rows(after, new))


def business_overview(r: Refreshed) -> DataFrame:
    total = r.view("view_business_overview")
    for size in dimension_sizes(r.later):
        total = attach(total, size)
    lines = F.col("total_order_lines")
    return total.select(
        "*", (F.date_diff("last_order_date", "first_order_date") + 1).alias("analysis_period_days"),
        ratio("total_orders", "total_customers").alias("average_orders_per_customer"),
        F.col("unknown_ship_mode_orders").alias("orders_with_unknown_ship_mode"),
        *[pct(lines - F.col(f"unknown_{m}_lines"), lines).alias(f"{m}_coverage_percentage") for m in ("sales", "quantity", "profit")])


def ship_modes(r: Refreshed) -> DataFrame:
    return r.view("view_ship_mode_performance").select(
        "*", mode_or_unknown("raw_mode").alias("ship_mode"), flag(F.col("raw_mode").isNull()).alias("is_unknown_ship_mode"))


_BUILD = {
    "view_order_summary": order_summary, "view_business_overview": business_overview, "view_ship_mode_performance": ship_modes,
    "view_product_performance": lambda r: r.view("view_product_performance").join(r.star.products, "product_key"),
    **{n: (lambda r, n=n: r.view(n)) for n in ("view_monthly_performance", "view_customer_performance", "view_geographic_performance",
                                               "view_segment_performance", "view_subcategory_performance", "view_category_performance")},
}


def _report(name: str):
    return lambda r: present(_BUILD[name](r), VIEWS[name])


REPORTS = {f"{name}_refreshed": _report(name) for name in _BUILD}
