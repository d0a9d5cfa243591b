"""Flat clean sales -> ten related tables, and back to the star the views use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ventaria.functions.expressions import all_of
from ventaria.operators.ordering import number_rows
from ventaria.operators.scalars import attach
from ventaria.session import by_key, parted_by_one, settle
from ventaria.sources.tpch import Star

PLACE = ["region", "country", "state", "city", "postal_code"]


@dataclass
class Snowflake:
    segments: DataFrame
    ship_modes: DataFrame
    regions: DataFrame
    categories: DataFrame
    sub_categories: DataFrame
    locations: DataFrame
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_details: DataFrame


def lookup(clean: DataFrame, column: str, name: str, key: str) -> DataFrame:
    """Known values of a small domain, numbered in their order."""
    values = clean.where(F.col(column).isNotNull()).select(F.col(column).alias(name)).distinct()
    return values.select(F.row_number().over(Window.orderBy(name)).alias(key), name)


def numbered(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Dense surrogate keys in natural-key order, assigned by many tasks."""
    out = number_rows(rows, order, position=key)
    return out.select(key, *rows.columns)


def extend(existing: DataFrame, candidates: DataFrame, key: str, natural: list[str], order: str) -> DataFrame:
    """Existing rows plus the candidates whose natural key is new, numbered on."""
    known = existing.select(*[F.col(n).alias(f"_e_{n}") for n in natural])
    same = all_of([F.col(n).eqNullSafe(F.col(f"_e_{n}")) for n in natural])
    fresh = numbered(candidates.distinct().join(known, same, "left_anti"), "_new", order)
    last = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("_last"))
    added = attach(fresh, last).select((F.col("_new") + F.col("_last")).alias(key), *candidates.columns)
    return existing.unionByName(added)


def product_code(ident: str, name: str) -> Column:
    """Number that stands for the code and name of a product; NULL where one of them is."""
    return F.when(F.col(ident).isNotNull() & F.col(name).isNotNull(), F.xxhash64(ident, name))


def shared_codes(goods: DataFrame, code=product_code) -> list[int]:
    """Numbers that stand for several of the products; next to none, as they have 64 bits."""
    pairs = goods.select("product_id", "product_name").distinct()
    several = pairs.groupBy(code("product_id", "product_name").alias("code")).agg(F.count(F.lit(1)).alias("n")).where("code IS NOT NULL AND n > 1")
    return [r["code"] for r in several.collect()]


def with_product(rows: DataFrame, products: DataFrame, shared: list[int], code=product_code) -> DataFrame:
    """The rows beside their ``product_key``. They meet the products by number; only where a number is
    shared do the texts travel too, and decide."""
    doubtful = F.col("_code").isin(shared) if shared else F.lit(False)
    coded = rows.withColumn("_code", code("product_id", "product_name")).select(
        *[c for c in rows.columns if c not in ("product_id", "product_name")], "_code",
        *[F.when(doubtful, F.col(c)).alias(f"_{c}") for c in ("product_id", "product_name")])
    keys = products.select("product_key", code("source_product_id", "product_name").alias("_coded"), F.col("source_product_id").alias("_id"), F.col("product_name").alias("_name"))
    same = F.col("_code") == F.col("_coded")
    if shared:
        same = same & (~doubtful | ((F.col("_product_id") == F.col("_id")) & (F.col("_product_name") == F.col("_name"))))
    return coded.join(keys, same)


def normalise(clean: DataFrame) -> Snowflake:
    """Parents before children. ``clean`` is read for every table: settle it first.

    Facts meet the keys on natural columns: one join for the order, one for the
    product; the small lookups are joined to the dimension rows instead.
    """
    segments = settle(lookup(clean, "segment", "segment_name", "segment_id"))
    ship_modes = settle(lookup(clean, "ship_mode", "ship_mode_name", "ship_mode_id"))
    regions = settle(lookup(clean, "region", "region_name", "region_id"))
    categories = settle(lookup(clean, "category", "category_name", "category_id"))

    kinds = clean.where("sub_category IS NOT NULL").select("category", F.col("sub_category").alias("sub_category_name")).distinct()
    kinds = kinds.join(categories, F.col("category") == F.col("category_name")).select("category_id", "sub_category_name")
    sub_categories = numbered(kinds, "sub_category_id", "category_id, sub_category_name")

    places = clean.select(*PLACE).distinct().dropna()
    places = places.join(regions, F.col("region") == F.col("region_name")).select("region_id", "country", "city", "state", "postal_code")
    locations = numbered(places, "location_id", "country, state, city, postal_code, region_id")

    people = clean.where("customer_id IS NOT NULL AND customer_name IS NOT NULL").select("customer_id", "segment", "customer_name").distinct()
    customers = settle(people.join(segments, F.col("segment") == F.col("segment_name")).select("customer_id", "segment_id", "customer_name"))

    goods = settle(clean.where("product_id IS NOT NULL AND product_name IS NOT NULL").select("product_id", "category", "sub_category", "product_name").distinct())
    shared = shared_codes(goods)
    named = sub_categories.join(categories, "category_id")
    goods = goods.join(named, (F.col("category") == F.col("category_name")) & (F.col("sub_category") == F.col("sub_category_name")))
    goods = goods.select(F.col("product_id").alias("source_product_id"), "sub_category_id", "product_name")
    products = numbered(goods, "product_key", "source_product_id, product_name, sub_category_id")

    placed = settle(locations.join(regions, "region_id").select("location_id", F.col("region_name").alias("region"), "country", "state", "city", "postal_code"))
    headers = clean.select("order_id", "customer_id", "ship_mode", "order_date", "ship_date", *PLACE).distinct()
    headers = (
        headers.join(customers.select("customer_id").distinct(), "customer_id", "left_semi").join(placed, PLACE)
        .join(ship_modes, F.col("ship_mode") == F.col("ship_mode_name"), "left")
        .select(F.col("order_id").alias("source_order_id"), "customer_id", "location_id", "ship_mode_id", "order_date", "ship_date")
    )
    orders = numbered(headers, "order_key", "source_order_id, customer_id, location_id, ship_mode_id, order_date, ship_date")

    natural = (  # the narrow orders move to the rows; names are put to them there
        by_key(orders, "source_order_id").join(placed, "location_id").join(ship_modes, "ship_mode_id", "left")
        .select("order_key", *[F.col(c).alias(f"_{c}") for c in ("source_order_id", "customer_id", "order_date", "ship_date", *PLACE)],
                F.col("ship_mode_name").alias("_mode"))
    )
    same_order = all_of([F.col("order_id") == F.col("_source_order_id"), F.col("ship_mode").eqNullSafe(F.col("_mode"))]
                        + [F.col(c) == F.col(f"_{c}") for c in ("customer_id", "order_date", "ship_date", *PLACE)])
    facts = with_product(clean.join(natural, same_order), products, shared).select(
        F.col("row_id").alias("source_row_id"), "order_key", "product_key", "sales", "quantity", "discount", "profit")
    with parted_by_one(clean.sparkSession):
        order_details = numbered(facts, "order_detail_key", "source_row_id, order_key, product_key")
    return Snowflake(segments, ship_modes, regions, categories, sub_categories, locations, customers, products, orders, order_details)


def star_of(model: Snowflake) -> Star:
    """Resolve the lookups, so every view runs over the normalised tables too."""
    people = model.customers.join(model.segments, "segment_id").select("customer_id", "customer_name", F.col("segment_name").alias("segment"))
    places = model.locations.join(model.regions, "region_id")
    headers = (
        model.orders.join(people, "customer_id").join(places, "location_id").join(model.ship_modes, "ship_mode_id", "left")
        .select("order_key", F.col("source_order_id").alias("order_id"), "order_date", "ship_date",
                F.date_diff("ship_date", "order_date").alias("shipping_days"), F.col("ship_mode_name").alias("ship_mode"),
                "customer_id", "customer_name", "segment", "country", "state", "city", "postal_code", F.col("region_name").alias("region"))
    )
    products = model.products.join(model.sub_categories, "sub_category_id").join(model.categories, "category_id").select(
        "product_key", F.col("source_product_id").alias("product_id"), "product_name",
        F.col("category_name").alias("category"), F.col("sub_category_name").alias("sub_category"))
    lines = model.order_details.select("order_key", "product_key", "source_row_id", "sales", F.col("quantity").cast("int").alias("quantity"), "discount", "profit")
    return Star(lines, headers, products, model.customers.select("customer_id"), model.regions.select(F.col("region_name").alias("region")))
