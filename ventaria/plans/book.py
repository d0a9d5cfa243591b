"""Lazy access to the shared inputs of the reports."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ventaria.functions.measures import roll_up
from ventaria.plans import views
from ventaria.sources.tpch import Star, read_star


class Book:
    """One data set: its star, line view and order view, built on first use."""

    def __init__(self, star: Star):
        self.star = star

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> "Book":
        return cls(read_star(spark, folder))

    @cached_property
    def detail(self) -> DataFrame:
        return views.sales_detail(self.star)

    @cached_property
    def orders(self) -> DataFrame:
        return views.order_summary(self.star)

    def facts(self, header: tuple[str, ...] = (), product: tuple[str, ...] = ()) -> DataFrame:
        return views.facts(self.star, header, product)

    def totals(self, *keys: str) -> DataFrame:
        """Line measures per product attribute, without order and customer counts."""
        return roll_up(self.star.lines, self.star.products.select("product_key", *[k for k in keys if k != "product_key"]), "product_key", list(keys))

    @property
    def months(self) -> DataFrame:
        return views.monthly_performance(self.orders)

    @property
    def categories(self) -> DataFrame:
        return views.category_performance(self.star)

    @property
    def subcategories(self) -> DataFrame:
        return views.subcategory_performance(self.star)

    @property
    def products(self) -> DataFrame:
        return views.product_performance(self.star)

    @property
    def customers(self) -> DataFrame:
        return views.customer_performance(self.orders)

    @property
    def cities(self) -> DataFrame:
        return views.geographic_performance(self.orders)

    @property
    def overview(self) -> DataFrame:
        return views.business_overview(self.star, self.orders)


def narrow(df: DataFrame, *names: str) -> DataFrame:
    """Keep what a report needs before its rows are written out or ranked."""
    return df.select(*dict.fromkeys(n for n in names if n in df.columns))
