"""All named queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ventaria.functions.present import present
from ventaria.operators.reconcile import doubles
from ventaria.plans import audit, business, category, customer, display, geography, logistics, period, product, quality, refreshed, views
from ventaria.plans.book import Book
from ventaria.plans.layouts import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

_VIEWS = {
    "view_order_summary": lambda b: b.orders,
    "view_monthly_performance": lambda b: b.months,
    "view_subcategory_performance": lambda b: b.subcategories,
    "view_customer_performance": lambda b: b.customers,
    "view_geographic_performance": lambda b: b.cities,
    "view_product_performance": lambda b: b.products,
    "view_segment_performance": lambda b: views.segment_performance(b.orders),
    "view_ship_mode_performance": lambda b: views.ship_mode_performance(b.orders),
    "view_category_performance": lambda b: b.categories,
    "view_business_overview": lambda b: b.overview,
}


def _from_book(build: Callable[[Book], DataFrame]) -> Query:
    return lambda spark, folder: build(Book.open(spark, folder))


def _from_sheets(build) -> Query:
    return lambda spark, folder: build(quality.Sheets.open(spark, folder))


def _from_snapshots(build) -> Query:
    return lambda spark, folder: build(audit.Snapshots.open(spark, folder))


def _from_refreshed(build) -> Query:
    return lambda spark, folder: build(refreshed.Refreshed.open(spark, folder))


def _view(name: str, build: Callable[[Book], DataFrame]) -> Query:
    return lambda spark, folder: present(build(Book.open(spark, folder)), VIEWS[name])


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {"view_sales_detail": _from_book(lambda b: doubles(b.detail))}
    out.update({name: _view(name, build) for name, build in _VIEWS.items()})
    for module in MODULES:
        out.update({name: _from_book(f) for name, f in module.REPORTS.items()})
    out.update({name: _from_sheets(f) for name, f in quality.REPORTS.items()})
    out.update({name: _from_snapshots(f) for name, f in audit.REPORTS.items()})
    out.update({name: _from_refreshed(f) for name, f in refreshed.REPORTS.items()})
    return out


MODULES = [business, category, product, customer, display, geography, logistics, period]
