"""Registration helper shared by the query families."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwise.plans.assemble import FeatureSet
from cartwise.plans.base import split_inputs
from cartwise.sources.views import BasketTables, load_basket, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ROWS_ONLY: set[str] = set()


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``sql`` is its DuckDB oracle (``None`` → rows-only check)."""
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is None:
            ROWS_ONLY.add(name)
        else:
            ORACLE[name] = with_views(sql, *views) if views else sql.strip()
        return fn
    return deco


def feature_set(b: BasketTables, leak_free: bool = False) -> FeatureSet:
    """The feature set of the loaded tables, built once per load and mode."""
    return b.once(f"features-{leak_free}", lambda: FeatureSet(split_inputs(b.orders, b.lines, b.products, leak_free, b.line_facts)))


def basket(spark: SparkSession, sf_dir: str) -> BasketTables:
    """Basket tables, derived once per application and sf folder (checkpointed)."""
    return load_basket(spark, sf_dir, materialize=True)
