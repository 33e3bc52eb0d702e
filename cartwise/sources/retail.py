"""Loader of the four retail tables: orders, prior lines, train lines, products.

Each is ``<folder>/<name>.csv`` (header, every column read as text and cast in
bulk) or ``<folder>/<name>.parquet``. Lines get their order's attributes,
eval_set and basket size in one join and are written once, partitioned by
eval_set, as the feature plans expect. A line whose order is absent is kept
in the stored lines with a null user and a null eval_set: it enters no feature and is
counted by ``lines_without_order``. Cells that do not parse are counted by ``rejected``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.plans.base import ORDER_ATTRS, basket_sizes
from cartwise.session import materialize
from cartwise.sources.csv_io import reject_counts, scan_csv_checked, scan_csv_untyped
from cartwise.sources.views import BasketTables

TYPES = {
    "orders": {"order_id": "long", "user_id": "long", "order_number": "int", "order_dow": "int", "order_hour_of_day": "int",
               "days_since_prior_order": "double"},
    "order_products__prior": {"order_id": "long", "product_id": "long", "add_to_cart_order": "int", "reordered": "int"},
    "order_products__train": {"order_id": "long", "product_id": "long", "add_to_cart_order": "int", "reordered": "int"},
    "products": {"product_id": "long", "aisle_id": "long", "department_id": "long"},
}


def read(spark: SparkSession, folder: str, name: str, kind: str) -> DataFrame:
    if kind == "csv":
        return scan_csv_untyped(spark, f"{folder}/{name}.csv", TYPES[name])
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    """(table, column, reason, n_rejected): cells of the CSV tables that ``read`` takes as null, and lines with
    a wrong number of fields (null column; they are read with what fields they have)."""
    counts = (reject_counts(scan_csv_checked(spark, f"{folder}/{name}.csv", types)[1]).select(F.lit(name).alias("table"), "*")
              for name, types in TYPES.items())
    return reduce(DataFrame.unionByName, counts)


def lines_without_order(tables: BasketTables) -> DataFrame:
    """(reason, n_lines): lines that enter no feature, as ``views.dropped_rows`` lists them for the star schema."""
    return tables.line_facts.where(F.col("eval_set").isNull()).agg(F.count("*").alias("n_lines")).where("n_lines > 0").select(
        F.lit("no order").alias("reason"), "n_lines")


def load_retail(spark: SparkSession, folder: str, kind: str = "csv") -> BasketTables:
    orders = materialize(read(spark, folder, "orders", kind), "retail-orders", partition_by=["eval_set"])
    lines = read(spark, folder, "order_products__prior", kind).unionByName(read(spark, folder, "order_products__train", kind))
    per_order = basket_sizes(lines).join(orders.select("order_id", *ORDER_ATTRS, "eval_set"), "order_id", "left")
    facts = materialize(lines.join(per_order, "order_id", "left"), "retail-lines", partition_by=["eval_set"])
    products = read(spark, folder, "products", kind)
    none = spark.createDataFrame([], "id long, name string")
    return BasketTables(orders=orders, lines=facts.select(*lines.columns), line_facts=facts, products=products,
                        aisles=none, departments=none, visits=orders.limit(0))
