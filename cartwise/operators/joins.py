"""Equi-joins of the basket model.

Physical strategy is left to Spark: with AQE on, a side whose *measured*
shuffle output is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
is broadcast at run time; otherwise the join stays a sort-merge join, and a
skewed key is split by the AQE skew-join rule. There are no broadcast hints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: The total of orders that goes with each calendar column.
CALENDAR_TOTALS = {"order_dow": "total_ord_count_p_dow", "order_hour_of_day": "total_ord_count_p_ohod"}


def lines_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines ⟕ orders on order_id."""
    return lines.join(orders, "order_id", "left")


def lines_products(lines: DataFrame, products: DataFrame, how: str = "left") -> DataFrame:
    return lines.join(products, "product_id", how)


def orders_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders ⟕ lines: orders without lines are kept with null product."""
    return orders.join(lines, "order_id", "left")


def snowflake_products(products: DataFrame, departments: DataFrame, aisles: DataFrame) -> DataFrame:
    return products.join(departments, "department_id", "inner").join(aisles, "aisle_id", "inner")


def order_line_dept(orders: DataFrame, lines: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    return (orders.join(lines, "order_id", "left")
            .join(products, "product_id", "left")
            .join(departments, "department_id", "left"))


def cooccurrence_counts(lines: DataFrame) -> DataFrame:
    """Per line, the number of lines of the same order with a different product.

    Equivalent to the self-join ``a.order_id = b.order_id AND a.product_id <>
    b.product_id`` followed by a count per (a.order_id, a.product_id), but
    without materialising any pair: basket size and per-product copies come
    from two grouped counts and the result is ``basket_size - copies``. Holds
    also when a product occurs twice in an order.
    """
    per_pair = lines.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("copies"))
    per_order = lines.groupBy("order_id").agg(F.count("product_id").alias("basket_size"))
    return (per_pair.join(per_order, "order_id")
            .select("order_id", "product_id",
                    (F.col("copies") * (F.col("basket_size") - F.col("copies"))).alias("n_co_occurring")))


def composite_key(left: DataFrame, right: DataFrame, keys=("user_id", "product_id"), how: str = "left") -> DataFrame:
    return left.join(right, list(keys), how)


def orders_by(orders: DataFrame, column: str, name: str) -> DataFrame:
    return orders.groupBy(column).agg(F.count("order_id").alias(name))


def calendar_counts(orders: DataFrame) -> DataFrame:
    """Orders ⟕ per-dow totals ⟕ per-hour totals; AQE broadcasts the small sides by their measured size."""
    kept = orders.select("user_id", "order_id", "order_dow", "order_hour_of_day")
    for column, name in CALENDAR_TOTALS.items():
        kept = kept.join(orders_by(orders, column, name), column, "left")
    return kept
