"""Frame utilities: splits, projections, renames, unions, duplicate checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_train_orders(orders: DataFrame) -> DataFrame:
    """Orders used for features and training: eval_set != 'test', column dropped."""
    return orders.where(F.col("eval_set") != "test").drop("eval_set")


def filter_test_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("eval_set") == "test").select("order_id", "user_id")


def filter_prior_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("eval_set") == "prior")


def null_gap_after_first(orders: DataFrame) -> DataFrame:
    """Orders after the first one whose gap is null (should be none): one row."""
    later = orders.where(F.col("order_number") != 1)
    return later.agg(F.count(F.lit(1)).alias("orders_after_first"),
                     F.count_if(F.col("days_since_prior_order").isNull()).alias("null_gaps"))


def drop_null_gaps(orders: DataFrame) -> DataFrame:
    return orders.dropna(subset=["days_since_prior_order"]).select("order_id", "order_number",
                                                                   "days_since_prior_order")


def union_lines(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name (positional union silently mixes columns)."""
    return a.unionByName(b)


def lines_of(lines: DataFrame, orders: DataFrame, eval_set: str) -> DataFrame:
    """Lines whose order belongs to ``eval_set`` (semi-join, columns of ``lines`` only)."""
    return lines.join(orders.where(F.col("eval_set") == eval_set).select("order_id"), "order_id", "left_semi")


def duplicate_row_check(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows and distinct rows of each frame, one output row per frame."""
    parts = []
    for name, df in frames.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(name).alias("frame"), "n_rows",
                             df.distinct().agg(F.count(F.lit(1))).scalar().alias("n_distinct")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
