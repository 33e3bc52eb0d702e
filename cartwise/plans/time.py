"""Calendar features of orders.

Order totals per day of week (at most 7 keys) and per hour of day (at most
24 keys) are tiny aggregates; the planner broadcasts them by their measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.joins import CALENDAR_TOTALS, calendar_counts, orders_by
from cartwise.plans.base import cast_longs_to_double


def orders_per_dow(orders: DataFrame) -> DataFrame:
    return orders_by(orders, "order_dow", CALENDAR_TOTALS["order_dow"])


def orders_per_hour(orders: DataFrame) -> DataFrame:
    return orders_by(orders, "order_hour_of_day", CALENDAR_TOTALS["order_hour_of_day"])


def time_features(orders: DataFrame) -> DataFrame:
    """``calendar_counts`` as features: the keys by their feature names, totals as doubles."""
    return cast_longs_to_double(calendar_counts(orders).withColumnsRenamed({"order_dow": "dow", "order_hour_of_day": "hour_of_day"}))


def time_mean_constants(orders: DataFrame) -> DataFrame:
    """One row: mean order total over the day-of-week groups and over the hour groups.

    (The analysed code took the key of an arbitrary first group here; the
    intended value is the mean over groups.)
    """
    dow = orders_per_dow(orders).agg(F.avg("total_ord_count_p_dow").alias("time_mean_dow_count"))
    hour = orders_per_hour(orders).agg(F.avg("total_ord_count_p_ohod").alias("time_mean_ohod_count"))
    return dow.select("time_mean_dow_count", hour.select("time_mean_ohod_count").scalar().alias("time_mean_ohod_count"))
