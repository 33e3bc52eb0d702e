"""Product features: one row per product_id.

Line-level features (position, one-shot buyers, co-occurrence, day-of-week
distribution, support) are one aggregate over the shared line facts; the
streak features are a second aggregate over the per-(user, product)
sequences. A popular product is a hot key only for the final merge of
partial aggregates, which is bounded by the number of map tasks; the
distinct-user count is planned by Spark with a first aggregation on
(product, user), so a hot product is spread across users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.plans import sequence
from cartwise.plans.base import FeatureInput, cast_longs_to_double

DOW_VALUES = tuple(range(7))


def product_purchase_count(fi: FeatureInput) -> DataFrame:
    return fi.lines.groupBy("product_id").agg(F.count("order_id").alias("product_count"))


def product_mean_position(fi: FeatureInput) -> DataFrame:
    return fi.lines.groupBy("product_id").agg(F.avg("add_to_cart_order").alias("product_mean_of_position"))


def product_one_shot_users(fi: FeatureInput) -> DataFrame:
    """Users who bought the product in a single-item order (0 when none)."""
    return fi.facts.groupBy("product_id").agg(
        F.count_distinct(F.when(F.col("basket_size") == 1, F.col("user_id"))).alias("number_of_user_purchased_item"))


def cooccurrence_per_line(fi: FeatureInput) -> DataFrame:
    """Other products in the line's order, without emitting product pairs.

    For lines unique per (order, product) the pairwise count
    ``#{b in order : b.product != a.product}`` equals ``basket_size - 1``.
    """
    return fi.facts.select("order_id", "product_id", "user_id",
                           (F.col("basket_size") - 1).alias("count_of_co_ocuured_product_per_order"))


def product_cooccurrence_total(fi: FeatureInput) -> DataFrame:
    return (cooccurrence_per_line(fi).groupBy("product_id")
            .agg(F.sum("count_of_co_ocuured_product_per_order").alias("number_of_product_co_occurred")))


def product_cooccurrence_stats(fi: FeatureInput) -> DataFrame:
    c = F.col("count_of_co_ocuured_product_per_order")
    return (cooccurrence_per_line(fi).groupBy("product_id").agg(
        F.avg(c).alias("mean_of_co_ocuured_product_per_order"),
        F.min(c).alias("min_of_co_ocuured_product_per_order"),
        F.max(c).alias("max_of_co_ocuured_product_per_order")))


def product_dow_distribution(fi: FeatureInput) -> DataFrame:
    """Lines per day of week of the order, 7 columns, 0 when absent.

    The pivot values are fixed (0..6), so no value-discovery job runs and
    the pivot is a single aggregate with conditional counts.
    """
    return fi.facts.groupBy("product_id").agg(
        *[F.count_if(F.col("order_dow") == d).alias(f"distrib_count_of_dow_{d}_p_prod") for d in DOW_VALUES])


def pivot_order_dow(orders: DataFrame) -> DataFrame:
    """Order × day-of-week one-hot (null → 0).

    Orders are unique per order_id, so the grouped pivot of the analysed
    code is a per-row projection here: no shuffle.
    """
    return orders.select("order_id", *[
        F.when(F.col("order_dow") == d, 1).otherwise(0).alias(str(d)) for d in DOW_VALUES])


def total_orders(orders: DataFrame) -> F.Column:
    """Scalar subquery: distinct orders (one small aggregate job, no driver round trip)."""
    return orders.select(F.count_distinct("order_id")).scalar()


def product_order_support(fi: FeatureInput) -> DataFrame:
    """``prob_of_being_reordered``: lines of the product / all distinct orders."""
    return (fi.facts.groupBy("product_id").agg(F.count("order_id").alias("n"))
            .select("product_id", (F.col("n") / total_orders(fi.orders)).alias("prob_of_being_reordered")))


def product_streak_stats(fi: FeatureInput, faithful: bool = True,
                         thresholds: tuple[int, ...] = (5, 3, 2)) -> DataFrame:
    s = sequence.streaks_flagged(fi.facts) if faithful else sequence.streaks_islands(fi.facts)
    return sequence.streak_stats(s, thresholds)


PRODUCT_FEATURES = (
    "product_mean_of_position", "number_of_user_purchased_item", "number_of_product_co_occurred",
    "mean_of_co_ocuured_product_per_order", "min_of_co_ocuured_product_per_order",
    "max_of_co_ocuured_product_per_order", "Total_streak_of_this_product",
    "mean_of_streaks_of_this_product", "min_of_streaks_of_this_product",
    "max_of_streaks_of_this_product", "prob_of_reordered_5", "prob_of_reordered_3",
    "prob_of_reordered_2",
    *[f"distrib_count_of_dow_{d}_p_prod" for d in DOW_VALUES],
    "prob_of_being_reordered",
)


def product_features(fi: FeatureInput, faithful_streaks: bool = True) -> DataFrame:
    """All 21 product features: one line-level aggregate ⟕ one streak aggregate."""
    co = F.col("basket_size") - 1
    lines_agg = fi.facts.groupBy("product_id").agg(
        F.avg("add_to_cart_order").alias("product_mean_of_position"),
        F.count_distinct(F.when(F.col("basket_size") == 1, F.col("user_id"))).alias("number_of_user_purchased_item"),
        F.sum(co).alias("number_of_product_co_occurred"),
        F.avg(co).alias("mean_of_co_ocuured_product_per_order"),
        F.min(co).alias("min_of_co_ocuured_product_per_order"),
        F.max(co).alias("max_of_co_ocuured_product_per_order"),
        *[F.count_if(F.col("order_dow") == d).alias(f"distrib_count_of_dow_{d}_p_prod") for d in DOW_VALUES],
        F.count("order_id").alias("_n_lines"),
    )
    lines_agg = (lines_agg.withColumn("prob_of_being_reordered", F.col("_n_lines") / total_orders(fi.orders))
                 .drop("_n_lines"))
    streaks = product_streak_stats(fi, faithful_streaks)
    out = lines_agg.join(streaks, "product_id", "left").select("product_id", *PRODUCT_FEATURES)
    return cast_longs_to_double(out)
