"""User × product features: one row per (user_id, product_id), one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.plans.base import FeatureInput, cast_longs_to_double

UP_FEATURES = ("num_of_ord_purch_p_prod", "prod_mean_of_position_p_user", "num_of_prod_co_ocrd_p_usr_p_prod")


def user_product_orders(fi: FeatureInput) -> DataFrame:
    return fi.facts.groupBy("user_id", "product_id").agg(F.count("order_id").alias("num_of_ord_purch_p_prod"))


def user_product_position(fi: FeatureInput) -> DataFrame:
    return (fi.facts.groupBy("user_id", "product_id")
            .agg(F.avg("add_to_cart_order").alias("prod_mean_of_position_p_user")))


def user_product_cooccurrence(fi: FeatureInput) -> DataFrame:
    """Other products bought together with the product, summed over the user's orders."""
    return (fi.facts.groupBy("user_id", "product_id")
            .agg(F.sum(F.col("basket_size") - 1).alias("num_of_prod_co_ocrd_p_usr_p_prod")))


def user_product_features(fi: FeatureInput) -> DataFrame:
    up = fi.facts.groupBy("user_id", "product_id").agg(
        F.count("order_id").alias("num_of_ord_purch_p_prod"),
        F.avg("add_to_cart_order").alias("prod_mean_of_position_p_user"),
        F.sum(F.col("basket_size") - 1).alias("num_of_prod_co_ocrd_p_usr_p_prod"),
    )
    return cast_longs_to_double(up)
