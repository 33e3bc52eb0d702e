"""Invariants of the feature frames on the driver's smallest tables."""

import pytest
from conftest import SF_SMALL, make_lines, make_orders, make_products
from pyspark.sql import functions as F

from cartwise.plans import assemble, product, sequence, user, user_product
from cartwise.plans.base import FeatureInput, split_inputs
from cartwise.sources.views import load_basket


@pytest.fixture(scope="module")
def tables(spark):
    return load_basket(spark, SF_SMALL)


@pytest.fixture(scope="module")
def fi(tables):
    return split_inputs(tables.orders, tables.lines, tables.products)


def test_lines_unique_per_order_product(tables):
    assert tables.lines.groupBy("order_id", "product_id").count().where("count > 1").count() == 0


def test_train_frame_shape_and_rows(tables, fi):
    tf = assemble.train_frame(tables.orders, tables.lines, tables.products)
    assert tuple(tf.columns) == assemble.TRAIN_COLUMNS and len(tf.columns) == 37
    assert tf.count() == fi.lines.count()  # joins do not multiply rows


def test_test_frame_shape_and_unique(tables):
    te = assemble.test_frame(tables.orders, tables.lines, tables.products)
    assert tuple(te.columns) == assemble.TEST_COLUMNS and len(te.columns) == 36
    assert te.count() == te.select("user_id", "product_id").distinct().count()
    cands = assemble.candidates(tables.orders, tables.lines)
    assert te.count() == cands.count()


def test_feature_frames_unique_on_keys(fi):
    assert user.user_features(fi).groupBy("user_id").count().where("count > 1").count() == 0
    assert product.product_features(fi).groupBy("product_id").count().where("count > 1").count() == 0
    up = user_product.user_product_features(fi)
    assert up.groupBy("user_id", "product_id").count().where("count > 1").count() == 0


def test_dow_distribution_sums_to_count(fi):
    d = product.product_dow_distribution(fi)
    c = product.product_purchase_count(fi)
    total = sum(F.col(f"distrib_count_of_dow_{i}_p_prod") for i in range(7))
    bad = d.join(c, "product_id").where(total != F.col("product_count")).count()
    assert bad == 0


def test_streak_lengths_sum_to_orders(fi):
    for streaks in (sequence.streaks_flagged(fi.facts), sequence.streaks_islands(fi.facts)):
        s = streaks.groupBy("user_id", "product_id").agg(F.sum("length_of_streaks").alias("s"))
        n = user_product.user_product_orders(fi)
        assert s.join(n, ["user_id", "product_id"]).where(F.col("s") != F.col("num_of_ord_purch_p_prod")).count() == 0


def test_leak_free_frame_labels(tables):
    tf = assemble.train_frame(tables.orders, tables.lines, tables.products, leak_free=True)
    assert tuple(tf.columns) == assemble.TRAIN_COLUMNS
    assert set(r[0] for r in tf.select("reordered").distinct().collect()) <= {0, 1}
    # every positive label is a product of the user's train order
    train_orders = tables.orders.where("eval_set = 'train'").select("order_id", "user_id")
    truth = tables.lines.join(train_orders, "order_id").select("user_id", "product_id")
    pos = tf.where("reordered = 1").select("user_id", "product_id")
    assert pos.join(truth, ["user_id", "product_id"], "left_anti").count() == 0


def test_check_columns_raises(spark, fi):
    fs = assemble.FeatureSet(fi)
    bad = spark.createDataFrame([(1,)], "user_id long")
    with pytest.raises(ValueError, match="product_id"):
        assemble.test_frame_from(fs, bad)
    with pytest.raises(ValueError, match="test_set: product_id, user_id"):
        assemble.test_frame_from(fs, spark.createDataFrame([(1,)], "x long"))


def test_user_features_hand_fixture(spark):
    # one user: order 1 {10, 11 (reorder null)}, order 2 {10 reordered}, order 3 {12}
    orders = make_orders(spark, [(1, 7, 1, 0, 8), (2, 7, 2, 1, 9), (3, 7, 3, 1, 9)])
    lines = spark.createDataFrame([(1, 10, 1, 0), (1, 11, 2, None), (2, 10, 1, 1), (3, 12, 1, 0)],
                                  "order_id long, product_id long, add_to_cart_order int, reordered int")
    products = make_products(spark, [(10, "Red apple"), (11, "pear"), (12, "green cheese")])
    fi = FeatureInput.of(lines, orders, products)
    u = user.user_features(fi).collect()[0]
    assert u.frequency_of_reorder == 3.0  # count of non-null labels
    assert u.count_of_asian_org_items == 2.0 and u.mean_of_asian_org_items == pytest.approx(2 / 3)
    assert (u.max_count_of_products, u.min_count_of_products) == (2.0, 1.0)
    assert u.count_ord_no_prev_purchased_items == 2.0
    assert user.user_reorder_count(fi).collect()[0].reorder_count == 1
    assert user.user_peak_hour_visits(fi).collect()[0].maximum_frquency == 2


def test_unused_make_lines_helper(spark):
    assert make_lines(spark, [(1, 2, 1, 0)]).count() == 1
