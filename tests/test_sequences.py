"""Hand fixtures for the two streak definitions and the co-occurrence rewrite."""

from conftest import make_lines, make_orders, make_products

from cartwise.plans import product, sequence
from cartwise.plans.base import FeatureInput


def _facts(spark, order_numbers, user=1, prod=10):
    orders = make_orders(spark, [(n, user, n, 0, 0) for n in range(1, max(order_numbers) + 1)])
    lines = make_lines(spark, [(n, prod, 1, 0) for n in order_numbers])
    return FeatureInput.of(lines, orders, make_products(spark, [(prod, "x")])).facts


def _lengths(df):
    return sorted(r.length_of_streaks for r in df.collect())


def test_streak_gap(spark):
    f = _facts(spark, [1, 2, 3, 5])
    assert _lengths(sequence.streaks_flagged(f)) == [2, 2]
    assert _lengths(sequence.streaks_islands(f)) == [1, 3]


def test_streak_no_repeat(spark):
    f = _facts(spark, [1, 3, 5])
    assert _lengths(sequence.streaks_flagged(f)) == [3]
    assert _lengths(sequence.streaks_islands(f)) == [1, 1, 1]


def test_streak_full(spark):
    f = _facts(spark, [1, 2, 3, 4])
    assert _lengths(sequence.streaks_flagged(f)) == [1, 3]
    assert _lengths(sequence.streaks_islands(f)) == [4]


def test_streak_stats_thresholds(spark):
    fi_orders = make_orders(spark, [(n, 1, n, 0, 0) for n in range(1, 6)])
    fi_lines = make_lines(spark, [(n, 10, 1, 0) for n in (1, 2, 3, 5)])
    fi = FeatureInput.of(fi_lines, fi_orders, make_products(spark, [(10, "x")]))
    row = product.product_streak_stats(fi, faithful=False).collect()[0]
    assert row.Total_streak_of_this_product == 2
    assert row.prob_of_reordered_3 == 0.5 and row.prob_of_reordered_2 == 0.5 and row.prob_of_reordered_5 == 0.0


def test_cooccurrence_fixture(spark):
    orders = make_orders(spark, [(1, 1, 1, 0, 0), (2, 1, 2, 0, 0)])
    lines = make_lines(spark, [(1, 10, 1, 0), (1, 11, 2, 0), (2, 10, 1, 1)])
    fi = FeatureInput.of(lines, orders, make_products(spark, [(10, "a"), (11, "b")]))
    got = {r.product_id: r for r in product.product_features(fi).collect()}
    assert got[10].number_of_product_co_occurred == 1.0
    assert got[10].mean_of_co_ocuured_product_per_order == 0.5
    assert got[10].min_of_co_ocuured_product_per_order == 0.0
    assert got[10].max_of_co_ocuured_product_per_order == 1.0
    assert got[11].number_of_product_co_occurred == 1.0
    assert got[11].mean_of_co_ocuured_product_per_order == 1.0
    # product 10 was bought alone in order 2 by user 1
    assert got[10].number_of_user_purchased_item == 1.0
    assert got[11].number_of_user_purchased_item == 0.0
