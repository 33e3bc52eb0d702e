"""Feature queries: user, product, user×product, time, sequences, frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwise.plans import assemble, product, sequence, time, user, user_product
from cartwise.plans.base import split_inputs
from cartwise.registry.base import basket, feature_set, register
from cartwise.registry.sqlfrag import PRODUCT_COLS, UP_COLS, USER_COLS, compose, r6
from cartwise.functions.scalar import round_doubles


def _fi(spark, sf_dir, leak_free=False):
    b = basket(spark, sf_dir)
    return split_inputs(b.orders, b.lines, b.products, leak_free=leak_free, line_facts=b.line_facts)


def _fim(spark, sf_dir):
    """Feature inputs with the line facts written once: ordered (sequence)
    computations read them twice (hot-group check, then the windows)."""
    return _fi(spark, sf_dir).materialize()


# ---------------------------------------------------------------- user
@register("user_item_count", compose(
    "SELECT user_id, CAST(frequency_of_reorder AS BIGINT) AS frequency_of_reorder FROM uf_reord", "uf_reord"))
def q_user_item_count(spark, sf_dir):
    return user.user_item_count(_fi(spark, sf_dir))


@register("user_reorder_count", compose("""
SELECT o.user_id, CAST(coalesce(sum(l.reordered), 0) AS BIGINT) AS reorder_count
FROM fl l LEFT JOIN fo o ON l.order_id = o.order_id GROUP BY o.user_id""", "fl", "fo"))
def q_user_reorder_count(spark, sf_dir):
    return user.user_reorder_count(_fi(spark, sf_dir))


@register("user_peak_hour_visits", compose("""
SELECT user_id, CAST(max(frequency) AS BIGINT) AS maximum_frquency FROM (
  SELECT user_id, order_hour_of_day, count(order_id) AS frequency FROM fo GROUP BY user_id, order_hour_of_day) t
GROUP BY user_id""", "fo"))
def q_user_peak_hour_visits(spark, sf_dir):
    return user.user_peak_hour_visits(_fi(spark, sf_dir))


@register("user_keyword_orders", compose("""
SELECT user_id, CAST(count_of_asian_org_items AS BIGINT) AS count_of_asian_org_items,
       round(mean_of_asian_org_items, 6) AS mean_of_asian_org_items FROM uf_kw""", "uf_kw"))
def q_user_keyword_orders(spark, sf_dir):
    return round_doubles(user.user_keyword_orders(_fi(spark, sf_dir)))


@register("user_basket_size", compose("""
SELECT user_id, CAST(max_count_of_products AS BIGINT) AS max_count_of_products,
       CAST(min_count_of_products AS BIGINT) AS min_count_of_products,
       round(mean_count_of_products, 6) AS mean_count_of_products FROM uf_size""", "uf_size"))
def q_user_basket_size(spark, sf_dir):
    return round_doubles(user.user_basket_size(_fi(spark, sf_dir)))


@register("user_no_repeat_orders", compose("""
SELECT user_id, CAST(count_ord_no_prev_purchased_items AS BIGINT) AS count_ord_no_prev_purchased_items,
       round(mean_ord_no_prev_purchased_items, 6) AS mean_ord_no_prev_purchased_items FROM uf_norep""", "uf_norep"))
def q_user_no_repeat_orders(spark, sf_dir):
    return round_doubles(user.user_no_repeat_orders(_fi(spark, sf_dir)))


@register("user_features", compose(f"SELECT user_id, {r6(USER_COLS)} FROM uf", "uf"))
def q_user_features(spark, sf_dir):
    return round_doubles(user.user_features(_fi(spark, sf_dir)))


# ---------------------------------------------------------------- product
@register("product_purchase_count", compose("""
SELECT product_id, count(order_id) AS product_count FROM fl GROUP BY product_id""", "fl"))
def q_product_purchase_count(spark, sf_dir):
    return product.product_purchase_count(_fi(spark, sf_dir))


@register("product_mean_position", compose(
    "SELECT product_id, round(product_mean_of_position, 6) AS product_mean_of_position FROM pf_pos", "pf_pos"))
def q_product_mean_position(spark, sf_dir):
    return round_doubles(product.product_mean_position(_fi(spark, sf_dir)))


@register("product_one_shot_users", compose("""
SELECT product_id, CAST(number_of_user_purchased_item AS BIGINT) AS number_of_user_purchased_item FROM pf_one""",
                                            "pf_one"))
def q_product_one_shot_users(spark, sf_dir):
    return product.product_one_shot_users(_fi(spark, sf_dir))


@register("product_cooccurrence_total", compose("""
SELECT product_id, CAST(number_of_product_co_occurred AS BIGINT) AS number_of_product_co_occurred FROM pf_co""",
                                                "pf_co"))
def q_product_cooccurrence_total(spark, sf_dir):
    return product.product_cooccurrence_total(_fi(spark, sf_dir))


@register("product_cooccurrence_stats", compose("""
SELECT product_id, round(mean_of_co_ocuured_product_per_order, 6) AS mean_of_co_ocuured_product_per_order,
       CAST(min_of_co_ocuured_product_per_order AS BIGINT) AS min_of_co_ocuured_product_per_order,
       CAST(max_of_co_ocuured_product_per_order AS BIGINT) AS max_of_co_ocuured_product_per_order
FROM pf_costat""", "pf_costat"))
def q_product_cooccurrence_stats(spark, sf_dir):
    return round_doubles(product.product_cooccurrence_stats(_fi(spark, sf_dir)))


@register("product_streak_stats", compose("""
SELECT product_id, CAST(Total_streak_of_this_product AS BIGINT) AS Total_streak_of_this_product,
       round(mean_of_streaks_of_this_product, 6) AS mean_of_streaks_of_this_product,
       CAST(min_of_streaks_of_this_product AS BIGINT) AS min_of_streaks_of_this_product,
       CAST(max_of_streaks_of_this_product AS BIGINT) AS max_of_streaks_of_this_product
FROM pf_streak""", "pf_streak"))
def q_product_streak_stats(spark, sf_dir):
    s = product.product_streak_stats(_fim(spark, sf_dir))
    return round_doubles(s.select("product_id", "Total_streak_of_this_product", "mean_of_streaks_of_this_product",
                                  "min_of_streaks_of_this_product", "max_of_streaks_of_this_product"))


@register("product_streak_prob", compose("""
SELECT product_id, round(prob_of_reordered_5, 6) AS prob_of_reordered_5,
       round(prob_of_reordered_3, 6) AS prob_of_reordered_3, round(prob_of_reordered_2, 6) AS prob_of_reordered_2
FROM pf_streak""", "pf_streak"))
def q_product_streak_prob(spark, sf_dir):
    s = product.product_streak_stats(_fim(spark, sf_dir))
    return round_doubles(s.select("product_id", "prob_of_reordered_5", "prob_of_reordered_3", "prob_of_reordered_2"))


@register("product_dow_distribution", compose(
    "SELECT product_id, " + ", ".join(f"CAST(distrib_count_of_dow_{d}_p_prod AS BIGINT) AS distrib_count_of_dow_{d}_p_prod"
                                      for d in range(7)) + " FROM pf_dow", "pf_dow"))
def q_product_dow_distribution(spark, sf_dir):
    return product.product_dow_distribution(_fi(spark, sf_dir))


@register("pivot_order_dow", compose(
    "SELECT order_id, " + ", ".join(f'CAST("{d}" AS INTEGER) AS "{d}"' for d in range(7)) + " FROM dow_pivot",
    "dow_pivot"))
def q_pivot_order_dow(spark, sf_dir):
    return product.pivot_order_dow(_fi(spark, sf_dir).orders)


@register("product_order_support", compose(
    "SELECT product_id, round(prob_of_being_reordered, 6) AS prob_of_being_reordered FROM pf_sup", "pf_sup"))
def q_product_order_support(spark, sf_dir):
    return round_doubles(product.product_order_support(_fi(spark, sf_dir)))


@register("product_features", compose(f"SELECT product_id, {r6(PRODUCT_COLS)} FROM pf", "pf"))
def q_product_features(spark, sf_dir):
    return round_doubles(product.product_features(_fim(spark, sf_dir)))


@register("product_streak_stats_islands", compose("""
SELECT product_id, CAST(count(grp) AS BIGINT) AS Total_streak_of_this_product,
       round(avg(length_of_streaks), 6) AS mean_of_streaks_of_this_product,
       CAST(min(length_of_streaks) AS BIGINT) AS min_of_streaks_of_this_product,
       CAST(max(length_of_streaks) AS BIGINT) AS max_of_streaks_of_this_product,
       round(sum(CASE WHEN length_of_streaks >= 5 THEN 1 ELSE 0 END) / count(length_of_streaks), 6) AS prob_of_reordered_5,
       round(sum(CASE WHEN length_of_streaks >= 3 THEN 1 ELSE 0 END) / count(length_of_streaks), 6) AS prob_of_reordered_3,
       round(sum(CASE WHEN length_of_streaks >= 2 THEN 1 ELSE 0 END) / count(length_of_streaks), 6) AS prob_of_reordered_2
FROM islands GROUP BY product_id""", "islands"))
def q_product_streak_stats_islands(spark, sf_dir):
    return round_doubles(product.product_streak_stats(_fim(spark, sf_dir), faithful=False))


# ---------------------------------------------------------------- user x product
@register("user_product_orders", compose("""
SELECT user_id, product_id, num_of_ord_purch_p_prod FROM up_n""", "up_n"))
def q_user_product_orders(spark, sf_dir):
    return user_product.user_product_orders(_fi(spark, sf_dir))


@register("user_product_position", compose("""
SELECT user_id, product_id, round(prod_mean_of_position_p_user, 6) AS prod_mean_of_position_p_user FROM up_pos""",
                                           "up_pos"))
def q_user_product_position(spark, sf_dir):
    return round_doubles(user_product.user_product_position(_fi(spark, sf_dir)))


@register("user_product_cooccurrence", compose("""
SELECT user_id, product_id, CAST(num_of_prod_co_ocrd_p_usr_p_prod AS BIGINT) AS num_of_prod_co_ocrd_p_usr_p_prod
FROM up_co""", "up_co"))
def q_user_product_cooccurrence(spark, sf_dir):
    return user_product.user_product_cooccurrence(_fi(spark, sf_dir))


@register("user_product_features", compose(f"SELECT user_id, product_id, {r6(UP_COLS)} FROM upf", "upf"))
def q_user_product_features(spark, sf_dir):
    return round_doubles(user_product.user_product_features(_fi(spark, sf_dir)))


# ---------------------------------------------------------------- time
@register("orders_per_dow", compose("SELECT * FROM dow_counts", "dow_counts"))
def q_orders_per_dow(spark, sf_dir):
    return time.orders_per_dow(_fi(spark, sf_dir).orders)


@register("orders_per_hour", compose("SELECT * FROM hour_counts", "hour_counts"))
def q_orders_per_hour(spark, sf_dir):
    return time.orders_per_hour(_fi(spark, sf_dir).orders)


@register("time_features", compose("SELECT * FROM tf", "tf"))
def q_time_features(spark, sf_dir):
    return time.time_features(_fi(spark, sf_dir).orders)


@register("time_mean_constants", compose("""
SELECT round(time_mean_dow_count, 6) AS time_mean_dow_count, round(time_mean_ohod_count, 6) AS time_mean_ohod_count
FROM tconst""", "tconst"))
def q_time_mean_constants(spark, sf_dir):
    return round_doubles(time.time_mean_constants(_fi(spark, sf_dir).orders))


@register("max_orders_per_user", compose("""
SELECT user_id, max(order_number) AS maximum_orders FROM orders_v GROUP BY user_id"""))
def q_max_orders_per_user(spark, sf_dir):
    from cartwise.operators.profile import max_per_key
    return max_per_key(basket(spark, sf_dir).orders, "user_id", "order_number", "maximum_orders")


# ---------------------------------------------------------------- sequences
@register("next_order_number", compose("""
SELECT user_id, product_id, order_id, order_number, CAST(next_order_number AS DOUBLE) AS next_order_number
FROM flagged""", "flagged"))
def q_next_order_number(spark, sf_dir):
    # nullable integer rendered as double in both engines (same value representation)
    return sequence.next_order_number(_fim(spark, sf_dir).facts).withColumn(
        "next_order_number", F.col("next_order_number").cast("double"))


@register("streak_continued_flag", compose("""
SELECT user_id, product_id, order_id, order_number, CAST(next_order_number AS DOUBLE) AS next_order_number,
       CAST(is_streak_continued_flag AS INTEGER) AS is_streak_continued_flag FROM flagged""", "flagged"))
def q_streak_continued_flag(spark, sf_dir):
    return sequence.streak_continued_flag(_fim(spark, sf_dir).facts).withColumn(
        "next_order_number", F.col("next_order_number").cast("double"))


@register("streaks_flagged", compose("""
SELECT user_id, product_id, CAST(grp AS INTEGER) AS grp, length_of_streaks FROM streaks""", "streaks"))
def q_streaks_flagged(spark, sf_dir):
    return sequence.streaks_flagged(_fim(spark, sf_dir).facts)


@register("streaks_islands", compose("""
SELECT user_id, product_id, CAST(grp AS INTEGER) AS grp, length_of_streaks FROM islands""", "islands"))
def q_streaks_islands(spark, sf_dir):
    return sequence.streaks_islands(_fim(spark, sf_dir).facts)


# ---------------------------------------------------------------- frames
TRAIN_SQL_BODY = f"""
SELECT t.user_id, l.product_id, CAST(l.reordered AS INTEGER) AS reordered,
       round(t.total_ord_count_p_dow, 6) AS total_ord_count_p_dow,
       round(t.total_ord_count_p_ohod, 6) AS total_ord_count_p_ohod,
       {r6(USER_COLS, 'u')}, {r6(PRODUCT_COLS, 'p')}, {r6(UP_COLS, 'x')}
FROM fl l LEFT JOIN tf t ON l.order_id = t.order_id
  LEFT JOIN uf u ON t.user_id = u.user_id
  LEFT JOIN pf p ON l.product_id = p.product_id
  LEFT JOIN upf x ON t.user_id = x.user_id AND l.product_id = x.product_id"""


@register("train_feature_frame", compose(TRAIN_SQL_BODY, "fl", "tf", "uf", "pf", "upf"))
def q_train_feature_frame(spark, sf_dir):
    b = basket(spark, sf_dir)
    return round_doubles(assemble.train_frame(b.orders, b.lines, b.products, line_facts=b.line_facts, fs=feature_set(b)))


TEST_SQL_BODY = f"""
, cand AS (
  SELECT DISTINCT tu.user_id, l.product_id
  FROM (SELECT user_id FROM orders_v WHERE eval_set = 'test') tu
  LEFT JOIN fo o ON tu.user_id = o.user_id
  LEFT JOIN (SELECT l.order_id, l.product_id FROM order_products_v l JOIN orders_v v
             ON l.order_id = v.order_id AND v.eval_set = 'prior') l ON o.order_id = l.order_id)
SELECT c.user_id, c.product_id,
       round(k.time_mean_dow_count, 6) AS total_ord_count_p_dow,
       round(k.time_mean_ohod_count, 6) AS total_ord_count_p_ohod,
       {r6(USER_COLS, 'u')}, {r6(PRODUCT_COLS, 'p')}, {r6(UP_COLS, 'x')}
FROM cand c JOIN uf u ON c.user_id = u.user_id
  JOIN pf p ON c.product_id = p.product_id
  JOIN upf x ON c.user_id = x.user_id AND c.product_id = x.product_id
  CROSS JOIN tconst k"""


def _test_sql():
    # the body starts with an extra CTE; splice it after the composed fragments
    base = compose("SELECT 1", "fo", "uf", "pf", "upf", "tconst")
    head = base[: base.rindex("SELECT 1")].rstrip()
    return head + TEST_SQL_BODY


@register("test_feature_frame", _test_sql())
def q_test_feature_frame(spark, sf_dir):
    b = basket(spark, sf_dir)
    return round_doubles(assemble.test_frame(b.orders, b.lines, b.products, line_facts=b.line_facts, fs=feature_set(b)))


@register("join_candidates", compose("""
SELECT DISTINCT tu.user_id, l.product_id
FROM (SELECT user_id FROM orders_v WHERE eval_set = 'test') tu
LEFT JOIN fo o ON tu.user_id = o.user_id
LEFT JOIN (SELECT l.order_id, l.product_id FROM order_products_v l JOIN orders_v v
           ON l.order_id = v.order_id AND v.eval_set = 'prior') l ON o.order_id = l.order_id
WHERE l.product_id IS NOT NULL""", "fo"))
def q_join_candidates(spark, sf_dir):
    b = basket(spark, sf_dir)
    return assemble.candidates(b.orders, b.lines, b.line_facts)




@register("join_inner_features", _test_sql().replace(TEST_SQL_BODY, f"""
, cand AS (
  SELECT DISTINCT tu.user_id, l.product_id
  FROM (SELECT user_id FROM orders_v WHERE eval_set = 'test') tu
  LEFT JOIN fo o ON tu.user_id = o.user_id
  LEFT JOIN (SELECT l.order_id, l.product_id FROM order_products_v l JOIN orders_v v
             ON l.order_id = v.order_id AND v.eval_set = 'prior') l ON o.order_id = l.order_id)
SELECT c.user_id, c.product_id, {r6(USER_COLS, 'u')}, {r6(PRODUCT_COLS, 'p')}, {r6(UP_COLS, 'x')}
FROM cand c JOIN uf u ON c.user_id = u.user_id
  JOIN pf p ON c.product_id = p.product_id
  JOIN upf x ON c.user_id = x.user_id AND c.product_id = x.product_id"""))
def q_join_inner_features(spark, sf_dir):
    """Candidates ⋈ user ⋈ product ⋈ user×product features (inner joins)."""
    b = basket(spark, sf_dir)
    fs = feature_set(b)
    cands = assemble.candidates(b.orders, b.lines, b.line_facts)
    j = (cands.join(fs.user, "user_id", "inner").join(fs.product_side, "product_id", "inner")
         .join(fs.user_product, list(assemble.KEYS), "inner"))
    return round_doubles(j)
