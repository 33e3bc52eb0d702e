"""Projection, filter, cast, rename, set-operation, join and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwise.functions import scalar as S
from cartwise.operators import frames, joins
from cartwise.plans import time, user, user_product
from cartwise.plans.base import cast_longs_to_double, cast_strings_to_double, split_inputs
from cartwise.registry.base import basket, register
from cartwise.registry.sqlfrag import compose

_V = ("orders_v", "order_products_v", "products_v")
_ALLV = ("orders_v", "order_products_v", "products_v", "aisles_v", "departments_v")


def _fi(spark, sf_dir):
    b = basket(spark, sf_dir)
    return split_inputs(b.orders, b.lines, b.products, line_facts=b.line_facts)


# ------------------------------------------------------------ projections / filters
@register("project_prune", compose("SELECT order_id, product_id FROM order_products_v", views=_V))
def q_project_prune(spark, sf_dir):
    return basket(spark, sf_dir).lines.select("order_id", "product_id")


@register("filter_train_orders", compose("""
SELECT order_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order
FROM orders_v WHERE eval_set <> 'test'""", views=_V))
def q_filter_train_orders(spark, sf_dir):
    return frames.filter_train_orders(basket(spark, sf_dir).orders)


@register("filter_test_orders", compose("SELECT order_id, user_id FROM orders_v WHERE eval_set = 'test'", views=_V))
def q_filter_test_orders(spark, sf_dir):
    return frames.filter_test_orders(basket(spark, sf_dir).orders)


@register("filter_prior_orders", compose("SELECT * FROM orders_v WHERE eval_set = 'prior'", views=_V))
def q_filter_prior_orders(spark, sf_dir):
    return frames.filter_prior_orders(basket(spark, sf_dir).orders)


@register("filter_not_first_null_gap", compose("""
SELECT count(*) AS orders_after_first, count(*) FILTER (WHERE days_since_prior_order IS NULL) AS null_gaps
FROM orders_v WHERE order_number <> 1""", views=_V))
def q_filter_not_first_null_gap(spark, sf_dir):
    return frames.null_gap_after_first(basket(spark, sf_dir).orders)


@register("filter_gap_not_null", compose("""
SELECT order_id, order_number, days_since_prior_order FROM orders_v WHERE days_since_prior_order IS NOT NULL""",
                                         views=_V))
def q_filter_gap_not_null(spark, sf_dir):
    return frames.drop_null_gaps(basket(spark, sf_dir).orders)


@register("rename_columns", compose("""
SELECT order_id, user_id, order_dow AS dow, order_hour_of_day AS hour_of_day FROM orders_v""", views=_V))
def q_rename_columns(spark, sf_dir):
    o = basket(spark, sf_dir).orders.select("order_id", "user_id", "order_dow", "order_hour_of_day")
    return o.withColumnsRenamed({"order_dow": "dow", "order_hour_of_day": "hour_of_day"})


@register("cast_longs_to_double", compose("""
SELECT user_id, product_id, CAST(num_of_ord_purch_p_prod AS DOUBLE) AS num_of_ord_purch_p_prod FROM up_n""",
                                          "up_n"))
def q_cast_longs_to_double(spark, sf_dir):
    return cast_longs_to_double(user_product.user_product_orders(_fi(spark, sf_dir)))


@register("cast_strings_to_double", compose("""
SELECT order_id, TRY_CAST(CAST(order_number AS VARCHAR) AS DOUBLE) AS order_number,
       TRY_CAST(coalesce(CAST(days_since_prior_order AS VARCHAR), 'n/a') AS DOUBLE) AS days_since_prior_order
FROM orders_v""", views=_V))
def q_cast_strings_to_double(spark, sf_dir):
    o = basket(spark, sf_dir).orders
    as_text = o.select("order_id", F.col("order_number").cast("string").alias("order_number"),
                       F.coalesce(F.col("days_since_prior_order").cast("string"), F.lit("n/a"))
                       .alias("days_since_prior_order"))
    return cast_strings_to_double(as_text)


@register("add_constant_columns", compose("""
SELECT u.user_id, u.frequency_of_reorder, round(k.time_mean_dow_count, 6) AS time_mean_dow_count,
       round(k.time_mean_ohod_count, 6) AS time_mean_ohod_count
FROM uf u CROSS JOIN tconst k""", "uf", "tconst"))
def q_add_constant_columns(spark, sf_dir):
    fi = _fi(spark, sf_dir)
    consts = time.time_mean_constants(fi.orders)
    u = user.user_features(fi).select("user_id", "frequency_of_reorder")
    return S.round_doubles(u.withColumns({
        "time_mean_dow_count": consts.select("time_mean_dow_count").scalar(),
        "time_mean_ohod_count": consts.select("time_mean_ohod_count").scalar()}))


@register("drop_columns", compose("""
SELECT user_id, total_ord_count_p_dow, total_ord_count_p_ohod FROM tf""", "tf"))
def q_drop_columns(spark, sf_dir):
    return time.time_features(_fi(spark, sf_dir).orders).drop("order_id", "dow", "hour_of_day")


# ------------------------------------------------------------ set operations
@register("union_prior_train", compose("""
SELECT l.* FROM order_products_v l JOIN orders_v o ON l.order_id = o.order_id AND o.eval_set = 'train'
UNION ALL
SELECT l.* FROM order_products_v l JOIN orders_v o ON l.order_id = o.order_id AND o.eval_set = 'prior'""", views=_V))
def q_union_prior_train(spark, sf_dir):
    b = basket(spark, sf_dir)
    return frames.union_lines(*(b.lines_in(s).select(*b.lines.columns) for s in ("train", "prior")))


@register("distinct_pairs", compose("""
SELECT DISTINCT o.user_id, l.product_id FROM order_products_v l JOIN orders_v o ON l.order_id = o.order_id""",
                                    views=_V))
def q_distinct_pairs(spark, sf_dir):
    return basket(spark, sf_dir).line_facts.select("user_id", "product_id").distinct()


@register("duplicate_row_check", compose("""
SELECT 'orders' AS frame, (SELECT count(*) FROM orders_v) AS n_rows,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM orders_v) t) AS n_distinct
UNION ALL
SELECT 'lines', (SELECT count(*) FROM order_products_v),
       (SELECT count(*) FROM (SELECT DISTINCT * FROM order_products_v) t)
UNION ALL
SELECT 'test_users', (SELECT count(*) FROM orders_v WHERE eval_set = 'test'),
       (SELECT count(DISTINCT user_id) FROM orders_v WHERE eval_set = 'test')""", views=_V))
def q_duplicate_row_check(spark, sf_dir):
    b = basket(spark, sf_dir)
    test_users = b.orders.where(F.col("eval_set") == "test").select("user_id")
    return frames.duplicate_row_check({"orders": b.orders, "lines": b.lines, "test_users": test_users})


# ------------------------------------------------------------ joins
@register("join_lines_orders", compose("""
SELECT l.order_id, l.product_id, l.add_to_cart_order, l.reordered, o.user_id, o.eval_set, o.order_number,
       o.order_dow, o.order_hour_of_day, o.days_since_prior_order
FROM order_products_v l LEFT JOIN orders_v o ON l.order_id = o.order_id""", views=_V))
def q_join_lines_orders(spark, sf_dir):
    b = basket(spark, sf_dir)
    return joins.lines_orders(b.lines, b.orders)


@register("join_lines_products", compose("""
SELECT l.order_id, l.product_id, l.reordered, p.product_name, p.aisle_id, p.department_id
FROM order_products_v l LEFT JOIN products_v p ON l.product_id = p.product_id""", views=_V))
def q_join_lines_products(spark, sf_dir):
    b = basket(spark, sf_dir)
    return joins.lines_products(b.lines.select("order_id", "product_id", "reordered"), b.products)


@register("join_lines_products_inner", compose("""
SELECT l.order_id, l.product_id, l.reordered, p.product_name
FROM order_products_v l JOIN products_v p ON l.product_id = p.product_id""", views=_V))
def q_join_lines_products_inner(spark, sf_dir):
    b = basket(spark, sf_dir)
    return joins.lines_products(b.lines.select("order_id", "product_id", "reordered"),
                                b.products.select("product_id", "product_name"), how="inner")


@register("join_orders_lines", compose("""
SELECT o.order_id, o.user_id, CAST(l.product_id AS DOUBLE) AS product_id
FROM orders_v o LEFT JOIN order_products_v l ON o.order_id = l.order_id""", views=_V))
def q_join_orders_lines(spark, sf_dir):
    b = basket(spark, sf_dir)
    j = joins.orders_lines(b.orders.select("order_id", "user_id"), b.lines.select("order_id", "product_id"))
    # nullable id rendered as double in both engines (ids are < 2^52, exact)
    return j.withColumn("product_id", F.col("product_id").cast("double"))


@register("join_snowflake_products", compose("""
SELECT p.aisle_id, p.department_id, p.product_id, p.product_name, d.department, a.aisle
FROM products_v p JOIN departments_v d ON p.department_id = d.department_id
JOIN aisles_v a ON p.aisle_id = a.aisle_id""", views=_ALLV))
def q_join_snowflake_products(spark, sf_dir):
    b = basket(spark, sf_dir)
    return joins.snowflake_products(b.products, b.departments, b.aisles)


@register("join_order_line_dept", compose("""
SELECT o.order_id, o.user_id, CAST(l.product_id AS DOUBLE) AS product_id,
       CAST(l.reordered AS DOUBLE) AS reordered, d.department
FROM (SELECT * FROM orders_v WHERE eval_set = 'prior') o
LEFT JOIN order_products_v l ON o.order_id = l.order_id
LEFT JOIN products_v p ON l.product_id = p.product_id
LEFT JOIN departments_v d ON p.department_id = d.department_id""", views=_ALLV))
def q_join_order_line_dept(spark, sf_dir):
    b = basket(spark, sf_dir)
    j = joins.order_line_dept(frames.filter_prior_orders(b.orders).select("order_id", "user_id"),
                              b.lines.select("order_id", "product_id", "reordered"),
                              b.products.select("product_id", "department_id"), b.departments)
    return j.select("order_id", "user_id", F.col("product_id").cast("double").alias("product_id"),
                    F.col("reordered").cast("double").alias("reordered"), "department")


@register("join_cooccurrence", compose("""
SELECT a.order_id, a.product_id, count(b.product_id) AS n_co_occurring
FROM order_products_v a LEFT JOIN order_products_v b ON a.order_id = b.order_id AND a.product_id <> b.product_id
GROUP BY a.order_id, a.product_id""", views=_V))
def q_join_cooccurrence(spark, sf_dir):
    return joins.cooccurrence_counts(basket(spark, sf_dir).lines)


@register("join_cooccurrence_user", compose("""
SELECT o.user_id, a.order_id, a.product_id, count(b.product_id) AS n_co_occurring
FROM order_products_v a LEFT JOIN orders_v o ON a.order_id = o.order_id
LEFT JOIN order_products_v b ON a.order_id = b.order_id AND a.product_id <> b.product_id
GROUP BY o.user_id, a.order_id, a.product_id""", views=_V))
def q_join_cooccurrence_user(spark, sf_dir):
    b = basket(spark, sf_dir)
    return joins.cooccurrence_counts(b.lines).join(b.orders.select("order_id", "user_id"), "order_id", "left")


@register("join_composite_key", compose("""
SELECT n.user_id, n.product_id, n.num_of_ord_purch_p_prod, round(p.prod_mean_of_position_p_user, 6) AS prod_mean_of_position_p_user
FROM up_n n LEFT JOIN up_pos p ON n.user_id = p.user_id AND n.product_id = p.product_id""", "up_n", "up_pos"))
def q_join_composite_key(spark, sf_dir):
    fi = _fi(spark, sf_dir)
    return S.round_doubles(joins.composite_key(user_product.user_product_orders(fi),
                                               user_product.user_product_position(fi)))


@register("join_calendar_counts", compose("""
SELECT o.user_id, o.order_id, o.order_dow, o.order_hour_of_day, d.total_ord_count_p_dow, h.total_ord_count_p_ohod
FROM fo o LEFT JOIN dow_counts d ON o.order_dow = d.order_dow
LEFT JOIN hour_counts h ON o.order_hour_of_day = h.order_hour_of_day""", "fo", "dow_counts", "hour_counts"))
def q_join_calendar_counts(spark, sf_dir):
    return joins.calendar_counts(_fi(spark, sf_dir).orders)


# ------------------------------------------------------------ scalar functions
_WORDS = "string_split(product_name, ' ')"


@register("fn_lower_transform", compose(f"""
SELECT product_id, array_to_string(list_transform({_WORDS}, lambda x: lower(x)), '|') AS lowered
FROM (SELECT product_id, upper(substr(product_name, 1, 1)) || substr(product_name, 2) AS product_name FROM products_v) t""",
                                        views=_V))
def q_fn_lower_transform(spark, sf_dir):
    p = basket(spark, sf_dir).products.select(
        "product_id", F.concat(F.upper(F.substring("product_name", 1, 1)), F.substring("product_name", 2, 1 << 20))
        .alias("product_name"))
    # arrays are returned as '|'-joined text so results hash the same in any engine
    return p.select("product_id", F.array_join(S.lower_each(F.split("product_name", " ")), "|").alias("lowered"))


@register("fn_exists_like", compose(f"""
SELECT product_id, list_bool_or(list_transform({_WORDS}, lambda x: x LIKE '%re%' OR x LIKE '%ge%')) AS any_match
FROM products_v""", views=_V))
def q_fn_exists_like(spark, sf_dir):
    p = basket(spark, sf_dir).products
    return p.select("product_id", S.exists_like(F.split("product_name", " "), ("%re%", "%ge%")).alias("any_match"))


@register("fn_array_contains", compose(f"""
SELECT product_id, list_contains({_WORDS}, 'red') AS has_red FROM products_v""", views=_V))
def q_fn_array_contains(spark, sf_dir):
    p = basket(spark, sf_dir).products
    return p.select("product_id", F.array_contains(F.split("product_name", " "), "red").alias("has_red"))


@register("fn_size_explode", compose(f"""
SELECT product_id, len({_WORDS}) AS n_words, CAST(pos AS INTEGER) AS pos, {_WORDS}[pos] AS word
FROM products_v, range(1, 1 + len({_WORDS})) r(pos)""", views=_V))
def q_fn_size_explode(spark, sf_dir):
    p = basket(spark, sf_dir).products.select("product_id", F.split("product_name", " ").alias("w"))
    return p.select("product_id", F.size("w").alias("n_words"), F.posexplode("w").alias("pos", "word")) \
        .select("product_id", "n_words", (F.col("pos") + 1).cast("int").alias("pos"), "word")


@register("fn_case_flag", compose("""
SELECT order_id, CAST(CASE WHEN days_since_prior_order IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_first,
       CAST(order_dow IN (0, 6) AS INTEGER) AS is_weekend FROM orders_v""", views=_V))
def q_fn_case_flag(spark, sf_dir):
    o = basket(spark, sf_dir).orders
    return o.select("order_id", S.case_flag(F.col("days_since_prior_order").isNull()).alias("is_first"),
                    F.col("order_dow").isin(0, 6).cast("int").alias("is_weekend"))


@register("fn_ratio_percent", compose("""
SELECT o.user_id, round(CAST(sum(l.reordered) AS DOUBLE) / count(*), 6) AS reorder_ratio,
       round(CAST(sum(l.reordered) AS DOUBLE) / count(*) * 100, 6) AS reorder_percent
FROM order_products_v l JOIN orders_v o ON l.order_id = o.order_id GROUP BY o.user_id""", views=_V))
def q_fn_ratio_percent(spark, sf_dir):
    g = (basket(spark, sf_dir).line_facts.groupBy("user_id")
         .agg(F.sum("reordered").alias("r"), F.count(F.lit(1)).alias("n")))
    return S.round_doubles(g.select("user_id", S.ratio(F.col("r"), F.col("n")).alias("reorder_ratio"),
                                    S.ratio(F.col("r"), F.col("n"), percent=True).alias("reorder_percent")))


@register("fn_regex_ci", compose("""
SELECT product_id, regexp_matches(product_name, '(?i)RED|BLUE') AS is_match FROM products_v""", views=_V))
def q_fn_regex_ci(spark, sf_dir):
    p = basket(spark, sf_dir).products
    return p.select("product_id", S.regex_ci(F.col("product_name"), "RED|BLUE").alias("is_match"))


@register("fn_replace_first", compose("""
SELECT product_id, regexp_replace(product_name || ' x', ' ', '<br>') AS label FROM products_v""", views=_V))
def q_fn_replace_first(spark, sf_dir):
    p = basket(spark, sf_dir).products
    return p.select("product_id", S.replace_first(F.concat("product_name", F.lit(" x"))).alias("label"))


@register("fn_cast_string", compose("""
SELECT order_id, CAST(order_dow AS VARCHAR) AS dow_label,
       CASE WHEN days_since_prior_order IS NULL THEN 'First' ELSE 'Repeat' END AS kind_label FROM orders_v""",
                                    views=_V))
def q_fn_cast_string(spark, sf_dir):
    o = basket(spark, sf_dir).orders
    return o.select("order_id", F.col("order_dow").cast("string").alias("dow_label"),
                    S.bool_label(F.col("days_since_prior_order").isNull(), "First", "Repeat").alias("kind_label"))


@register("fn_fill_null", compose("""
SELECT order_id, coalesce(days_since_prior_order, 0) AS days_since_prior_order FROM orders_v""", views=_V))
def q_fn_fill_null(spark, sf_dir):
    o = basket(spark, sf_dir).orders.select("order_id", "days_since_prior_order")
    return S.fill_null_zero(o)
