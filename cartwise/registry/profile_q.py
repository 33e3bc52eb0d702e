"""Profiling and statistics queries (exploration data)."""

from __future__ import annotations

from cartwise.operators import profile as P
from cartwise.registry.base import basket, register


@register("dept_reorder_rate", """
SELECT d.department,
       CAST(count(*) AS BIGINT) AS total_prod_sold,
       CAST(coalesce(sum(l.reordered), 0) AS BIGINT) AS reorder_count,
       round(CAST(coalesce(sum(l.reordered), 0) AS DOUBLE) / count(*) * 100, 6) AS reorder_percentage
FROM orders_v o
LEFT JOIN order_products_v l ON o.order_id = l.order_id
LEFT JOIN products_v p ON l.product_id = p.product_id
LEFT JOIN departments_v d ON p.department_id = d.department_id
WHERE o.eval_set = 'prior'
GROUP BY d.department
""", views=("orders_v", "order_products_v", "products_v", "departments_v"))
def dept_reorder_rate(spark, sf_dir):
    b = basket(spark, sf_dir)
    return P.dept_reorder_rate(b.orders, b.lines_in("prior"), b.products, b.departments)


_V = ("orders_v", "order_products_v", "products_v", "departments_v", "aisles_v", "visits_v")


def _sql(body: str) -> str:
    from cartwise.sources.views import with_views
    return with_views(body, *_V)


# ------------------------------------------------------------ nulls, distincts, value counts
_NULL_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM {v}"
    for t, v, cols in (
        ("orders", "orders_v", ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day",
                                "days_since_prior_order"]),
        ("order_products", "order_products_v", ["order_id", "product_id", "add_to_cart_order", "reordered"]),
        ("products", "products_v", ["product_id", "product_name", "aisle_id", "department_id"]))
    for c in cols)


@register("null_counts", _sql(_NULL_SQL))
def q_null_counts(spark, sf_dir):
    b = basket(spark, sf_dir)
    return P.union_all([P.null_counts(b.orders, "orders"), P.null_counts(b.lines, "order_products"),
                        P.null_counts(b.products, "products")])


@register("distinct_values", _sql("""
SELECT (SELECT count(DISTINCT reordered) FROM order_products_v) AS n_reordered_labels,
       (SELECT count(DISTINCT eval_set) FROM orders_v) AS n_eval_sets,
       (SELECT count(DISTINCT order_dow) FROM orders_v) AS n_dow,
       (SELECT count(DISTINCT order_hour_of_day) FROM orders_v) AS n_hours,
       (SELECT max(days_since_prior_order) FROM orders_v) AS max_gap"""))
def q_distinct_values(spark, sf_dir):
    from pyspark.sql import functions as F
    b = basket(spark, sf_dir)
    o = b.orders
    return b.lines.agg(F.count_distinct("reordered").alias("n_reordered_labels")).select(
        "n_reordered_labels",
        o.agg(F.count_distinct("eval_set")).scalar().alias("n_eval_sets"),
        o.agg(F.count_distinct("order_dow")).scalar().alias("n_dow"),
        o.agg(F.count_distinct("order_hour_of_day")).scalar().alias("n_hours"),
        o.agg(F.max("days_since_prior_order")).scalar().alias("max_gap"))


@register("distinct_eval_set", _sql("SELECT DISTINCT eval_set FROM orders_v"))
def q_distinct_eval_set(spark, sf_dir):
    return P.distinct_values(basket(spark, sf_dir).orders, "eval_set")


def _vc_sql(view: str, col: str) -> str:
    return _sql(f"SELECT {col}, count(*) AS count, CAST({col} AS VARCHAR) AS label FROM {view} GROUP BY {col}")


for _col in ("eval_set", "order_dow", "days_since_prior_order", "order_number"):
    def _mk(col):
        def q(spark, sf_dir):
            return P.value_counts(basket(spark, sf_dir).orders, col)
        return q
    register(f"value_counts_{_col}", _vc_sql("orders_v", _col))(_mk(_col))


@register("value_counts_reordered", _vc_sql("order_products_v", "reordered"))
def q_value_counts_reordered(spark, sf_dir):
    return P.value_counts(basket(spark, sf_dir).lines, "reordered")


# ------------------------------------------------------------ distributions
def _hist_sql(source: str, col: str, bins: int = 30) -> str:
    return _sql(f"""
, src AS ({source}),
b AS (SELECT min({col}) AS lo, max({col}) AS hi FROM src),
x AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 1
                       WHEN floor((CAST({col} AS DOUBLE) - b.lo) / ((b.hi - b.lo) / {bins})) + 1 > {bins} THEN {bins}
                       ELSE floor((CAST({col} AS DOUBLE) - b.lo) / ((b.hi - b.lo) / {bins})) + 1 END AS INTEGER) AS bin,
             b.lo, b.hi
      FROM src, b WHERE {col} IS NOT NULL)
SELECT bin, round(lo + (bin - 1) * ((hi - lo) / {bins}), 6) AS bin_start,
       round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_end, count(*) AS count
FROM x GROUP BY bin, lo, hi""")


@register("histogram_add_to_cart", _hist_sql("SELECT add_to_cart_order FROM order_products_v", "add_to_cart_order"))
def q_histogram_add_to_cart(spark, sf_dir):
    return P.histogram_fixed(basket(spark, sf_dir).lines, "add_to_cart_order", 30)


@register("histogram_max_orders", _hist_sql(
    "SELECT user_id, max(order_number) AS maximum_orders FROM orders_v GROUP BY user_id", "maximum_orders"))
def q_histogram_max_orders(spark, sf_dir):
    mo = P.max_per_key(basket(spark, sf_dir).orders, "user_id", "order_number", "maximum_orders")
    return P.histogram_fixed(mo, "maximum_orders", 30)


def _box_sql(view: str, col: str) -> str:
    return _sql(f"""
, v AS (SELECT CAST({col} AS DOUBLE) AS v FROM {view} WHERE {col} IS NOT NULL),
q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM v)
SELECT count(*) AS n, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
       min(v) FILTER (WHERE v >= q1 - (q3 - q1) * 1.5 AND v <= q3 + (q3 - q1) * 1.5) AS whisker_low,
       max(v) FILTER (WHERE v >= q1 - (q3 - q1) * 1.5 AND v <= q3 + (q3 - q1) * 1.5) AS whisker_high,
       count(*) FILTER (WHERE NOT (v >= q1 - (q3 - q1) * 1.5 AND v <= q3 + (q3 - q1) * 1.5)) AS outliers,
       min(v) AS min_value, max(v) AS max_value
FROM v, q""")


for _key, _view, _col, _attr in (("box_add_to_cart", "order_products_v", "add_to_cart_order", "lines"),
                                 ("box_days_since_prior", "orders_v", "days_since_prior_order", "orders"),
                                 ("box_order_number", "orders_v", "order_number", "orders")):
    def _mkb(col, attr):
        def q(spark, sf_dir):
            return P.box_stats(getattr(basket(spark, sf_dir), attr), col)
        return q
    register(_key, _box_sql(_view, _col))(_mkb(_col, _attr))


# ------------------------------------------------------------ correlation and contingency
@register("corr_pearson", _sql("""
SELECT count(*) AS n, round(corr(CAST(order_number AS DOUBLE), days_since_prior_order), 6) AS pearson_r
FROM orders_v WHERE days_since_prior_order IS NOT NULL AND order_number IS NOT NULL"""))
def q_corr_pearson(spark, sf_dir):
    return P.corr_pearson(basket(spark, sf_dir).orders, "order_number", "days_since_prior_order")


@register("corr_spearman", _sql("""
, d AS (SELECT CAST(order_number AS DOUBLE) AS x, days_since_prior_order AS y FROM orders_v
        WHERE days_since_prior_order IS NOT NULL AND order_number IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM d)
SELECT count(*) AS n, round(corr(rx, ry), 6) AS spearman_rho FROM r"""))
def q_corr_spearman(spark, sf_dir):
    return P.corr_spearman(basket(spark, sf_dir).orders, "order_number", "days_since_prior_order")


@register("contingency_dow_hour", _sql(
    "SELECT order_dow, " + ", ".join(
        f"count(*) FILTER (WHERE order_hour_of_day = {h}) AS order_hour_of_day_{h}" for h in range(24))
    + " FROM visits_v GROUP BY order_dow"))
def q_contingency_dow_hour(spark, sf_dir):
    return P.contingency(basket(spark, sf_dir).visits, "order_dow", "order_hour_of_day", list(range(24)))


@register("chi_square_independence", _sql("""
, cells AS (SELECT order_dow, order_hour_of_day, count(*) AS o FROM visits_v GROUP BY 1, 2),
r AS (SELECT order_dow, sum(o) AS r FROM cells GROUP BY 1),
c AS (SELECT order_hour_of_day, sum(o) AS c FROM cells GROUP BY 1),
n AS (SELECT sum(o) AS n FROM cells),
grid AS (SELECT r.order_dow, c.order_hour_of_day, r.r * c.c / n.n AS e FROM r, c, n)
SELECT round(sum((coalesce(cells.o, 0) - grid.e) * (coalesce(cells.o, 0) - grid.e) / grid.e), 6) AS chi2,
       CAST(((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM c) - 1) AS BIGINT) AS dof,
       CAST((SELECT n FROM n) AS BIGINT) AS n
FROM grid LEFT JOIN cells ON grid.order_dow = cells.order_dow AND grid.order_hour_of_day = cells.order_hour_of_day"""))
def q_chi_square_independence(spark, sf_dir):
    return P.chi_square(basket(spark, sf_dir).visits, "order_dow", "order_hour_of_day")


@register("chi_square_pvalue", _sql("""
, cells AS (SELECT order_dow, order_hour_of_day, count(*) AS o FROM visits_v GROUP BY 1, 2),
r AS (SELECT order_dow, sum(o) AS r FROM cells GROUP BY 1),
c AS (SELECT order_hour_of_day, sum(o) AS c FROM cells GROUP BY 1),
n AS (SELECT sum(o) AS n FROM cells),
grid AS (SELECT r.order_dow, c.order_hour_of_day, r.r * c.c / n.n AS e FROM r, c, n),
test AS (
  SELECT round(sum((coalesce(cells.o, 0) - grid.e) * (coalesce(cells.o, 0) - grid.e) / grid.e), 6) AS chi2,
         CAST(((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM c) - 1) AS BIGINT) AS dof
  FROM grid LEFT JOIN cells ON grid.order_dow = cells.order_dow AND grid.order_hour_of_day = cells.order_hour_of_day)
-- an even number of degrees: the tail is that of a Poisson count
SELECT chi2, dof, round(sum(exp(k * ln(chi2 / 2) - chi2 / 2 - lgamma(k + 1))), 9) AS p_value
FROM (SELECT chi2, dof, unnest(range(0, dof // 2)) AS k FROM test) GROUP BY chi2, dof"""))
def q_chi_square_pvalue(spark, sf_dir):
    """p-value of the independence test, from the native statistic."""
    return P.chi_square_pvalue(basket(spark, sf_dir).visits, "order_dow", "order_hour_of_day")


@register("orders_by_dow_hour", _sql("""
SELECT order_dow, order_hour_of_day, count(*) AS count FROM visits_v GROUP BY 1, 2"""))
def q_orders_by_dow_hour(spark, sf_dir):
    return P.cell_counts(basket(spark, sf_dir).visits, "order_dow", "order_hour_of_day")


# ------------------------------------------------------------ reorder rates
@register("keyword_reorder_rate", _sql("""
, f AS (SELECT regexp_matches(p.product_name, '(?i)Red') AS is_match, l.reordered
        FROM order_products_v l JOIN products_v p ON l.product_id = p.product_id),
g AS (SELECT is_match, count(*) FILTER (WHERE reordered = 0) AS not_reordered,
             count(*) FILTER (WHERE reordered = 1) AS reordered_count FROM f GROUP BY is_match)
SELECT CASE WHEN is_match THEN 'Match' ELSE 'No match' END AS label, is_match, not_reordered, reordered_count,
       not_reordered + reordered_count AS total,
       round(CAST(reordered_count AS DOUBLE) / (not_reordered + reordered_count) * 100, 6) AS reorder_percentage
FROM g"""))
def q_keyword_reorder_rate(spark, sf_dir):
    b = basket(spark, sf_dir)
    return P.keyword_reorder_rate(b.lines, b.products, "Red")


@register("products_per_aisle", _sql("""
SELECT d.department, a.aisle, count(p.product_id) AS prod_count_p_aisle,
       regexp_replace(a.aisle, ' ', '<br>') AS aisle_with_br
FROM products_v p JOIN departments_v d ON p.department_id = d.department_id
JOIN aisles_v a ON p.aisle_id = a.aisle_id GROUP BY d.department, a.aisle"""))
def q_products_per_aisle(spark, sf_dir):
    b = basket(spark, sf_dir)
    return P.products_per_aisle(b.products, b.departments, b.aisles)


@register("position_reorder_rate", _sql("""
SELECT add_to_cart_order, count(*) AS total_count, CAST(coalesce(sum(reordered), 0) AS BIGINT) AS reorder_count,
       round(CAST(coalesce(sum(reordered), 0) AS DOUBLE) / count(*) * 100, 6) AS reorder_cart_ratio,
       CAST(add_to_cart_order AS VARCHAR) AS add_to_cart_label
FROM order_products_v GROUP BY add_to_cart_order"""))
def q_position_reorder_rate(spark, sf_dir):
    return P.position_reorder_rate(basket(spark, sf_dir).lines)


@register("sort_keys", _sql("""
SELECT user_id, order_number, order_dow, order_hour_of_day FROM orders_v ORDER BY user_id, order_number"""))
def q_sort_keys(spark, sf_dir):
    o = basket(spark, sf_dir).orders
    return o.select("user_id", "order_number", "order_dow", "order_hour_of_day").orderBy("user_id", "order_number")


# The survey's generic keys, each bound to one representative column.
@register("value_counts", _vc_sql("order_products_v", "add_to_cart_order"))
def q_value_counts(spark, sf_dir):
    return P.value_counts(basket(spark, sf_dir).lines, "add_to_cart_order")


@register("histogram_fixed", _hist_sql("SELECT days_since_prior_order FROM orders_v", "days_since_prior_order"))
def q_histogram_fixed(spark, sf_dir):
    return P.histogram_fixed(basket(spark, sf_dir).orders, "days_since_prior_order", 30)


@register("box_stats", _box_sql("order_products_v", "reordered"))
def q_box_stats(spark, sf_dir):
    return P.box_stats(basket(spark, sf_dir).lines, "reordered")
