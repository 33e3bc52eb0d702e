"""Scoring, evaluation and basket-selection queries.

The labelled data is the leak-free training frame (features from prior
orders, labels from each user's train order); scores come from a fixed
linear model so every metric has an exact SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwise.functions.scalar import round_doubles
from cartwise.operators import basket as B
from cartwise.operators import evaluate as E
from cartwise.plans import assemble
from cartwise.session import materialize
from cartwise.registry.base import basket, feature_set, register
from cartwise.registry.sqlfrag import PRODUCT_COLS, UP_COLS, USER_COLS, compose

# ---------------------------------------------------------------- SQL pieces
_LF_FRAME = f"""
, targets AS (SELECT order_id, user_id, order_dow, order_hour_of_day FROM orders_v WHERE eval_set = '{{target}}'),
labels AS (SELECT t.user_id, l.product_id, 1 AS hit FROM order_products_v l JOIN targets t ON l.order_id = t.order_id),
tt AS (SELECT t.user_id, CAST(d.total_ord_count_p_dow AS DOUBLE) AS total_ord_count_p_dow,
              CAST(h.total_ord_count_p_ohod AS DOUBLE) AS total_ord_count_p_ohod
       FROM targets t LEFT JOIN dow_counts_lf d ON t.order_dow = d.order_dow
       LEFT JOIN hour_counts_lf h ON t.order_hour_of_day = h.order_hour_of_day),
lft AS (
  SELECT x.user_id, x.product_id, CAST(coalesce(lb.hit, 0) AS INTEGER) AS reordered,
         tt.total_ord_count_p_dow, tt.total_ord_count_p_ohod,
         {", ".join("u." + c for c in USER_COLS)}, {", ".join("p." + c for c in PRODUCT_COLS)},
         {", ".join("x." + c for c in UP_COLS)}
  FROM upf_lf x
  JOIN (SELECT DISTINCT user_id FROM targets) tu ON x.user_id = tu.user_id
  LEFT JOIN labels lb ON x.user_id = lb.user_id AND x.product_id = lb.product_id
  LEFT JOIN tt ON x.user_id = tt.user_id
  JOIN uf_lf u ON x.user_id = u.user_id
  JOIN pf_lf p ON x.product_id = p.product_id)"""

_Z = " + ".join([f"{E.FIXED_LOGIT['intercept']}"] + [f"{w} * coalesce(CAST({c} AS DOUBLE), 0.0)"
                                                       for c, w in E.FIXED_LOGIT.items() if c != "intercept"])
_SCORED = f""",
sc AS (SELECT user_id, product_id, reordered, round(1.0 / (1.0 + exp(-({_Z}))), 9) AS p FROM lft)"""


def lf_sql(body: str, target: str = "train", scored: bool = False) -> str:
    base = compose("SELECT 1", "upf_lf", "uf_lf", "pf_lf", "dow_counts_lf", "hour_counts_lf")
    head = base[: base.rindex("SELECT 1")].rstrip()
    return head + _LF_FRAME.replace("{target}", target) + (_SCORED if scored else "") + "\n" + body


def _lf_frame(spark, sf_dir, target="train"):
    b = basket(spark, sf_dir)
    if target == "train":
        return assemble.train_frame(b.orders, b.lines, b.products, leak_free=True, line_facts=b.line_facts,
                                    fs=feature_set(b, True))
    return assemble.test_frame(b.orders, b.lines, b.products, leak_free=True, line_facts=b.line_facts, fs=feature_set(b, True))


def _scored(spark, sf_dir):
    """The scored training frame, written once per load: every metric and basket query reads it."""
    return basket(spark, sf_dir).once("scored", lambda: materialize(E.score_fixed_logit(_lf_frame(spark, sf_dir)), "scored"))


_R6 = lambda cols, a="": ", ".join(f"round({a}{c}, 6) AS {c}" for c in cols)
_ALL = ["total_ord_count_p_dow", "total_ord_count_p_ohod", *USER_COLS, *PRODUCT_COLS, *UP_COLS]


@register("train_feature_frame_leak_free", lf_sql(
    f"SELECT user_id, product_id, reordered, {_R6(_ALL)} FROM lft"))
def q_train_feature_frame_leak_free(spark, sf_dir):
    return round_doubles(_lf_frame(spark, sf_dir))


@register("test_feature_frame_leak_free", lf_sql(f"SELECT user_id, product_id, {_R6(_ALL)} FROM lft", target="test"))
def q_test_feature_frame_leak_free(spark, sf_dir):
    return round_doubles(_lf_frame(spark, sf_dir, "test"))


@register("score_fixed_logit", lf_sql("SELECT user_id, product_id, reordered, round(p, 6) AS p FROM sc", scored=True))
def q_score_fixed_logit(spark, sf_dir):
    return round_doubles(_scored(spark, sf_dir))


@register("eval_classification", lf_sql("""
, m AS (SELECT CAST(sum(CASE WHEN p >= 0.5 AND reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
               CAST(sum(CASE WHEN p >= 0.5 AND reordered = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
               CAST(sum(CASE WHEN p < 0.5 AND reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
               count(*) AS n,
               avg(-(reordered * ln(least(greatest(p, 1e-15), 1 - 1e-15))
                     + (1 - reordered) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))) AS logloss FROM sc)
SELECT n, tp, fp, fn, round(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 6) AS precision,
       round(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 6) AS recall,
       round(2.0 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round(logloss, 6) AS logloss FROM m""", scored=True))
def q_eval_classification(spark, sf_dir):
    return round_doubles(E.classification_metrics(_scored(spark, sf_dir)))


@register("eval_auc", lf_sql("""
, rk AS (SELECT reordered, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM sc),
s AS (SELECT sum(r) FILTER (WHERE reordered = 1) AS rs, CAST(count(*) FILTER (WHERE reordered = 1) AS BIGINT) AS n_pos,
             CAST(count(*) FILTER (WHERE reordered = 0) AS BIGINT) AS n_neg FROM rk)
SELECT round((rs - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg), 6) AS auc, n_pos, n_neg FROM s""", scored=True))
def q_eval_auc(spark, sf_dir):
    return round_doubles(E.auc(_scored(spark, sf_dir)))


@register("confusion_split", lf_sql("""
SELECT CASE WHEN p >= 0.5 AND reordered = 1 THEN 'TP' WHEN p >= 0.5 THEN 'FP'
            WHEN reordered = 0 THEN 'TN' ELSE 'FN' END AS outcome, count(*) AS count
FROM sc GROUP BY 1""", scored=True))
def q_confusion_split(spark, sf_dir):
    return E.confusion_split(_scored(spark, sf_dir))


@register("prob_none", lf_sql("""
SELECT user_id, round(CASE WHEN max(p) >= 1 THEN 0.0 ELSE exp(sum(ln(1 - p))) END, 6) AS p_none
FROM sc GROUP BY user_id""", scored=True))
def q_prob_none(spark, sf_dir):
    return round_doubles(B.prob_none(_scored(spark, sf_dir)))


_PREV_SQL = compose("""
, t AS (SELECT user_id, order_id, order_number FROM orders_v WHERE eval_set = 'train'),
prev AS (SELECT t.user_id, o.order_id FROM t JOIN orders_v o ON o.user_id = t.user_id AND o.order_number = t.order_number - 1),
pred AS (SELECT prev.user_id, l.product_id FROM prev JOIN order_products_v l ON l.order_id = prev.order_id),
truth AS (SELECT t.user_id, l.product_id FROM t JOIN order_products_v l ON l.order_id = t.order_id),
j AS (SELECT coalesce(pred.user_id, truth.user_id) AS user_id, pred.product_id IS NOT NULL AS ip,
             truth.product_id IS NOT NULL AS it
      FROM pred FULL OUTER JOIN truth ON pred.user_id = truth.user_id AND pred.product_id = truth.product_id),
c AS (SELECT user_id, CAST(count(*) FILTER (WHERE ip AND it) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE ip AND NOT it) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE it AND NOT ip) AS BIGINT) AS fn FROM j GROUP BY user_id)
SELECT user_id, tp, fp, fn, round(2.0 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1,
       round(5.0 * tp / nullif(5 * tp + fp + 4 * fn, 0), 6) AS f2 FROM c""")


@register("f_beta_from_counts", _PREV_SQL.replace("WITH orders_v", "WITH orders_v", 1))
def q_f_beta_from_counts(spark, sf_dir):
    """Previous-order baseline: predict the user's last prior basket for the train order."""
    b = basket(spark, sf_dir)
    t = b.orders.where(F.col("eval_set") == "train").select("user_id", F.col("order_id").alias("t_order"),
                                                            (F.col("order_number") - 1).alias("prev_number"))
    # equi-join on (user, order number): a user with very many orders is spread over tasks
    prev = (t.join(b.orders.select("user_id", F.col("order_number").alias("prev_number"), "order_id"),
                   ["user_id", "prev_number"]).select("user_id", "order_id"))
    # a user's order before the train order is a prior one: each side reads its own partition of the lines
    pred = prev.join(b.lines_in("prior").select("order_id", "product_id"), "order_id").select("user_id", "product_id")
    truth = b.lines_in("train").select("user_id", "product_id")
    return round_doubles(B.f_scores(B.set_counts(pred, truth), betas=(1.0, 2.0)))


# The expected F1 of every cut-off, from the distributions of the hits before it (fwd) and behind it (bwd).
_CURVE_SQL = """
, rk AS (SELECT user_id, product_id, reordered, p, count(*) OVER (PARTITION BY user_id) AS n,
                row_number() OVER (PARTITION BY user_id ORDER BY p DESC, product_id) AS i FROM sc),
fwd(user_id, k, d) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), [1.0::DOUBLE] FROM rk
  UNION ALL
  SELECT f.user_id, f.k + 1, [coalesce(f.d[j + 1], 0.0) * (1 - r.p) + CASE WHEN j > 0 THEN f.d[j] * r.p ELSE 0.0 END FOR j IN range(f.k + 2)]
  FROM fwd f JOIN rk r ON r.user_id = f.user_id AND r.i = f.k + 1),
bwd(user_id, k, d) AS (
  SELECT DISTINCT user_id, n, [1.0::DOUBLE] FROM rk
  UNION ALL
  SELECT b.user_id, b.k - 1, [coalesce(b.d[j + 1], 0.0) * (1 - r.p) + CASE WHEN j > 0 THEN b.d[j] * r.p ELSE 0.0 END FOR j IN range(r.n - b.k + 2)]
  FROM bwd b JOIN rk r ON r.user_id = b.user_id AND r.i = b.k),
hit AS (SELECT user_id, k, unnest(d) AS ph, unnest(range(k + 1)) AS h FROM fwd),
mix AS (SELECT t.user_id, t.k, t.ph, t.h, unnest(b.d) AS pr, unnest(range(len(b.d))) AS r
         FROM hit t JOIN bwd b ON b.user_id = t.user_id AND b.k = t.k),
nothing AS (SELECT user_id, d[1] AS p_none FROM bwd WHERE k = 0),
e AS (SELECT user_id, k, sum(ph * pr * 2 * h / (k + 1 + h + r)) AS w, sum(CASE WHEN h > 0 THEN ph * pr * 2 * h / (k + h + r) ELSE 0.0 END) AS wo
      FROM mix GROUP BY user_id, k),
curve AS (SELECT e.user_id, CAST(k AS INTEGER) AS k, true AS with_none, w + 2 * p_none / (k + 2) AS expected_f1 FROM e JOIN nothing ON e.user_id = nothing.user_id
          UNION ALL SELECT user_id, CAST(k AS INTEGER), false, wo FROM e),
best AS (SELECT user_id, k AS best_k, with_none AS pred_none, expected_f1 AS max_f1 FROM (
           SELECT *, max(expected_f1) OVER (PARTITION BY user_id) AS top FROM curve) t
         WHERE expected_f1 >= top - 1e-12
         QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY with_none DESC, k) = 1)
"""


def curve_sql(body: str) -> str:
    return lf_sql(_CURVE_SQL + body, scored=True).replace("WITH ", "WITH RECURSIVE ", 1)


@register("basket_select", curve_sql("""
SELECT b.user_id, b.best_k, b.pred_none, round(b.max_f1, 6) AS max_f1, CAST(max(r.n) AS INTEGER) AS n_candidates,
       coalesce(string_agg(CAST(r.product_id AS VARCHAR), '|' ORDER BY r.i) FILTER (WHERE r.i <= b.best_k), '') AS products
FROM best b JOIN rk r ON r.user_id = b.user_id GROUP BY b.user_id, b.best_k, b.pred_none, b.max_f1"""))
def q_basket_select(spark, sf_dir):
    # the list as text, so that it hashes the same in any engine
    return round_doubles(B.select(_scored(spark, sf_dir)).withColumn("products", F.array_join("products", "|")))


@register("expected_f1_curve", curve_sql("SELECT user_id, k, with_none, round(expected_f1, 6) AS expected_f1 FROM curve"))
def q_expected_f1_curve(spark, sf_dir):
    return round_doubles(B.expected_f1_curve(_scored(spark, sf_dir)))


@register("basket_f1_eval", curve_sql("""
, t AS (SELECT b.user_id, b.best_k + CAST(b.pred_none AS INTEGER) AS n_pred, greatest(sum(r.reordered), 1) AS n_true,
               sum(CASE WHEN r.i <= b.best_k THEN r.reordered ELSE 0 END)
               + CASE WHEN b.pred_none AND sum(r.reordered) = 0 THEN 1 ELSE 0 END AS tp
        FROM best b JOIN rk r ON r.user_id = b.user_id GROUP BY b.user_id, b.best_k, b.pred_none)
SELECT count(*) AS n_users, round(avg(2.0 * tp / (n_pred + n_true)), 6) AS mean_f1 FROM t"""))
def q_basket_f1_eval(spark, sf_dir):
    return round_doubles(E.basket_f1(_scored(spark, sf_dir)))
