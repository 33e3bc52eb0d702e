"""Physical-plan properties of the headline queries (read with explain)."""

import contextlib
import io

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry

QUERIES = entry.queries()


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["train_feature_frame", "test_feature_frame", "product_features",
                                  "user_features", "dept_reorder_rate", "eval_auc", "join_cooccurrence",
                                  "product_cooccurrence_stats", "chi_square_independence", "box_add_to_cart"])
def test_no_cartesian_or_nested_loop(spark, name):
    txt = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt


def test_eval_set_filter_prunes_partitions(spark):
    txt = _plan(QUERIES["filter_test_orders"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(eval_set" in txt and "test" in txt


def test_train_frame_shuffles_lines_once_and_broadcasts_products(spark):
    txt = _plan(QUERIES["train_feature_frame"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in txt
    # the line facts are never repartitioned by order_id or product_id in the final join chain
    facts_exchanges = [ln for ln in txt.splitlines() if "Exchange hashpartitioning(order_id" in ln]
    assert not facts_exchanges


def _first_side(plan) -> list[str]:
    """Operators from the top of the plan down to the scan of the first (line-sized) side."""
    names = []
    while True:
        names.append(plan.nodeName())
        if names[-1] == "AdaptiveSparkPlan":
            plan = plan.initialPlan()
            continue
        below = plan.children()
        if below.isEmpty():
            return names
        plan = below.apply(0)


def test_train_frame_shuffles_lines_once_when_products_are_not_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = QUERIES["train_feature_frame"](spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8192")  # the calendar totals are smaller, the features larger
    try:
        names = _first_side(df.select("*")._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert names[-1].startswith("Scan parquet")
    assert names.count("Exchange") == 1 and names.count("BroadcastHashJoin") == 2 and names.count("SortMergeJoin") == 1


def test_train_frame_of_lines_without_user_or_product(spark):
    from conftest import make_lines, make_orders, make_products

    from cartwise.plans import assemble
    orders = make_orders(spark, [(1, 7, 1, 0, 9), (2, 7, 2, 1, 9), (3, None, 1, 0, 10)])
    lines = make_lines(spark, [(1, 5, 1, 0), (2, 5, 1, 1), (2, None, 2, 0), (3, 5, 1, 0)])
    got = assemble.train_frame(orders, lines, make_products(spark, [(5, "red thing")])).collect()
    assert len(got) == 4
    rows = {(r.user_id, r.product_id, r.reordered): r for r in got}
    own, nobody, nothing = rows[7, 5, 1], rows[None, 5, 0], rows[7, None, 0]
    assert (own.num_of_ord_purch_p_prod, own.frequency_of_reorder, own.total_ord_count_p_dow) == (2.0, 3.0, 1.0)
    assert nobody.product_mean_of_position == own.product_mean_of_position == 1.0
    assert (nobody.num_of_ord_purch_p_prod, nobody.frequency_of_reorder) == (None, None)
    assert (nothing.product_mean_of_position, nothing.num_of_ord_purch_p_prod) == (None, None)


def test_cooccurrence_emits_no_pairs(spark):
    txt = _plan(QUERIES["product_cooccurrence_total"](spark, SF_SMALL))
    # no join of the line table with itself on order_id plus an inequality
    assert "NOT (product_id" not in txt and "NOT product_id" not in txt
