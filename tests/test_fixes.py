"""Inputs that the driver tables do not hold: nulls, long ids, clumped and hot groups, mixed histories, real CSV tables."""

import json
import math
import os
import sys
from types import SimpleNamespace

import numpy as np
import pytest
from conftest import make_lines, make_orders, make_products
from pyspark.sql import functions as F

from cartwise import session
from cartwise.models import fit as M
from cartwise.operators import basket, evaluate, ordered, profile
from cartwise.plans import assemble
from cartwise.sources import csv_io, retail

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "jobs"))


def test_chi_square_leaves_nulls_out(spark):
    rows = [("a", "x")] * 30 + [("a", "y")] * 10 + [("b", "x")] * 12 + [("b", "y")] * 23 + [(None, "x")] * 15 + [("a", None)] * 10
    got = profile.chi_square(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    n, r, c, o = 75, (40, 35), (42, 33), ((30, 10), (12, 23))
    want = sum((o[i][j] - r[i] * c[j] / n) ** 2 / (r[i] * c[j] / n) for i in range(2) for j in range(2))
    assert (got.dof, got.n) == (1, 75) and got.chi2 == pytest.approx(want, abs=1e-5)


def test_products_of_counts_are_doubles(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.2), (0, 0.9)], "reordered int, p double")
    row = evaluate.auc(scored).first()
    assert row.auc == pytest.approx(0.75)
    plan = evaluate.auc(scored)._jdf.queryExecution().analyzed().toString()
    assert "cast(sum(pos" in plan and "cast(sum(neg" in plan


def test_manifest_keeps_long_digits(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, 1.5, "a"), (None, None, None)], "user_id long, f double, s string")
    data, names = csv_io.sink_feature_csv(df, csv_io.new_scratch(spark, "t-long"))
    back = csv_io.scan_with_manifest(spark, data, names, types={"user_id": "long", "s": "string"})
    assert dict(back.dtypes) == {"user_id": "bigint", "f": "double", "s": "string"}
    assert {tuple(r) for r in back.collect()} == {(big, 1.5, "a"), (None, None, None)}


def test_candidates_come_from_prior_lines_only(spark):
    orders = make_orders(spark, [(1, 3, 1, 0, 8, "prior"), (2, 3, 2, 1, 9, "train"), (3, 3, 3, 1, 9, "test")])
    lines = make_lines(spark, [(1, 10, 1, 0), (2, 10, 1, 1), (2, 11, 2, 0)])
    products = make_products(spark, [(10, "red a"), (11, "b")])
    frame = assemble.test_frame(orders, lines, products)
    assert [(r.user_id, r.product_id) for r in frame.collect()] == [(3, 10)]
    assert [(r.user_id, r.product_id) for r in assemble.candidates(orders, lines).collect()] == [(3, 10)]


def test_clumped_hot_group_and_null_key_are_split(spark):
    rows = [(1, 10**9)] + [(1, x) for x in range(9_999)] + [(None, x) for x in range(5_000)]
    df = spark.createDataFrame(rows, "g long, x long")
    seg = ordered.segment(df, ["g"], "x", max_rows=100)
    sizes = [r["count"] for r in seg.groupBy("g", "_seg").count().collect()]
    assert max(sizes) <= 200 and len(sizes) > 100
    out = ordered.row_number(seg, ["g"], ["x"], "rn").where("g IS NULL").orderBy("x").collect()
    assert [r.rn for r in out] == list(range(1, 5_001))


def test_cluster_without_shared_folder_is_an_error():
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="x"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)


def test_every_booster_parameter_is_mapped_or_refused():
    given = {"max_depth": 6, "eta": 0.1, "gamma": 0, "subsample": 0.76, "colsample_bytree": 0.95, "colsample_bylevel": 0.5,
             "min_child_weight": 10, "verbose": 1, "silent": 1, "lambda": 0, "objective": "binary:logistic"}
    got = M.spark_params(given)
    assert got == {"maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.76, "minInstancesPerNode": 10,
                   "featureSubsetStrategy": str(0.95 * 0.5)}
    for name in ("lambda", "alpha", "reg_lambda", "gamma"):
        with pytest.raises(ValueError, match=name):
            M.spark_params({name: 10})
    with pytest.raises(ValueError, match="no_such"):
        M.spark_params({"no_such": 1})


def test_a_repeated_candidate_is_refused(spark):
    rows = spark.createDataFrame([(1, 7, 0.5), (1, 7, 0.4), (1, 8, 0.3)], "user_id long, product_id long, p double")
    with pytest.raises(Exception, match="an item twice"):
        basket.select(rows).collect()
    with pytest.raises(Exception, match="an item twice"):
        basket.expected_f1_curve(rows).collect()


def test_chi_square_tail_of_even_and_odd_degrees(spark):
    def tail(stat, dof):  # finite sums for whole and half numbers
        x = stat / 2
        if dof % 2 == 0:
            return sum(math.exp(k * math.log(x) - x - math.lgamma(k + 1)) for k in range(dof // 2))
        return math.erfc(math.sqrt(x)) + sum(math.exp((k + 0.5) * math.log(x) - x - math.lgamma(k + 1.5)) for k in range((dof - 1) // 2))

    given = [(s, d) for d in (1, 2, 3, 7, 138, 139, 2001) for s in (0.01 * d, 0.6 * d, 0.97 * d, d + 2.0, 1.1 * d, 1.5 * d, 6.0 * d)]
    rows = spark.createDataFrame([*given, (0.0, 4), (3.0, 0)], "stat double, dof long").withColumn(
        "p", profile.chi_square_tail(F.col("stat"), F.col("dof"))).collect()
    for r in rows[:-2]:
        assert r.p == pytest.approx(tail(r.stat, r.dof), abs=1e-9, rel=1e-6)
    assert (rows[-2].p, rows[-1].p) == (1.0, None)


def test_chi_square_pvalue_of_text_categories(spark):
    rows = [(f"a{i % 3}", f"b{i % 4 if i % 5 else 0}") for i in range(600)] + [(None, "b0"), ("a0", None)]
    got = profile.chi_square_pvalue(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    assert got.dof == 6 and got.p_value == pytest.approx(sum(math.exp(k * math.log(got.chi2 / 2) - got.chi2 / 2 - math.lgamma(k + 1)) for k in range(3))
                                                        if got.chi2 > 0 else 1.0, abs=1e-9)


def test_basket_f1_solves_once(spark):
    scored = spark.createDataFrame([(1, 7, 0.9, 1), (1, 8, 0.1, 0), (2, 7, 0.02, 0)], "user_id long, product_id long, p double, reordered int")
    got = evaluate.basket_f1(scored)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
    assert (got.first().n_users, got.first().mean_f1) == (2, pytest.approx(1.0))


def test_lines_without_an_order_are_counted(spark, tmp_path):
    _retail(spark, str(tmp_path))
    assert retail.lines_without_order(retail.load_retail(spark, str(tmp_path))).collect() == []
    make_lines(spark, [(90_001, 1, 1, 0), (90_001, 2, 2, 0)]).write.mode("append").option("header", True).csv(f"{tmp_path}/order_products__prior.csv")
    assert [tuple(r) for r in retail.lines_without_order(retail.load_retail(spark, str(tmp_path))).collect()] == [("no order", 2)]


def test_cells_that_do_not_parse_are_counted(spark, tmp_path):
    _retail(spark, str(tmp_path))
    assert retail.rejected(spark, str(tmp_path)).collect() == []
    spark.createDataFrame([("90001", "u7", "1", "2")], "order_id string, product_id string, add_to_cart_order string, reordered string") \
        .write.mode("append").option("header", True).csv(f"{tmp_path}/order_products__train.csv")
    assert [tuple(r) for r in retail.rejected(spark, str(tmp_path)).collect()] == [("order_products__train", "product_id", "not a number", 1)]


def _retail(spark, folder):
    orders, lines = [], {"prior": [], "train": []}
    number = 0
    for user in range(1, 41):
        for k in range(1, 6):
            number += 1
            kind = "prior" if k < 5 else ("test" if user % 4 == 0 else "train")
            orders.append((number, user, kind, k, k % 7, (user + k) % 24, None if k == 1 else float(k)))
            if kind != "test":
                for pos, product in enumerate({(user * 3 + k) % 17, user % 5, 1}):
                    lines[kind].append((number, product + 1, pos + 1, int(k > 2)))
    spark.createDataFrame(orders, "order_id long, user_id long, eval_set string, order_number int, order_dow int, order_hour_of_day int, "
                          "days_since_prior_order double").write.option("header", True).csv(f"{folder}/orders.csv")
    for kind, rows in lines.items():
        make_lines(spark, rows).write.option("header", True).csv(f"{folder}/order_products__{kind}.csv")
    names = [(i, f"{'Organic' if i % 3 == 0 else 'Plain'} item {i}", 1, 1) for i in range(1, 20)]
    spark.createDataFrame(names, "product_id long, product_name string, aisle_id long, department_id long") \
        .write.option("header", True).csv(f"{folder}/products.csv")


@pytest.mark.parametrize("mode", [[], ["--leak-free"]])
def test_jobs_from_csv_tables(spark, tmp_path, mode):
    import build_dataset
    import train
    _retail(spark, str(tmp_path / "in"))
    frames, out = str(tmp_path / "frames"), str(tmp_path / "out")
    build_dataset.main(["--input", str(tmp_path / "in"), "--output", frames, "--format", "csv", *mode])
    made = spark.read.parquet(frames + "/train_frame")
    assert tuple(made.columns) == assemble.TRAIN_COLUMNS and made.count() > 0
    assert made.agg({"count_of_asian_org_items": "max"}).first()[0] > 0
    train.main(["--frames", frames, "--output", out, "--kind", "glm", "--params", json.dumps({"reg": 0.1})])
    from pyspark.ml.classification import LogisticRegressionModel
    assert LogisticRegressionModel.load(out + "/model").numFeatures == len(assemble.FEATURES)
    for r in spark.read.parquet(out + "/baskets").collect():
        assert len(set(r.products)) == len(r.products)
    assert 0 <= spark.read.json(out + "/validation_basket_f1").first().mean_f1 <= 1


def test_given_probability_of_nothing(spark):
    rows = spark.createDataFrame([(1, 7, 0.4, 0.9), (1, 8, 0.2, 0.9), (2, 7, 0.4, None), (2, 8, 0.2, None)],
                                 "user_id long, product_id long, p double, q double")
    got = {r.user_id: r for r in basket.select(rows, p_none="q").collect()}
    plain = {r.user_id: r for r in basket.select(rows).collect()}
    assert got[2] == plain[2]
    want = basket.best_basket(np.array([0.4, 0.2]), 0.9)
    assert (got[1].best_k, got[1].pred_none, got[1].max_f1) == want != basket.best_basket(np.array([0.4, 0.2]))


def test_line_scans_of_one_eval_set_are_pruned(spark):
    from conftest import SF_SMALL

    from cartwise import registry
    for name in ("dept_reorder_rate", "union_prior_train", "join_candidates"):
        plan = registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.splitlines() if "FileScan" in x and "product_id" in x and "basket-line-facts" in x]
        assert scans and all("PartitionFilters: [isnotnull(eval_set" in x for x in scans), name


def test_the_adapter_drops_no_line_of_the_tables(spark):
    from conftest import SF_SMALL

    from cartwise.sources.views import dropped_rows
    assert dropped_rows(spark, SF_SMALL).collect() == []


def test_running_sums_tell_many_buckets_apart(spark):
    from cartwise.operators.ranking import running_sums
    df = spark.range(20_000).selectExpr("id AS v", "1 AS one")
    out = running_sums(df, "v", ["one"], buckets=2_000).agg({"one_cum": "max"}).first()[0]
    assert out == 20_000
