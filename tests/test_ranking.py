"""Distributed running sums, average ranks and AUC against direct computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwise.operators import evaluate as E
from cartwise.operators.ranking import average_ranks, running_sums


def test_running_sums_exact(spark):
    rng = np.random.default_rng(1)
    vals = np.unique(rng.integers(0, 5000, 800))
    w = rng.integers(1, 5, len(vals))
    df = spark.createDataFrame(pd.DataFrame({"v": vals.astype("int64"), "w": w.astype("int64")}))
    got = running_sums(df, "v", ["w"], buckets=16).toPandas().sort_values("v")
    assert (got["w_cum"].to_numpy() == np.cumsum(w)).all()


def test_average_ranks_ties(spark):
    df = spark.createDataFrame([(x,) for x in [3, 1, 2, 2, 5, 3, 3]], "x long")
    got = {r.x: r.rx for r in average_ranks(df, "x", "rx", buckets=4).collect()}
    expect = pd.Series([3, 1, 2, 2, 5, 3, 3]).rank(method="average")
    for x, r in zip([3, 1, 2, 2, 5, 3, 3], expect):
        assert got[x] == pytest.approx(r)


def test_auc_matches_pairwise(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.random(300) * 0.5 + y * 0.2, 2)  # rounding creates ties
    df = spark.createDataFrame(pd.DataFrame({"reordered": y.astype("int32"), "p": p}))
    got = E.auc(df).collect()[0].auc
    pos, neg = p[y == 1], p[y == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert got == pytest.approx(pairs / (len(pos) * len(neg)))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 40, 501).astype(float)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    from cartwise.operators.ranking import exact_quantiles
    cols = exact_quantiles(df, "x", (0.1, 0.25, 0.5, 0.75, 0.9))
    got = df.limit(1).select(*[c.alias(f"q{i}") for i, c in enumerate(cols)]).collect()[0]
    expect = np.quantile(x, [0.1, 0.25, 0.5, 0.75, 0.9])  # linear interpolation
    assert list(got) == pytest.approx(list(expect))


def test_longs_above_two_to_53_rank_apart(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(v,) for v in [big + 1, big, big + 2, big + 1, -big - 1, -big]], "x long")
    got = {r.x: r.rx for r in average_ranks(df, "x", "rx").collect()}
    assert got == {-big - 1: 1.0, -big: 2.0, big: 3.0, big + 1: 4.5, big + 2: 6.0}


def test_ranks_of_other_types(spark):
    df = spark.sql("SELECT * FROM VALUES ('b', DATE'2020-01-02', CAST(1.10 AS DECIMAL(20,2))), ('a', DATE'2019-01-01', 1.20), "
                   "('b', DATE'2021-01-01', 1.10) AS t(s, d, c)")
    assert {r.s: r.r for r in average_ranks(df, "s", "r").collect()} == {"a": 1.0, "b": 2.5}
    assert sorted((str(r.d), r.r) for r in average_ranks(df, "d", "r").collect()) == [("2019-01-01", 1.0), ("2020-01-02", 2.0), ("2021-01-01", 3.0)]
    assert {float(r.c): r.r for r in average_ranks(df, "c", "r").collect()} == {1.1: 1.5, 1.2: 3.0}


def test_ranges_ascend_keep_ties_and_share_the_rows(spark):
    from cartwise.operators.ranking import value_ranges
    df = spark.range(40_000).selectExpr("(id * 7919) % 20000 AS v")  # every value twice
    rows = value_ranges(df, "v", buckets=40).groupBy("_bucket").agg({"v": "min", "*": "count"}).orderBy("_bucket").collect()
    tops = value_ranges(df, "v", buckets=40).groupBy("v").agg(F.countDistinct("_bucket").alias("n")).agg({"n": "max"}).first()[0]
    assert tops == 1  # a value is in one range only
    least = [r["min(v)"] for r in rows]
    assert least == sorted(least) and sum(r["count(1)"] for r in rows) == 40_000
    assert len(rows) >= 30 and max(r["count(1)"] for r in rows) <= 3 * 40_000 / 40


def test_every_running_sum_of_many_ranges(spark):
    df = spark.range(20_000).selectExpr("id AS v", "id % 3 AS w")
    out = running_sums(df, "v", ["w"], buckets=50).where("w_cum <> (v div 3) * 3 + CASE v % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END")
    assert out.count() == 0
