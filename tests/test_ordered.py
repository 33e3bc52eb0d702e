"""Segmented (hot-group) ordered computations equal plain windows."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwise.operators import ordered
from cartwise.plans import sequence
from cartwise.plans.base import split_inputs
from cartwise.sources.views import load_basket, orders_view, lines_view


@pytest.fixture(scope="module")
def facts(spark):
    b = load_basket(spark, SF_SMALL)
    return split_inputs(b.orders, b.lines, b.products).materialize().facts


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_row_number_lead_lag_size_with_hot_groups(spark):
    rows = [(g, x, float(x % 7)) for g in (1, 2) for x in range(1, 60)] + [(3, 5, 1.0)]
    df = spark.createDataFrame(rows, "g long, x long, v double")
    seg = ordered.segment(df, ["g"], "x", max_rows=10)
    assert seg.where("_hot").count() == 118 and seg.select("_seg").distinct().count() > 3
    out = ordered.row_number(seg, ["g"], ["x"], "rn")
    out = ordered.lead_lag(out, ["g"], ["x"], "x", "nx", 1)
    out = ordered.lead_lag(out, ["g"], ["x"], "x", "px", -1)
    out = ordered.group_size(out, ["g"], "n")
    w = Window.partitionBy("g").orderBy("x")
    ref = df.select("g", "x", F.row_number().over(w).alias("rn"), F.lead("x").over(w).alias("nx"),
                    F.lag("x").over(w).alias("px"), F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n"))
    assert _rows(out, ["g", "x", "rn", "nx", "px", "n"]) == _rows(ref, ["g", "x", "rn", "nx", "px", "n"])


@pytest.mark.parametrize("fn", [sequence.streaks_flagged, sequence.streaks_islands, sequence.next_order_number])
def test_sequences_hot_path_equals_plain(facts, fn):
    cols = fn(facts).columns
    assert _rows(fn(facts, max_rows=2), cols) == _rows(fn(facts), cols)


def test_views_hot_path_equals_plain(spark):
    plain_o = orders_view(spark, SF_SMALL)
    hot_o = orders_view(spark, SF_SMALL, max_rows=2)
    assert _rows(hot_o, plain_o.columns) == _rows(plain_o, plain_o.columns)
    plain_l = lines_view(spark, SF_SMALL)
    hot_l = lines_view(spark, SF_SMALL, max_rows=2)
    assert _rows(hot_l, plain_l.columns) == _rows(plain_l, plain_l.columns)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_many_small_groups_need_no_quantiles(spark):
    """More rows than a hot group has, but no hot group: the plain plan, whatever the number of groups."""
    df = spark.range(3000).selectExpr("id % 600 AS g", "id AS x").unionByName(spark.range(4).selectExpr("CAST(NULL AS long) AS g", "id AS x"))
    seg = ordered.segment(df, ["g"], "x", max_rows=100)
    assert "Join" not in _plan(seg) and "percentile" not in _plan(seg)
    assert seg.where("_hot OR _seg <> 0").count() == 0 and seg.count() == 3004


def test_only_hot_groups_are_cut(spark):
    """A hot null group and a hot key among cold ones, also cold ones that share a full hash."""
    rows = [(None, x) for x in range(50)] + [(7, x) for x in range(40)] + [(g, x) for g in range(100, 400) for x in range(5)]
    df = spark.createDataFrame(rows, "g long, x long")
    seg = ordered.segment(df, ["g"], "x", max_rows=20)
    hot = {(r.g, r._gsize) for r in seg.where("_hot").select("g", "_gsize").distinct().collect()}
    assert hot == {(None, 50), (7, 40)} and seg.count() == len(rows)
    got = ordered.row_number(seg, ["g"], ["x"], "rn")
    assert got.where("rn <> x + 1").count() == 0 and seg.where("NOT _hot AND (_seg <> 0 OR _gsize IS NOT NULL)").count() == 0


def test_sequence_windows_are_spread_by_rows(facts, monkeypatch):
    cols = ["user_id", "product_id", "grp", "length_of_streaks"]
    want = _rows(sequence.streaks_flagged(facts), cols)
    monkeypatch.setattr(ordered, "TASK_ROWS", 500)
    out = sequence.streaks_flagged(facts)
    tasks = -(-facts.count() // 500)
    assert tasks > 8 and "RepartitionByExpression [user_id" in _plan(out) and f"], {tasks}" in _plan(out)
    assert _rows(out, cols) == want


def test_orders_alone_read_no_lines(spark, monkeypatch):
    from cartwise.sources import views
    monkeypatch.setattr(views, "_MATERIALIZED", {})
    written = []
    write = views.materialize_table
    monkeypatch.setattr(views, "materialize_table", lambda df, name, **kw: written.append(name) or write(df, name, **kw))
    b = load_basket(spark, SF_SMALL, materialize=True)
    assert b.products.count() and b.orders.count() and written == ["basket-orders"]
    assert b.lines.count() == b.line_facts.count() and written == ["basket-orders", "basket-lines", "basket-line-facts"]
