"""Every registered query runs; every SQL-checked query matches DuckDB on sf0.001."""

import os
import sys

import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402

from cartwise import registry  # noqa: E402
from cartwise.models import fit as M  # noqa: E402
from cartwise.plans.assemble import FEATURES  # noqa: E402

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from check_oracle import duck
    return duck(SF_SMALL)


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 100


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.limit(5).collect()
    assert len(df.columns) == 37 and len(rows) == 5
    assert all(r.user_id is not None and r.reordered in (0, 1) for r in rows)


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k in ORACLE))
def test_matches_oracle(spark, con, name):
    from check_oracle import _rows
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    dk = con.sql(ORACLE[name]).df()
    sc, sr = _rows(sp)
    dc, dr = _rows(dk)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def _finite_share(values):
    return all(0 <= v <= 1 for v in values)


def _history_falls(rows):
    losses = [r.loss for r in sorted(rows, key=lambda r: r.iteration)]
    return len(losses) > 1 and losses[-1] < losses[0]


def _stopped_by_patience(rows):
    losses = [r.valid_loss for r in sorted(rows, key=lambda r: r.iteration)]
    best = losses.index(min(losses)) + 1
    return sum(r.kept for r in rows) == best and (len(rows) == best + M.PATIENCE or len(rows) == M.ROUNDS)


#: What each query without SQL must satisfy on the small tables.
PROPERTIES = {
    "scan_labelled_matrix": lambda rows: len(rows) > 0 and all(r.label_index == 7 and r.features.size == 7 for r in rows),
    "basket_f1_eval_model": lambda rows: _finite_share([r.mean_f1 for r in rows]),
    "train_glm": lambda rows: len(rows) == len(FEATURES) + 1 and any(r.coefficient != 0 for r in rows),
    "train_gbm": lambda rows: rows[0].logloss < 0.6932,
    "train_rf": lambda rows: rows[0].auc > 0.5,
    "train_rf_curve": lambda rows: sorted(r.trees for r in rows) == list(range(1, 21)) and all(0 < r.loss < 1 for r in rows),
    "train_early_stop": _stopped_by_patience,
    "train_folds": lambda rows: (lambda n: len(n) == 3 and n == sorted(n))([r.n_trees for r in sorted(rows, key=lambda r: r.fold)]),
    "score_frame": lambda rows: _finite_share([r.p for r in rows]),
    "feature_importance": lambda rows: abs(sum(r.importance for r in rows) - 1) < 1e-6,
    "feature_split_counts": lambda rows: sum(r.n_splits for r in rows) > 0,
    "features_unused": lambda rows: len({r.feature for r in rows} & set(FEATURES)) == len(rows) < len(FEATURES),
    "loss_history": _history_falls,
}


def test_every_open_query_has_a_property():
    assert set(PROPERTIES) == set(QUERIES) - set(ORACLE)


@pytest.mark.parametrize("name", sorted(PROPERTIES))
def test_property_of_open_query(spark, name):
    assert PROPERTIES[name](QUERIES[name](spark, SF_SMALL).collect())
