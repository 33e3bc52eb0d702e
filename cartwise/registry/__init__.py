"""Named queries (Spark) and their DuckDB oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the driver's tables and returns
a DataFrame. ``ORACLE[name]`` is ANSI SQL over the same base tables, with the
basket views inlined as CTEs. Queries without a SQL form are listed in
``ROWS_ONLY`` and are checked in ``tests/`` against brute force instead.
"""

from __future__ import annotations

from cartwise.registry import basket_q, features_q, frames_q, models_q, profile_q, sources_q  # noqa: F401 - they register
from cartwise.registry.base import ORACLE, QUERIES, ROWS_ONLY


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)


__all__ = ["queries", "oracle_sql", "ROWS_ONLY"]
