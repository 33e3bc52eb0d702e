"""cartwise: next-basket analytics on Spark.

Packages
--------
sources    basket tables from parquet / CSV, sinks
operators  frame utilities, joins, profiling statistics, basket selection, evaluation
functions  scalar column helpers
plans      feature plans (user, product, user x product, time, sequences) and frame assembly
models     Spark ML fits, scoring, importances
streaming  (none: the analysed workload is batch only)
registry   named queries and their DuckDB oracle SQL
"""

__all__ = ["session"]
