"""Distributed running sums in value order (ranks, ROC counts).

A window ordered over a whole column without ``partitionBy`` moves every
row into one task. Instead the rows are range-partitioned on the column in its
own type (Spark samples the borders; no cast, so neighbouring longs above 2^53
stay apart), written with the number of their range, range totals are summed
into offsets (one row a range, broadcast with that proven bound) and the
running sum continues inside each range with a window partitioned by the
range. Equal values always fall into the same range, so ties stay together
and the sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import materialize

DEFAULT_BUCKETS = 64


def value_ranges(df: DataFrame, order_col: str, buckets: int = DEFAULT_BUCKETS, name: str = "_bucket") -> DataFrame:
    """``df`` with the number of its value range, ascending with ``order_col``; written once.

    There are as many ranges as ``buckets`` or the session's shuffle partitions,
    whichever is more: a session sized for the data gets ranges sized for it.
    """
    n = max(buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # the number is read off the partition while the table is written, so that both always agree
    return materialize(df.repartitionByRange(n, F.col(order_col).asc()).withColumn(name, F.spark_partition_id()), "value-ranges")


def running_sums(df: DataFrame, order_col: str, sum_cols: list[str], buckets: int = DEFAULT_BUCKETS,
                 suffix: str = "_cum") -> DataFrame:
    """Add ``<col><suffix>`` = sum of ``col`` over all rows with order value <= this row's.

    ``df`` should be unique on ``order_col`` (aggregate to distinct values first);
    rows with equal values get the same, inclusive total.
    """
    tmp = "_bucket"
    ranged = value_ranges(df, order_col, buckets, tmp)
    totals = ranged.groupBy(tmp).agg(*[F.sum(c).alias(c + "_tot") for c in sum_cols])
    before = Window.orderBy(tmp).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(tmp, *[F.coalesce(F.sum(c + "_tot").over(before), F.lit(0)).alias(c + "_off")
                                   for c in sum_cols])
    within = Window.partitionBy(tmp).orderBy(order_col).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.join(F.broadcast(offsets), tmp, "left")
    out = out.withColumns({c + suffix: F.col(c + "_off") + F.sum(c).over(within) for c in sum_cols})
    return out.drop(tmp, *[c + "_off" for c in sum_cols])


def average_ranks(df: DataFrame, column: str, name: str, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """(value, average rank) over the non-null values of ``column`` (ties share their mean rank)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    cum = running_sums(counts, column, ["cnt"], buckets)
    return cum.select(column, ((F.col("cnt_cum") - F.col("cnt") + 1 + F.col("cnt_cum")) / 2.0).alias(name))


def exact_quantiles(df: DataFrame, column: str, probs: tuple[float, ...],
                    buckets: int = DEFAULT_BUCKETS) -> list[F.Column]:
    """Exact quantiles with linear interpolation (position (n - 1)·q), as scalar columns.

    Per distinct value a count, then distributed running counts; the value at
    0-based rank i is the smallest value whose running count exceeds i. No
    task holds more than one bucket of distinct values (an exact
    ``percentile`` aggregate merges every distinct value in one task).
    """
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("cnt")))
    cum = materialize(running_sums(counts, "v", ["cnt"], buckets), "quantile-ranks")
    n = cum.agg(F.sum("cnt")).scalar()
    out = []
    for q in probs:
        h = (n - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        v_lo = cum.where(F.col("cnt_cum") > lo).agg(F.min("v").cast("double")).scalar()
        v_hi = cum.where(F.col("cnt_cum") > hi).agg(F.min("v").cast("double")).scalar()
        out.append(v_lo + (h - lo) * (v_hi - v_lo))
    return out
