"""Ordered per-group computations that survive a hot group.

A window ``partitionBy(group).orderBy(x)`` sends each group to one task. If
one group holds a large share of all rows, that task does the whole job.
Here groups above ``max_rows`` rows are cut into segments at quantiles of a
numeric ordering column (``SEGMENTS`` at most); windows run per (group, segment), all sharing one shuffle, and the
results are stitched across segments with a per-segment table that only
exists for hot groups:

* row number  = row number inside the segment + rows of earlier segments
* lead / lag  = inside the segment, else first / last value of the next /
  previous non-empty segment
* group size  = from the group-size aggregate

Rows with equal ordering values always share a segment. Groups at or below
``max_rows`` get segment 0 and no correction. The hot-group and per-segment
tables are joined without broadcast hints (their size grows with the rows).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import materialize

# Groups above this many rows are split.
HOT_GROUP_ROWS = 1_000_000
# Segments that a hot group is cut into (fewer where its ordering values repeat).
SEGMENTS = 256
# Rows of one task of a spread table.
TASK_ROWS = 250_000


def segment(df: DataFrame, keys: list[str], split_col: str, max_rows: int = HOT_GROUP_ROWS,
            largest: int | None = None) -> DataFrame:
    """Add ``_seg`` (segment of the row inside its group) and ``_hot`` (group was split).

    ``largest`` is a known bound on any group's rows; without it the rows of
    ``df`` are counted, so ``df`` should be a read table (a footer-only count)
    and not a plan that has yet to run. If no group can be hot the columns
    are literals (segment 0, not hot): Catalyst prunes every correction branch
    and the plan is the plain window. Otherwise hot groups (null keys too) are
    cut at ``SEGMENTS`` quantiles of their ordering column, so that
    clumped values do not share a segment; equal values still do. Quantiles are
    taken of hot groups alone.
    """
    plain = {"_seg": F.lit(0).cast("long"), "_hot": F.lit(False), "_gsize": F.lit(None).cast("long")}
    most = df.count() if largest is None else largest
    hot = None if most <= max_rows else hot_groups(df, keys, max_rows)
    if hot is None:
        return df.withColumns(plain)
    x = F.col(split_col).cast("double")
    # mergeable quantiles: a hot group is summed up in every task, never gathered in one
    cuts = F.array_distinct(F.percentile_approx(x, [i / SEGMENTS for i in range(SEGMENTS)], 40 * SEGMENTS))
    named = [f"_k{i}" for i in range(len(keys))]
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named, strict=True)))
    bounds = materialize(df.join(hot, same).groupBy(*named).agg(F.first("_n").alias("_n"), cuts.alias("_cuts")), "hot-bounds")
    j = df.join(bounds, same, "left")
    seg = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.size(F.filter("_cuts", lambda c: c <= x)) - 1)).cast("long")
    return (j.withColumn("_seg", seg).withColumn("_hot", F.col("_cuts").isNotNull())
            .withColumn("_gsize", F.col("_n")).drop("_n", "_cuts", *named))


def hot_groups(df: DataFrame, keys: list[str], max_rows: int) -> DataFrame | None:
    """(_k0, ..., _n): the groups above ``max_rows`` rows, written; None if there are none.

    Rows are counted by a hash of the key first: a hash that holds no more than
    ``max_rows`` rows has no hot group, and a task sends one row a hash. Only the
    groups of fuller hashes are counted one by one.
    """
    number = F.pmod(F.xxhash64(*keys), F.lit(max(1024, 16 * df.count() // max_rows)))
    full = materialize(df.groupBy(number.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows).select("_b"), "full-hashes")
    if full.isEmpty():
        return None
    groups = df.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), number.alias("_b")).join(full, "_b", "left_semi")
    hot = materialize(groups.groupBy(*(f"_k{i}" for i in range(len(keys)))).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows), "hot-groups")
    return None if hot.isEmpty() else hot


def spread(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as its ``rows`` need: a task's windows hold ``TASK_ROWS`` on average, whatever the session's setting."""
    return df.repartition(max(1, -(-rows // TASK_ROWS)), *keys)


def _null_safe_left(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which null keys match; the keys stay those of ``df``."""
    renamed = side.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys))
    return df.join(renamed, same, "left").drop(*(f"_j_{k}" for k in keys))


def _w(keys, extra, order):
    return Window.partitionBy(*keys, *extra, "_seg").orderBy(*order)


def row_number(sdf: DataFrame, keys: list[str], order: list[str], name: str,
               extra: tuple[str, ...] = ()) -> DataFrame:
    """Row number of each row in (keys + extra) by ``order`` on a segmented frame."""
    local = sdf.withColumn("_lrn", F.row_number().over(_w(keys, extra, order)))
    seg_counts = (sdf.where("_hot").groupBy(*keys, *extra, "_seg").agg(F.count(F.lit(1)).alias("_c")))
    before = Window.partitionBy(*keys, *extra).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offs = seg_counts.select(*keys, *extra, "_seg", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    out = _null_safe_left(local, offs, [*keys, *extra, "_seg"])
    return out.withColumn(name, (F.col("_lrn") + F.coalesce(F.col("_off"), F.lit(0))).cast("int")) \
        .drop("_lrn", "_off")


def lead_lag(sdf: DataFrame, keys: list[str], order: list[str], value: str, name: str,
             offset: int = 1) -> DataFrame:
    """``lead`` (offset 1) or ``lag`` (offset -1) of ``value`` within the group
    (``value`` must be non-null: a null inside a segment reads as a segment edge)."""
    w = _w(keys, (), order)
    local = F.lead(value, 1).over(w) if offset > 0 else F.lag(value, 1).over(w)
    out = sdf.withColumn("_ll", local)
    # first (for lead) / last (for lag) value of each hot segment, in segment order
    seg_edges = (sdf.where("_hot").groupBy(*keys, "_seg")
                 .agg(F.min_by(value, F.struct(*order)).alias("_first"),
                      F.max_by(value, F.struct(*order)).alias("_last")))
    sw = Window.partitionBy(*keys).orderBy("_seg")
    if offset > 0:
        nb = seg_edges.select(*keys, "_seg", F.lead("_first").over(sw).alias("_nb"))
    else:
        nb = seg_edges.select(*keys, "_seg", F.lag("_last").over(sw).alias("_nb"))
    out = _null_safe_left(out, nb, [*keys, "_seg"])
    return out.withColumn(name, F.when(F.col("_ll").isNotNull(), F.col("_ll")).otherwise(F.col("_nb"))) \
        .drop("_ll", "_nb")


def group_size(sdf: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows in the row's group (window count for normal groups, the size aggregate for hot ones)."""
    w = Window.partitionBy(*keys, "_seg")
    return sdf.withColumn(name, F.when(F.col("_hot"), F.col("_gsize"))
                          .otherwise(F.count(F.lit(1)).over(w)).cast("long"))


def drop_segments(df: DataFrame) -> DataFrame:
    return df.drop("_seg", "_hot", "_gsize")

