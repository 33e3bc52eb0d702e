"""Profiling and statistics: the data behind every exploration figure.

Each function takes DataFrames and returns a DataFrame; nothing is
collected to the driver. Statistics that need two passes (marginals, ranks)
are expressed as aggregates joined back on small keyed frames.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.operators.ranking import average_ranks, exact_quantiles


def _sum0(c: str) -> F.Column:
    # The exploration frames sum an all-null group to 0, not to NULL.
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def dept_reorder_rate(orders: DataFrame, lines: DataFrame, products: DataFrame,
                      departments: DataFrame) -> DataFrame:
    """Items sold, reorders and reorder % per department, prior orders only.

    Chain of left joins keeps prior orders without lines (null department).
    Product and department sides are dimensions: AQE turns those joins into
    broadcasts from measured shuffle sizes, a sort-merge join otherwise.
    """
    prior = orders.where(F.col("eval_set") == "prior").select("order_id")
    j = (prior.join(lines.select("order_id", "product_id", "reordered"), "order_id", "left")
         .join(products.select("product_id", "department_id"), "product_id", "left")
         .join(departments.select("department_id", "department"), "department_id", "left"))
    agg = j.groupBy("department").agg(
        F.count(F.lit(1)).alias("total_prod_sold"),
        _sum0("reordered").alias("reorder_count"),
    )
    return agg.withColumn(
        "reorder_percentage",
        F.round(F.col("reorder_count") / F.col("total_prod_sold") * 100, 6))


def position_reorder_rate(lines: DataFrame) -> DataFrame:
    """Reorder % by cart position; the position is also rendered as text."""
    return (lines.groupBy("add_to_cart_order")
            .agg(F.count(F.lit(1)).alias("total_count"), _sum0("reordered").alias("reorder_count"))
            .withColumn("reorder_cart_ratio",
                        F.round(F.col("reorder_count") / F.col("total_count") * 100, 6))
            .orderBy("add_to_cart_order")
            .withColumn("add_to_cart_label", F.col("add_to_cart_order").cast("string")))


def keyword_reorder_rate(lines: DataFrame, products: DataFrame, pattern: str) -> DataFrame:
    """Case-insensitive keyword flag of the product name × reordered.

    One row per flag value: line counts for reordered 0 / 1, total and
    reorder percentage (the pivot the exploration builds, without a
    value-discovery job: the pivot values are given).
    """
    # the pattern is matched once a product, not once a line
    marked = products.select("product_id", F.col("product_name").rlike("(?i)" + pattern).alias("is_match"))
    flagged = lines.select("product_id", "reordered").join(marked, "product_id", "inner").select("is_match", "reordered")
    piv = flagged.groupBy("is_match").pivot("reordered", [0, 1]).count()
    piv = piv.select("is_match",
                     F.coalesce(F.col("0"), F.lit(0)).alias("not_reordered"),
                     F.coalesce(F.col("1"), F.lit(0)).alias("reordered_count"))
    total = F.col("not_reordered") + F.col("reordered_count")
    return piv.select(
        F.when(F.col("is_match"), "Match").otherwise("No match").alias("label"),
        "is_match", "not_reordered", "reordered_count", total.alias("total"),
        F.round(F.col("reordered_count") / total * 100, 6).alias("reorder_percentage"))


def products_per_aisle(products: DataFrame, departments: DataFrame, aisles: DataFrame) -> DataFrame:
    """Product count per (department, aisle) over the snowflake join."""
    j = (products.join(departments, "department_id", "inner").join(aisles, "aisle_id", "inner"))
    return (j.groupBy("department", "aisle").agg(F.count("product_id").alias("prod_count_p_aisle"))
            .withColumn("aisle_with_br", F.regexp_replace("aisle", "^([^ ]*) ", "$1<br>")))


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """Nulls per column in one pass; long format (table, column_name, null_count)."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return wide.select(F.lit(table).alias("table_name"),
                       F.expr(f"stack({len(df.columns)}, {stack}) AS (column_name, null_count)"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table of one column, the value also as a text label."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("label", F.col(column).cast("string")))


def histogram_fixed(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max] with ``bins`` bins.

    Bounds come from a scalar subquery (one tiny aggregate job), bucketing
    is a per-row expression, counting is a partial + final aggregate.
    """
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    v = F.col(column).cast("double")
    width = (hi - lo) / F.lit(bins)
    raw = F.floor((v - lo) / width) + 1
    bucket = (F.when(hi == lo, F.lit(1))
              .when(raw > bins, F.lit(bins))
              .otherwise(raw)).cast("int")
    b = df.where(F.col(column).isNotNull()).select(bucket.alias("bin"))
    counts = b.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        "bin",
        F.round(lo + (F.col("bin") - 1) * width, 6).alias("bin_start"),
        F.round(lo + F.col("bin") * width, 6).alias("bin_end"),
        "count")


def box_stats(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers and outlier count of a column (nulls dropped).

    ``exact=True``: exact quantiles from distributed running counts over the
    distinct values (``ranking.exact_quantiles``). ``exact=False``:
    ``percentile_approx`` (bounded-memory sketch) for a cheaper single pass.
    """
    v = F.col(column).cast("double")
    nn = df.where(F.col(column).isNotNull()).select(v.alias("v"))
    if exact:
        q1, med, q3 = exact_quantiles(nn, "v", (0.25, 0.5, 0.75))
    else:
        q = nn.agg(F.percentile_approx("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000).alias("q"))
        q1, med, q3 = (q.select(F.col("q")[i]).scalar() for i in range(3))
    lo_fence = q1 - (q3 - q1) * 1.5
    hi_fence = q3 + (q3 - q1) * 1.5
    inside = (F.col("v") >= lo_fence) & (F.col("v") <= hi_fence)
    return nn.agg(
        F.count(F.lit(1)).alias("n"),
        F.first(q1).alias("q1"), F.first(med).alias("median"), F.first(q3).alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.min("v").alias("min_value"), F.max("v").alias("max_value"),
    )


def corr_pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r over rows where both values are present."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return d.agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.corr(F.col(x).cast("double"), F.col(y).cast("double")), 6).alias("pearson_r"))


def corr_spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman rho with average ranks for ties: Pearson r of the ranks.

    Ranks are computed per distinct value with distributed running sums
    (``operators.ranking``), the correlation as a weighted Pearson over the
    distinct (x, y) pairs.
    """
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    rx = average_ranks(d, x, "rx")
    ry = average_ranks(d, y, "ry")
    pairs = d.groupBy(x, y).agg(F.count(F.lit(1)).alias("w"))
    # rank tables have one row per distinct value: AQE broadcasts them when small
    j = pairs.join(rx, x).join(ry, y)
    # weighted Pearson over distinct (x, y) pairs, weights = multiplicity
    n = F.sum("w")
    sx, sy = F.sum(F.col("w") * F.col("rx")), F.sum(F.col("w") * F.col("ry"))
    sxx = F.sum(F.col("w") * F.col("rx") * F.col("rx"))
    syy = F.sum(F.col("w") * F.col("ry") * F.col("ry"))
    sxy = F.sum(F.col("w") * F.col("rx") * F.col("ry"))
    cov = sxy - sx * sy / n
    rho = cov / F.sqrt((sxx - sx * sx / n) * (syy - sy * sy / n))
    return j.agg(n.alias("n"), F.round(rho, 6).alias("spearman_rho"))


def contingency(df: DataFrame, row: str, col: str, values: list[int]) -> DataFrame:
    """Wide row × col count table (null cells → 0), columns ``{col}_{v}``."""
    piv = df.groupBy(row).pivot(col, values).count()
    return piv.select(row, *[F.coalesce(F.col(str(v)), F.lit(0)).alias(f"{col}_{v}") for v in values])


def cell_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long (row, col, count) table, sorted by both keys."""
    return df.groupBy(row, col).agg(F.count(F.lit(1)).alias("count")).orderBy(row, col)


def chi_square(df: DataFrame, row: str, col: str) -> DataFrame:
    """Chi-square test of independence of two categorical columns.

    Rows with a null in either column are left out.

    Expected counts need the row and column marginals; both are small keyed
    aggregates (one row per category) joined back to the cell counts. Cells
    never observed still contribute their expected count, so the cell grid is
    the product of the observed categories, built from the two marginals.
    """
    cells = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(F.count(F.lit(1)).alias("_o"))
    # doubles: the product of two marginals does not fit a long
    rows = cells.groupBy(row).agg(F.sum("_o").cast("double").alias("_r"))
    cols = cells.groupBy(col).agg(F.sum("_o").cast("double").alias("_c"))
    total = cells.agg(F.sum("_o")).scalar()
    n_rows = rows.select(F.count(F.lit(1))).scalar()
    n_cols = cols.select(F.count(F.lit(1))).scalar()
    # observed part: sum over observed cells of (o - e)^2 / e
    obs = (cells.join(rows, row).join(cols, col)
           .select(((F.col("_o") - F.col("_r") * F.col("_c") / total) ** 2
                    / (F.col("_r") * F.col("_c") / total)).alias("term"),
                   (F.col("_r") * F.col("_c") / total).alias("e")))
    # unobserved cells contribute e each: total expected mass minus observed cells' e
    stat = obs.agg((F.sum("term") + (total - F.sum("e"))).alias("chi2"))
    return stat.select(F.round("chi2", 6).alias("chi2"),
                       ((n_rows - 1) * (n_cols - 1)).cast("long").alias("dof"),
                       total.cast("long").alias("n"))


def chi_square_tail(stat: Column, dof: Column) -> Column:
    """P(a chi-square variable with ``dof`` degrees of freedom exceeds ``stat``), as a native expression; null without freedom.

    It is the upper regularised incomplete gamma function Q(a, x) at a = dof / 2, x = stat / 2: below x = a + 1 one
    minus its power series, above it its continued fraction. Both settle within a few times sqrt(a) steps.
    """
    x, a = stat.cast("double") / 2, dof.cast("double") / 2
    steps = F.sequence(F.lit(1).cast("long"), (F.lit(100) + 15 * F.sqrt(a)).cast("long"))
    below = F.floor((dof - 1) / 2)
    # ln of gamma(a): a - 1, a - 2, ... down to 1, or to 1/2 and then gamma(1/2) = sqrt(pi)
    logs = F.aggregate(F.when(below >= 1, F.sequence(F.lit(1).cast("long"), below)).otherwise(F.array().cast("array<bigint>")),
                       F.lit(0.0), lambda acc, k: acc + F.log(a - k))
    ln_gamma = logs + F.when(dof % 2 == 1, F.lit(0.5 * math.log(math.pi))).otherwise(0.0)
    front = F.exp(a * F.log(x) - x - ln_gamma)

    def struct(**fields: Column) -> Column:
        return F.struct(*(c.cast("double").alias(n) for n, c in fields.items()))

    def more(acc: Column, k: Column) -> Column:
        term = acc["term"] * x / (a + k)
        return struct(term=term, total=acc["total"] + term)

    def deeper(acc: Column, k: Column) -> Column:
        up = -k * (k - a)
        b = acc["b"] + 2.0
        c, d = b + up / acc["c"], 1.0 / (up * acc["d"] + b)
        return struct(b=b, c=c, d=d, h=acc["h"] * c * d)

    series = 1.0 - front * F.aggregate(steps, struct(term=1.0 / a, total=1.0 / a), more)["total"]
    b0 = x + 1.0 - a
    fraction = front * F.aggregate(steps, struct(b=b0, c=F.lit(1e300), d=1.0 / b0, h=1.0 / b0), deeper)["h"]
    return F.when(dof < 1, F.lit(None).cast("double")).when(x <= 0, F.lit(1.0)).when(x < a + 1, series).otherwise(fraction)


def chi_square_pvalue(df: DataFrame, row: str, col: str) -> DataFrame:
    """``chi_square`` with its p-value, for categories of any type and number (rounded to 9 digits)."""
    return chi_square(df, row, col).select("chi2", "dof", F.round(chi_square_tail(F.col("chi2"), F.col("dof")), 9).alias("p_value"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def max_per_key(df: DataFrame, key: str, column: str, alias: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(column).alias(alias)).orderBy(alias)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


