r"""Quality rules: base limits, then robust multivariate outliers per language and source.

Native: DataFrame functions only. Counts of the base rules come from arrays of
one text; windows that recur are found by sorting a text's window hashes, and
only for texts that have any. Five transformed statistics (``FEATURES``) make a
vector. Per (lang, source) the minimum-covariance-determinant estimate is
found by concentration steps: start from medians and quartile spreads, keep
the half of the rows nearest to the centre, take their mean and covariance,
repeat. Quantiles are read off counts of fixed bins and sums are plain
aggregates, so a source with a third of all rows is only ever partially
aggregated. A floor on each spread regularises the covariance (constant
statistics, small groups). A document is rejected if its squared Mahalanobis
distance, scaled to the chi-square median, is over ``CUT``.

Every row is judged: a group of fewer than ``MIN_GROUP`` passing rows by the
estimate over all rows of its language, a language of fewer than ``MIN_LANGUAGE``
(where half the rows do not span the space) by the estimate over all rows.
Defined results: null text has no words (and fails the base rules); null lang or
source is a value of its own; repeated rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.common import Scratch, table

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

MIN_GROUP = 60
MIN_LANGUAGE = 12
STEPS = 4
#: Squared distance beyond which a row is an outlier: chi-square with 5 degrees of freedom passes it once in 10^8.
CUT = 46.0
CHI2_MEDIAN = 4.351

#: Statistic (of the counts) and the least spread that it is given.
FEATURES = {
    "length": (lambda: F.log1p("n_words"), 0.8),
    "word_length": (lambda: (F.col("word_chars") + 125) / (F.col("n_words") + 25), 0.35),
    "symbols": (lambda: F.log1p(100 * F.col("n_symbols") / (F.col("n_words") + 10)), 0.45),
    "repeats": (lambda: F.log1p(100 * (F.col("n_repeat_words") + 5 * F.col("n_dup_lines")) / (F.col("n_words") + 10)), 0.8),
    "capitals": (lambda: F.log1p(100 * F.col("n_capitals") / (F.col("word_chars") + 50)), 0.35),
}
D = len(FEATURES)
#: Bins a unit of log(1 + x), and their greatest number: no statistic of a text gets beyond it.
BINS = 400
MOST_BINS = 9000


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of the rules."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), text.alias("text"))
    rows = rows.select("doc_id", "lang", "source", "text", F.array_remove(F.split("text", SPACE), "").alias("words"),
                       F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("words")
    rows = rows.select("doc_id", "lang", "source", "text", n.alias("n_words"), F.length(F.array_join("words", "")).alias("word_chars"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                       F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.col("n_words") - WINDOW), lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW)))))
    removed = lambda pattern: F.length("text") - F.length(F.regexp_replace("text", pattern, ""))
    rows = rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_dup_lines", removed(SYMBOLS).alias("n_symbols"),
                       removed("[A-Z]+").alias("n_capitals"), windows.alias("windows"))
    recur = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.when(recur, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.select(*(c for c in rows.columns if c != "windows"), ordered.alias("ordered"))
    twins = F.filter("ordered", lambda x, i: (F.get("ordered", i - 1)["h"] == x["h"]) | (F.get("ordered", i + 1)["h"] == x["h"]))
    rows = rows.select(*(c for c in rows.columns if c != "ordered"), F.sort_array(F.transform(twins, lambda x: x["i"])).alias("begins"))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate("begins", start, lambda a, b: F.struct(b.alias("last"), (a["n"] + F.least(F.lit(WINDOW), b - a["last"])).alias("n")),
                          lambda a: a["n"])
    long = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_capitals")]
    return rows.select("doc_id", "lang", "source", *long, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binned_quantile(rows: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """Per key, the upper edge of the bin where the counts reach ``share``; ``value`` is an integer bin."""
    from pyspark.sql import Window

    binned = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))  # bounded: fixed bins per key
    upto = Window.partitionBy(*keys).orderBy(value)
    summed = binned.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    return summed.where(F.col("upto") >= share * F.col("all")).groupBy(*keys).agg((F.min(value) + 1).alias("edge"))


def cholesky(c: list[list[Column]]) -> list[list[Column]]:
    """Lower factor of a covariance given as columns."""
    low: list[list[Column]] = [[F.lit(0.0)] * D for _ in range(D)]
    for i in range(D):
        for j in range(i + 1):
            rest = c[i][j] - sum((low[i][k] * low[j][k] for k in range(j)), F.lit(0.0))
            low[i][j] = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / low[j][j]
    return low


def estimate_columns() -> list[str]:
    return [*(f"m{i}" for i in range(D)), *(f"l{i}{j}" for i in range(D) for j in range(i + 1))]


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. from the joined estimate, by forward substitution."""
    y: list[Column] = []
    for i in range(D):
        rest = F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}{j}") * y[j] for j in range(i)), F.lit(0.0))
        y.append(rest / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, (v * v for v in y))


def estimate(rows: DataFrame) -> DataFrame:
    """Mean and factored covariance (spread floors added) of each group's rows."""
    floors = [floor for _, floor in FEATURES.values()]
    sums = rows.groupBy("pool").agg(F.count("*").alias("n"), *(F.avg(f"x{i}").alias(f"m{i}") for i in range(D)),
                                    *(F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i in range(D) for j in range(i + 1)))
    cov = [[F.col(f"c{max(i, j)}{min(i, j)}") + (floors[i] ** 2 if i == j else 0.0) for j in range(D)] for i in range(D)]
    low = cholesky(cov)
    return sums.select("pool", *(f"m{i}" for i in range(D)), *(low[i][j].alias(f"l{i}{j}") for i in range(D) for j in range(i + 1)))


def first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and quartile spreads on the diagonal."""
    bins = (F.least(F.floor(F.log1p(f"x{i}") * BINS), F.lit(MOST_BINS)) for i in range(D))
    long = rows.select("pool", F.posexplode(F.array(*bins)).alias("at", "bin"))
    edges = [binned_quantile(long, ["pool", "at"], "bin", q).withColumnRenamed("edge", f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)]
    parts = edges[0].join(edges[1], ["pool", "at"]).join(edges[2], ["pool", "at"])
    value = {q: F.expm1(F.col(q) / BINS) for q in ("q25", "q50", "q75")}
    spread = (value["q75"] - value["q25"]) / 1.349
    wide = parts.groupBy("pool").agg(*(F.max(F.when(F.col("at") == i, value["q50"])).alias(f"m{i}") for i in range(D)),
                                     *(F.max(F.when(F.col("at") == i, spread)).alias(f"s{i}") for i in range(D)))
    floors = [floor for _, floor in FEATURES.values()]
    low = [F.sqrt(F.col(f"s{i}") * F.col(f"s{i}") + floors[i] ** 2).alias(f"l{i}{i}") if i == j else F.lit(0.0).alias(f"l{i}{j}")
           for i in range(D) for j in range(i + 1)]
    return wide.select("pool", *(f"m{i}" for i in range(D)), *low)


def distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    out = rows.join(estimates, "pool").withColumn("d2", distance())
    return out.drop(*estimate_columns()).withColumn("bin", F.floor(40 * F.log(F.col("d2") + 1e-6)).cast("int"))


def bin_edge(edge: str) -> Column:
    return F.exp(F.col(edge) / 40.0)


def pools(groups: DataFrame) -> DataFrame:
    """Per (lang, source) of ``groups`` (with its row count n): the pool that judges it, and all pools that its rows estimate."""
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.min("n").alias("least"))
    langs = langs.withColumn("lang_judges", (F.col("least") < MIN_GROUP) & (F.col("lang_n") >= MIN_LANGUAGE))
    all_judge = langs.agg(F.min("lang_n") < MIN_LANGUAGE).scalar()
    own = F.concat(F.lit("source:"), F.length("lang").cast("string"), F.lit(":"), "lang", "source")  # no two pairs share it
    of_lang, of_all = F.concat(F.lit("lang:"), "lang"), F.lit("all")
    has_own = F.col("n") >= MIN_GROUP
    judge_pool = F.when(has_own, own).when(F.col("lang_n") >= MIN_LANGUAGE, of_lang).otherwise(of_all)
    into = F.array_compact(F.array(F.when(has_own, own), F.when(F.col("lang_judges"), of_lang), F.when(all_judge, of_all)))
    return groups.join(langs, "lang").select("lang", "source", judge_pool.alias("pool"), into.alias("into"))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the scaled squared distance (null only where a group's rows all fail the base rules)."""
    scratch = Scratch(docs.sparkSession, "quality-rules")
    counted = scratch.write(counts(docs).withColumn("base_failed", base_failed()), "counts")
    named = counted.withColumn("lang", F.coalesce("lang", F.lit("\u0000"))).withColumn("source", F.coalesce("source", F.lit("\u0000")))
    groups = scratch.write(named.where("NOT base_failed").groupBy("lang", "source").agg(F.count("*").alias("n")), "groups")
    pooled = named.join(scratch.write(pools(groups), "pools"), ["lang", "source"], "left")
    vectors = pooled.select("doc_id", "base_failed", "pool", "into", *(f().alias(f"x{i}") for i, (f, _) in enumerate(FEATURES.values())),
                            *(c for c in counted.columns if c.startswith("n_") or c == "word_chars"))
    rows = vectors.where("NOT base_failed").select(F.explode("into").alias("pool"), *(f"x{i}" for i in range(D)))
    now = scratch.write(first_estimate(rows), "estimate-0")
    for step in range(1, STEPS + 1):
        far = distances(rows, now)
        half = scratch.write(binned_quantile(far, ["pool"], "bin", 0.5), f"half-{step}")
        near = far.join(half, "pool").where("bin < edge")
        now = scratch.write(estimate(near), f"estimate-{step}")
    middle = binned_quantile(distances(rows, now), ["pool"], "bin", 0.5)
    now = scratch.write(now.join(middle.select("pool", F.greatest(bin_edge("edge") / CHI2_MEDIAN, F.lit(0.5)).alias("factor")), "pool"), "estimate")
    final = vectors.join(now, "pool", "left").withColumn("distance", distance() / F.col("factor"))
    outlier = F.coalesce(F.col("distance") > CUT, F.lit(False))
    return final.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        (~F.col("base_failed") & ~outlier).alias("kept"), "distance")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
