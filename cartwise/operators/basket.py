"""Per-user basket choice that maximises the expected F1 score.

Given item probabilities p_1 >= ... >= p_n of one user (independent items),
predicting the top k items gives, with K = hits among the top k and R = hits
among the rest,

    without "None":  E[F1] = E[ 2K / (k + K + R) ]
    with "None":     E[F1] = E[ 2K / (k + 1 + K + R) ] + 2 * P(no item) / (k + 2)

K and R are Poisson-binomial. Up to ``TREE_ABOVE`` candidates all 2(n+1)
expectations come from an O(n^2) dynamic program: the distribution of K for
every prefix (forward) and E[1 / (c + R)] for every suffix (backward). Above
it they come from divide and conquer over the cut-off k in O(n log^2 n)
(``_expected_f1_tree``). The best (k, None) is the argmax; ties (values within
``TIE``, so that the order of summation decides nothing) go to "with None",
then to the smaller k.

Spark side: rows are shuffled by user into an explicit number of
partitions, sorted by (user, probability), and streamed through
``mapInPandas`` (Arrow batches holding many users); each user's candidates
go to the NumPy solver. A user's candidate list has one row per product the
user bought, so it is bounded by the product dimension, not by the data
volume; no candidate is dropped. The solver's memory is O(n^2) only up to
``DENSE_MAX_CANDIDATES`` and O(n log n) above it; small users (up to
``VECTOR_MAX_CANDIDATES``) are solved for all k in whole-array operations.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The solver runs in Python workers: ship this module's functions by value so
# workers need only NumPy and pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Solver tiers by a user's candidate count n (measured on this machine):
# up to VECTOR_MAX all k are summed at once over whole tables (about 2x faster
# for 20-200 candidates, slower above ~500); up to DENSE_MAX one k at a time
# over the (n+1)^2 prefix table (8 MB at 1024); above it divide and conquer.
# (With a larger ``tree_above`` the prefix distributions are recomputed per
# block from sqrt(n) checkpoints: the O(n^2) form without an O(n^2) table.)
VECTOR_MAX_CANDIDATES = 256
DENSE_MAX_CANDIDATES = 1024
TREE_ABOVE = DENSE_MAX_CANDIDATES
#: Expected scores closer than this count as equal.
TIE = 1e-12
#: Weights of up to this many numbers are applied by shifted sums, longer ones by FFT.
_SHIFT_MAX = 33


def _step(col: np.ndarray, q: float) -> np.ndarray:
    """Distribution of hits after one more item with probability ``q``."""
    nxt = np.zeros(col.shape[0] + 1)
    nxt[:-1] = col * (1.0 - q)
    nxt[1:] += col * q
    return nxt


def _prefix_hits_desc(p: np.ndarray, dense_max: int):
    """Yield (k, P(exactly i hits among the first k items) for i = 0..k), k = n..0.

    Small n: one (n+1) x (n+1) table. Large n: the forward pass keeps only
    every ``step``-th distribution (step ~ sqrt(n)), and each block is
    recomputed from its checkpoint when the descending loop reaches it, so
    memory is O(n sqrt(n)) instead of O(n^2) at twice the forward work.
    Both paths do the same floating-point operations.
    """
    n = p.shape[0]
    if n <= dense_max:
        hits = np.zeros((n + 1, n + 1))
        hits[0, 0] = 1.0
        for j in range(1, n + 1):
            q = p[j - 1]
            hits[:, j] = hits[:, j - 1] * (1.0 - q)
            hits[1:, j] += hits[:-1, j - 1] * q
        for k in range(n, -1, -1):
            yield k, hits[: k + 1, k]
        return
    step = int(np.ceil(np.sqrt(n + 1)))
    marks = {}
    col = np.ones(1)
    for j in range(n + 1):
        if j % step == 0:
            marks[j] = col
        if j < n:
            col = _step(col, p[j])
    for start in sorted(marks, reverse=True):
        block = [marks[start]]
        for j in range(start, min(start + step - 1, n)):
            block.append(_step(block[-1], p[j]))
        for k in range(start + len(block) - 1, start - 1, -1):
            yield k, block[k - start]


def _expected_f1_dense(p: np.ndarray, p_none: float) -> tuple[np.ndarray, np.ndarray]:
    """Small n: the prefix table and the suffix tables E[1 / (c + R)] are held
    whole ((n+1)^2 and 2 (n+1)(2n+2) doubles) and all k are summed at once."""
    n = p.shape[0]
    hits = np.zeros((n + 1, n + 1))  # hits[i, k] = P(i hits among the first k items)
    hits[0, 0] = 1.0
    for j in range(1, n + 1):
        q = p[j - 1]
        hits[:, j] = hits[:, j - 1] * (1.0 - q)
        hits[1:, j] += hits[:-1, j - 1] * q
    m = 2 * n + 2
    c = np.arange(m, dtype=np.float64)
    # inv[k, 0, c] = E[1 / (c + R_k)], inv[k, 1, c] = E[1 / (c + 1 + R_k)], R_k over the items after k
    inv = np.empty((n + 1, 2, m))
    inv[n, 0, 0] = 0.0
    inv[n, 0, 1:] = 1.0 / c[1:]
    inv[n, 1] = 1.0 / (c + 1.0)
    for k in range(n, 0, -1):
        q = p[k - 1]  # item k leaves the prediction and joins the rest
        inv[k - 1, :, :-1] = (1.0 - q) * inv[k, :, :-1] + q * inv[k, :, 1:]
        inv[k - 1, :, -1] = inv[k, :, -1]
    ks = np.arange(n + 1)
    w = 2.0 * ks[None, :] * hits.T  # w[k, i] = 2 i P(K_k = i), zero for i > k
    idx = ks[:, None] + ks[None, :]  # c = k + i <= 2n
    without = (w * np.take_along_axis(inv[:, 0, :], idx, axis=1)).sum(axis=1)
    with_none = (w * np.take_along_axis(inv[:, 1, :], idx, axis=1)).sum(axis=1) + 2.0 * p_none / (ks + 2.0)
    return with_none, without


def _hit_tree(p: np.ndarray) -> list[np.ndarray]:
    """Distributions of the hits in every block of 1, 2, 4, ... items: ``tree[l][b, i]`` = P(i hits in block b)."""
    tree = [np.stack([1.0 - p, p], axis=1)]
    while len(tree[-1]) > 1:
        left, right = tree[-1][0::2], tree[-1][1::2]
        h = left.shape[1] - 1
        if h + 1 <= _SHIFT_MAX:
            both = np.zeros((len(left), 2 * h + 1))
            for r in range(h + 1):
                both[:, r:r + h + 1] += left[:, r:r + 1] * right
        else:
            n = 4 * h
            both = np.fft.irfft(np.fft.rfft(left, n) * np.fft.rfft(right, n), n)[:, :2 * h + 1]
            np.maximum(both, 0.0, out=both)
        tree.append(both)
    return tree


def _after_hits(x: np.ndarray, w: np.ndarray, first: int, size: int) -> np.ndarray:
    """sum_r w[b, r] * x[..., b, c + r] for c = first .. first + size - 1 (every c + r is inside x)."""
    m = w.shape[1]
    if m <= _SHIFT_MAX:
        out = np.zeros((*x.shape[:-1], size))
        for r in range(m):
            out += w[:, r:r + 1] * x[..., first + r:first + r + size]
        return out
    n = x.shape[-1]  # a power of two; what wraps around lies beyond the c that are taken
    return np.fft.irfft(np.fft.rfft(x, n) * np.conj(np.fft.rfft(w, n)), n)[..., first:first + size]


def _expected_f1_tree(p: np.ndarray, p_none: float) -> tuple[np.ndarray, np.ndarray]:
    """All k at once, by halving the range of k.

    A node is a block [a, a + s) of items and the cut-offs k inside it. Items before
    the block are predicted for all those k, items behind it never; with X and Y their
    hits, the node holds u(c) = E[1 / (c + X + Y)] and v(c) = E[X / (c + X + Y)] for
    the 2s values c = a .. a + 2s - 1, all that its cut-offs can ask for. The left half
    adds the right half's hits to Y, the right half adds the left half's hits r to X,
    which also turns X into X + r; both are correlations with a block's distribution
    of hits. At one item E[F1](k = a) = 2 v(a) once the item itself joins Y. Every
    level costs one set of FFTs over 2n numbers, all blocks of a level in one call.
    """
    n = p.shape[0]
    size = 1 << n.bit_length()  # more than n items, so that k = n has a block; the added ones never hit
    padded = np.zeros(size)
    padded[:n] = p
    tree = _hit_tree(padded)
    c = np.arange(2 * size, dtype=np.float64)
    u = np.empty((2, 1, 2 * size))  # with None (every denominator one larger), without
    u[0, 0] = 1.0 / (c + 1.0)
    u[1, 0, 0] = 0.0  # nothing predicted and nothing hit scores 0
    u[1, 0, 1:] = 1.0 / c[1:]
    v = np.zeros_like(u)
    s = size
    for hits in reversed(tree[:-1]):
        h = s // 2
        left, right = hits[0::2], hits[1::2]
        moved = left * np.arange(h + 1)
        half_u = np.stack([_after_hits(u, right, 0, s), _after_hits(u, left, h, s)], axis=2)
        half_v = np.stack([_after_hits(v, right, 0, s),
                           _after_hits(v, left, h, s) + _after_hits(u, moved, h, s)], axis=2)
        u, v = (x.reshape(2, -1, s) for x in (half_u, half_v))
        s = h
    both = 2.0 * ((1.0 - padded) * v[:, :, 0] + padded * v[:, :, 1])[:, :n + 1]
    return both[0] + 2.0 * p_none / (np.arange(n + 1) + 2.0), both[1]


def expected_f1(p: np.ndarray, p_none: float | None = None, dense_max: int = DENSE_MAX_CANDIDATES,
                vector_max: int = VECTOR_MAX_CANDIDATES, tree_above: int = TREE_ABOVE) -> tuple[np.ndarray, np.ndarray]:
    """(E_with_none[k], E_without_none[k]) for k = 0..n; ``p`` sorted descending."""
    p = np.asarray(p, dtype=np.float64)
    n = p.shape[0]
    if p_none is None:
        p_none = float(np.prod(1.0 - p))
    if n <= vector_max:
        return _expected_f1_dense(p, p_none)
    if n > max(dense_max, tree_above):
        return _expected_f1_tree(p, p_none)
    # inv[c] = E[1 / (c + R)], inv_none[c] = E[1 / (c + 1 + R)], R over the items after k
    c = np.arange(2 * n + 2, dtype=np.float64)
    inv = np.zeros_like(c)
    inv[1:] = 1.0 / c[1:]
    inv_none = 1.0 / (c + 1.0)
    with_none = np.zeros(n + 1)
    without = np.zeros(n + 1)
    for k, hits_k in _prefix_hits_desc(p, dense_max):
        k1 = np.arange(k + 1)
        w = 2.0 * k1 * hits_k
        without[k] = float(np.dot(w, inv[k + k1]))
        with_none[k] = float(np.dot(w, inv_none[k + k1])) + 2.0 * p_none / (k + 2.0)
        if k > 0:
            q = p[k - 1]  # item k leaves the prediction and joins the rest
            inv[:-1] = (1.0 - q) * inv[:-1] + q * inv[1:]
            inv_none[:-1] = (1.0 - q) * inv_none[:-1] + q * inv_none[1:]
    return with_none, without


def best_basket(p: np.ndarray, p_none: float | None = None) -> tuple[int, bool, float]:
    """(best_k, predict_none, max_expected_f1); ties → with None, then smaller k."""
    with_none, without = expected_f1(p, p_none)
    both = np.concatenate([with_none, without])
    ix = int(np.argmax(both >= both.max() - TIE))
    n1 = with_none.shape[0]
    return (ix if ix < n1 else ix - n1), ix < n1, float(both[ix])


# ---------------------------------------------------------------- Spark jobs
SELECT_SCHEMA = "user_id long, best_k int, pred_none boolean, max_f1 double, n_candidates int, products array<long>"
CURVE_SCHEMA = "user_id long, k int, with_none boolean, expected_f1 double"


def _per_user_stream(scored: DataFrame, solve, schema: str, prob: str, user: str, item: str,
                     partitions: int | None = None, p_none: str | None = None) -> DataFrame:
    """Run ``solve(users, probs, items)`` over every user's candidates.

    Rows are hash-partitioned by user into an explicit number of partitions
    (the session's shuffle partitions: AQE does not coalesce an explicit
    repartition, so the Python work stays parallel) and sorted by (user,
    probability desc, item). Each task streams its Arrow batches; users
    arrive contiguous and already ordered, a user cut by a batch boundary is
    carried into the next batch, so many users share one Python call and a
    task never holds more than a batch plus one user.
    """
    spark = scored.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = [F.col(p_none).cast("double").alias("p_none")] if p_none else []
    src = (scored.select(F.col(user).cast("long").alias("user_id"), F.col(item).cast("long").alias("item"),
                         F.col(prob).cast("double").alias("p"), *given)
           .repartition(n, "user_id")
           .sortWithinPartitions("user_id", F.desc("p"), "item"))

    def run(batches):
        # rows of the user the previous batch ended with, one chunk per batch:
        # a user spread over many batches is concatenated once, not per batch
        pending = []
        for b in batches:
            if b.empty:
                continue
            u = b["user_id"].to_numpy()
            # users are sorted ascending within the partition: rows of the last user form the tail
            cut = int(np.searchsorted(u, u[-1], side="left"))
            if cut == 0:
                if pending and pending[-1]["user_id"].iat[-1] != u[-1]:
                    yield _solve_users(pd.concat(pending, ignore_index=True), solve)
                    pending = []
                pending.append(b)
                continue
            done = pd.concat([*pending, b.iloc[:cut]], ignore_index=True) if pending else b.iloc[:cut]
            yield _solve_users(done, solve)
            pending = [b.iloc[cut:]]
        if pending:
            yield _solve_users(pd.concat(pending, ignore_index=True), solve)

    return src.mapInPandas(run, schema)


def _solve_users(pdf: pd.DataFrame, solve) -> pd.DataFrame:
    u = pdf["user_id"].to_numpy()
    p = pdf["p"].to_numpy(dtype=np.float64)
    it = pdf["item"].to_numpy()
    starts = np.concatenate([[0], np.flatnonzero(u[1:] != u[:-1]) + 1, [len(u)]])
    none = pdf["p_none"].to_numpy(dtype=np.float64) if "p_none" in pdf else None
    parts = [solve(int(u[a]), p[a:b], it[a:b], None if none is None or np.isnan(none[a]) else float(none[a]))
             for a, b in zip(starts[:-1], starts[1:])]
    if parts and isinstance(parts[0], tuple):
        return pd.DataFrame.from_records(parts, columns=list(_SELECT_COLUMNS))
    return pd.concat(parts, ignore_index=True)


_SELECT_COLUMNS = ("user_id", "best_k", "pred_none", "max_f1", "n_candidates", "products")


def _unique(items: np.ndarray) -> None:
    if len(np.unique(items)) != len(items):
        raise ValueError("a user's candidates hold an item twice: aggregate to one row per (user, item) first")


def _select_one(uid: int, p: np.ndarray, items: np.ndarray, p_none: float | None = None) -> tuple:
    _unique(items)
    k, none, f1 = best_basket(p, p_none)
    return uid, k, none, f1, len(p), items[:k].astype("int64").tolist()


def _curve_one(uid: int, p: np.ndarray, items: np.ndarray, p_none: float | None = None) -> pd.DataFrame:
    _unique(items)
    with_none, without = expected_f1(p, p_none)
    n1 = with_none.shape[0]
    return pd.DataFrame({"user_id": np.full(2 * n1, uid, dtype="int64"),
                         "k": np.concatenate([np.arange(n1), np.arange(n1)]).astype("int32"),
                         "with_none": np.concatenate([np.ones(n1, bool), np.zeros(n1, bool)]),
                         "expected_f1": np.concatenate([with_none, without])})


def select(scored: DataFrame, prob: str = "p", user: str = "user_id", item: str = "product_id",
           partitions: int | None = None, p_none: str | None = None) -> DataFrame:
    """One row per user: best k, whether to add "None", its E[F1] and the chosen items
    (highest probability first, ties by item id). ``p_none`` names a column with the user's
    given probability of buying nothing (null: the product of 1 - p)."""
    return _per_user_stream(scored, _select_one, SELECT_SCHEMA, prob, user, item, partitions, p_none)


def expected_f1_curve(scored: DataFrame, prob: str = "p", user: str = "user_id",
                      item: str = "product_id", partitions: int | None = None, p_none: str | None = None) -> DataFrame:
    """Per user, one row per (k, with_none) with its expected F1."""
    return _per_user_stream(scored, _curve_one, CURVE_SCHEMA, prob, user, item, partitions, p_none)


def prob_none(scored: DataFrame, prob: str = "p", user: str = "user_id") -> DataFrame:
    """P(no item bought) = prod(1 - p) per user, as exp(sum(log1p(-p))).

    ``log1p(-1)`` is null in Spark and ``sum`` would skip it, so a user with
    any p >= 1 gets 0 explicitly.
    """
    return scored.groupBy(user).agg(
        F.when(F.max(prob) >= 1.0, F.lit(0.0))
         .otherwise(F.exp(F.sum(F.log1p(-F.col(prob))))).alias("p_none"))


def set_counts(predicted: DataFrame, truth: DataFrame, user: str = "user_id", item: str = "product_id") -> DataFrame:
    """Per user tp / fp / fn of a predicted item set against a true item set.

    Union of both sets tagged by origin, one aggregate per (user, item) and
    one per user: no full outer join, skew handled by partial aggregation.
    """
    tagged = (predicted.select(user, item, F.lit(1).alias("is_pred"), F.lit(0).alias("is_true"))
              .unionByName(truth.select(user, item, F.lit(0).alias("is_pred"), F.lit(1).alias("is_true"))))
    per_item = tagged.groupBy(user, item).agg(F.max("is_pred").alias("pr"), F.max("is_true").alias("tr"))
    return per_item.groupBy(user).agg(
        F.sum(F.col("pr") * F.col("tr")).alias("tp"),
        F.sum(F.col("pr") * (1 - F.col("tr"))).alias("fp"),
        F.sum((1 - F.col("pr")) * F.col("tr")).alias("fn"))


def f_scores(counts: DataFrame, betas: tuple[float, ...] = (1.0, 2.0)) -> DataFrame:
    """F1 / F-beta columns from tp, fp, fn (null when undefined)."""
    cols = {}
    for b in betas:
        b2 = b * b
        name = "f1" if b == 1.0 else f"f{b:g}".replace(".", "_")
        num = (1.0 + b2) * F.col("tp")
        cols[name] = F.try_divide(num.cast("double"), (num + F.col("fp") + b2 * F.col("fn")).cast("double"))
    return counts.withColumns(cols)
