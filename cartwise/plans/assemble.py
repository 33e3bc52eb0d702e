"""Labelled training frame and candidate (test) frame.

Both frames carry the same 36 feature columns in one canonical order,
selected by name (never by position):

    user_id, product_id, [reordered], 2 time, 8 user, 21 product, 3 user×product

Join plan of the training frame: the line facts carry each order's day and
hour, so the time totals (key domains of 7 and 24 values) are small sides that
the planner broadcasts. User and product features are attached to the user×product frame, so
the line-sized frame meets them in one join and is shuffled once, on (user_id,
product_id), a key that no hot product or hot user fills alone. Every feature side is unique on its
key, so no join multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.session import materialize as write_table
from cartwise.plans.base import FeatureInput, split_inputs
from cartwise.plans.product import PRODUCT_FEATURES, product_features
from cartwise.plans.time import orders_per_dow, orders_per_hour, time_features, time_mean_constants
from cartwise.plans.user import FIXTURE_KEYWORDS, USER_FEATURES, user_features
from cartwise.plans.user_product import UP_FEATURES, user_product_features

TIME_FEATURES = ("total_ord_count_p_dow", "total_ord_count_p_ohod")
FEATURES = (*TIME_FEATURES, *USER_FEATURES, *PRODUCT_FEATURES, *UP_FEATURES)
KEYS = ("user_id", "product_id")
LABEL = "reordered"
TRAIN_COLUMNS = (*KEYS, LABEL, *FEATURES)
TEST_COLUMNS = (*KEYS, *FEATURES)


class FeatureSet:
    """The four feature frames of one input, each built once.

    With ``materialize=True`` (default) the shared line facts are written
    once and so are the product features (one row per product) and the calendar totals; the
    planner chooses their joins by the size of the files. (Totals that are not written have no
    measured size yet when the line-sized side of their join is shuffled.)
    """

    def __init__(self, fi: FeatureInput, keywords: tuple[str, ...] = FIXTURE_KEYWORDS,
                 faithful_streaks: bool = True, materialize: bool = True):
        self.fi = fi.materialize() if materialize else fi
        self.user = user_features(self.fi, keywords)
        self.product = product_features(self.fi, faithful_streaks)
        self.user_product = user_product_features(self.fi)
        self.time = time_features(self.fi.orders)
        self.dow, self.hour = orders_per_dow(self.fi.orders), orders_per_hour(self.fi.orders)
        self.product_side = self.product
        if materialize:
            self.dow, self.hour = write_table(self.dow, "orders-per-dow"), write_table(self.hour, "orders-per-hour")
            self.product = write_table(self.product, "product-features")
            self.product_side = self.product  # read from files: the planner knows its size


def check_columns(user: DataFrame, product: DataFrame, user_product: DataFrame, test_set: DataFrame) -> None:
    """Raise unless every input of the candidate frame has its key columns."""
    wanted = {"user": (user, KEYS[:1]), "product": (product, KEYS[1:]), "user_product": (user_product, KEYS), "test_set": (test_set, KEYS)}
    lacking = [f"{name}: {', '.join(sorted(absent))}" for name, (df, keys) in wanted.items() if (absent := set(keys) - set(df.columns))]
    if lacking:
        raise ValueError("candidate frame inputs lack key columns (" + "; ".join(lacking) + ")")


def train_frame_from(fs: FeatureSet) -> DataFrame:
    """Every feature line with its label (analysed behaviour: features and
    labels come from the same lines).

    Every line's (user, product) is a row of the user×product frame, so the product
    features travel with that frame too and the lines are shuffled once. Lines
    without a user keep their product's features alone, those without a product none.
    """
    f = fs.fi.facts
    own = [F.when(F.col("user_id").isNotNull(), F.col(c)).alias(c) for c in UP_FEATURES]
    sides = (fs.user_product.select(*KEYS, *own).join(fs.user, "user_id", "left").join(fs.product_side, "product_id", "left")
             .withColumnsRenamed({"user_id": "_user", "product_id": "_product"}))
    frame = (f.select(*KEYS, "order_dow", "order_hour_of_day", LABEL)
             .join(fs.dow, "order_dow", "left")
             .join(fs.hour, "order_hour_of_day", "left")
             .withColumns({c: F.col(c).cast("double") for c in TIME_FEATURES})
             .join(sides, F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("product_id") == F.col("_product")), "left"))
    return frame.select(*TRAIN_COLUMNS)


def train_frame(orders: DataFrame, lines: DataFrame, products: DataFrame, leak_free: bool = False,
                keywords: tuple[str, ...] = FIXTURE_KEYWORDS, line_facts: DataFrame | None = None,
                fs: FeatureSet | None = None) -> DataFrame:
    """Labelled frame; ``fs`` reuses a feature set built with the same ``leak_free``."""
    fs = fs or FeatureSet(split_inputs(orders, lines, products, leak_free=leak_free, line_facts=line_facts), keywords)
    if not leak_free:
        return train_frame_from(fs)
    targets = orders.where(F.col("eval_set") == "train").select("order_id", "user_id", "order_dow",
                                                                "order_hour_of_day")
    if line_facts is not None:  # a partition filter: the lines carry their user
        hits = line_facts.where(F.col("eval_set") == "train").select(*KEYS)
    else:
        hits = lines.select("order_id", "product_id").join(targets.select("order_id", "user_id"), "order_id").select(*KEYS)
    labels = hits.withColumn("_hit", F.lit(1))
    cands = fs.user_product.join(targets.select("user_id"), "user_id", "left_semi")
    framed = (cands.join(labels, list(KEYS), "left")
              .withColumn(LABEL, F.coalesce(F.col("_hit"), F.lit(0)).cast("int")).drop("_hit"))
    return _attach_target_time(framed, targets, fs).select(*TRAIN_COLUMNS)


def _attach_target_time(frame: DataFrame, targets: DataFrame, fs: FeatureSet) -> DataFrame:
    """Leak-free time features: totals of the target order's dow / hour over history orders."""
    t = (targets.select("user_id", "order_dow", "order_hour_of_day")
         .join(fs.dow, "order_dow", "left")
         .join(fs.hour, "order_hour_of_day", "left")
         .select("user_id", *[F.col(c).cast("double").alias(c) for c in TIME_FEATURES]))
    return (frame.join(t, "user_id", "left").join(fs.user, "user_id", "inner")
            .join(fs.product_side, "product_id", "inner"))


def prior_pairs(orders: DataFrame, lines: DataFrame, line_facts: DataFrame | None = None) -> DataFrame:
    """(user, product) of prior lines: a partition filter on stored line facts, else a join with the orders."""
    if line_facts is not None:
        return line_facts.where(F.col("eval_set") == "prior").select(*KEYS)
    prior = orders.where(F.col("eval_set") == "prior").select("order_id", "user_id")
    return lines.join(prior, "order_id").select(*KEYS)


def candidates(orders: DataFrame, lines: DataFrame, line_facts: DataFrame | None = None) -> DataFrame:
    """Distinct (user, product) bought in the earlier orders of test users.

    The (user, product) pairs of prior lines, of users that have a test order;
    null products are no candidates.
    """
    test_users = orders.where(F.col("eval_set") == "test").select("user_id")
    pairs = prior_pairs(orders, lines, line_facts).where(F.col("product_id").isNotNull()).distinct()
    return pairs.join(test_users, "user_id", "left_semi")


def test_frame_from(fs: FeatureSet, test_set: DataFrame, constants: DataFrame | None = None) -> DataFrame:
    """Candidates ⋈ user ⋈ product ⋈ user×product features (inner joins) with
    the time features set to their means over the day / hour groups."""
    check_columns(fs.user, fs.product, fs.user_product, test_set)
    consts = constants if constants is not None else time_mean_constants(fs.fi.orders)
    frame = (test_set.select(*KEYS).join(fs.user, "user_id", "inner")
             .join(fs.product_side, "product_id", "inner")
             .join(fs.user_product, list(KEYS), "inner")
             .withColumns({
                 "total_ord_count_p_dow": consts.select("time_mean_dow_count").scalar(),
                 "total_ord_count_p_ohod": consts.select("time_mean_ohod_count").scalar()}))
    return frame.select(*TEST_COLUMNS)


def test_frame(orders: DataFrame, lines: DataFrame, products: DataFrame, leak_free: bool = False,
               keywords: tuple[str, ...] = FIXTURE_KEYWORDS, fs: FeatureSet | None = None,
               line_facts: DataFrame | None = None) -> DataFrame:
    """Candidate frame; ``fs`` reuses a feature set built with the same ``leak_free``."""
    fs = fs or FeatureSet(split_inputs(orders, lines, products, leak_free=leak_free, line_facts=line_facts), keywords)
    if not leak_free:
        # Candidates are the pairs of test users' prior lines. A user may have a train
        # order besides: pairs seen only there are no candidates.
        test_users = orders.where(F.col("eval_set") == "test").select("user_id")
        pairs = prior_pairs(orders, lines, line_facts)
        cands = (fs.user_product.join(test_users, "user_id", "left_semi").join(pairs, list(KEYS), "left_semi"))
        consts = time_mean_constants(fs.fi.orders)
        frame = (cands.join(fs.user, "user_id", "inner").join(fs.product_side, "product_id", "inner")
                 .withColumns({
                     "total_ord_count_p_dow": consts.select("time_mean_dow_count").scalar(),
                     "total_ord_count_p_ohod": consts.select("time_mean_ohod_count").scalar()}))
        return frame.select(*TEST_COLUMNS)
    targets = orders.where(F.col("eval_set") == "test").select("order_id", "user_id", "order_dow",
                                                               "order_hour_of_day")
    cands = fs.user_product.join(targets.select("user_id"), "user_id", "left_semi")
    return _attach_target_time(cands, targets, fs).select(*TEST_COLUMNS)
