"""Source and sink queries: basket scans and CSV / fold round trips."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartwise.functions.scalar import round_doubles
from cartwise.plans import user
from cartwise.plans.base import split_inputs
from cartwise.registry.base import basket, register
from cartwise.registry.sqlfrag import USER_COLS, compose, r6
from cartwise.sources import csv_io

_V = ("orders_v", "order_products_v", "products_v")

ORDER_TYPES = {"order_id": "long", "user_id": "long", "order_number": "int", "order_dow": "int",
               "order_hour_of_day": "int", "days_since_prior_order": "double"}


@register("scan_orders", compose("SELECT * FROM orders_v", views=_V))
def q_scan_orders(spark, sf_dir):
    return basket(spark, sf_dir).orders


@register("scan_order_products", compose("""
SELECT l.*, o.eval_set FROM order_products_v l JOIN orders_v o ON l.order_id = o.order_id
WHERE o.eval_set IN ('prior', 'train')""", views=_V))
def q_scan_order_products(spark, sf_dir):
    b = basket(spark, sf_dir)
    return b.line_facts.where(F.col("eval_set").isin("prior", "train")).select(*b.lines.columns, "eval_set")


@register("scan_products", compose("SELECT * FROM products_v", views=_V))
def q_scan_products(spark, sf_dir):
    return basket(spark, sf_dir).products


@register("scan_departments", compose("SELECT * FROM departments_v", views=("departments_v",)))
def q_scan_departments(spark, sf_dir):
    return basket(spark, sf_dir).departments


@register("scan_aisles", compose("SELECT * FROM aisles_v", views=("aisles_v",)))
def q_scan_aisles(spark, sf_dir):
    return basket(spark, sf_dir).aisles


@register("scan_csv_untyped", compose("SELECT * FROM orders_v", views=_V))
def q_scan_csv_untyped(spark, sf_dir):
    """Orders written as a header CSV, read back as strings and bulk-cast."""
    path = csv_io.new_scratch(spark, "orders-csv")
    csv_io.write_header_csv(basket(spark, sf_dir).orders, path)
    return csv_io.scan_csv_untyped(spark, path, ORDER_TYPES)


_SPOILED = compose("""
, good AS (SELECT * FROM orders_v WHERE order_hour_of_day <> 23),
r AS (SELECT 'order_number' AS column_name, 'out of range' AS reason FROM good WHERE order_number * 16 > 127
      UNION ALL SELECT 'order_dow', 'not a number' FROM good WHERE order_dow = 0
      UNION ALL SELECT 'order_hour_of_day', 'not an integer' FROM good WHERE order_hour_of_day = 12
      UNION ALL SELECT '(line)', 'number of fields' FROM orders_v WHERE order_hour_of_day = 23)
SELECT column_name, reason, count(*) AS n_rejected FROM r GROUP BY 1, 2
UNION ALL SELECT '(rows)', 'read', count(*) FROM good""", views=("orders_v",))


@register("scan_csv_rejects", _SPOILED)
def q_scan_csv_rejects(spark, sf_dir):
    """Orders as text lines with cells of the wrong kind and lines with a field too many: what is read and what is rejected."""
    cells = {
        "order_id": F.col("order_id"), "user_id": F.col("user_id"), "order_number": F.col("order_number") * 16,
        "order_dow": F.when(F.col("order_dow") == 0, "sunday").otherwise(F.col("order_dow").cast("string")),
        "order_hour_of_day": F.concat(F.col("order_hour_of_day").cast("string"), F.when(F.col("order_hour_of_day") == 12, ".5").otherwise("")),
        "days_since_prior_order": F.coalesce(F.col("days_since_prior_order").cast("string"), F.lit(""))}
    line = F.concat_ws(",", *[c.cast("string") for c in cells.values()], F.when(F.col("order_hour_of_day") == 23, "late"))
    path = csv_io.new_scratch(spark, "orders-spoiled")
    basket(spark, sf_dir).orders.select(line.alias("value")).write.text(path)
    rows, rejects = csv_io.scan_csv_checked(spark, path, ORDER_TYPES | {"order_number": "tinyint"}, names=list(cells))
    read = rows.agg(F.count("*").alias("n_rejected")).select(F.lit("(rows)").alias("column_name"), F.lit("read").alias("reason"), "n_rejected")
    counts = csv_io.reject_counts(rejects).select(F.coalesce("column", F.lit("(line)")).alias("column_name"), "reason", "n_rejected")
    return counts.unionByName(read)


def _user_features_roundtrip(spark, sf_dir):
    b = basket(spark, sf_dir)
    uf = user.user_features(split_inputs(b.orders, b.lines, b.products, line_facts=b.line_facts))
    path = csv_io.new_scratch(spark, "user-features")
    data, names = csv_io.sink_feature_csv(uf, path)
    return data, names


@register("sink_feature_csv", compose(f"SELECT user_id, {r6(USER_COLS)} FROM uf", "uf"))
def q_sink_feature_csv(spark, sf_dir):
    """User features written as headerless CSV + manifest, read back with the manifest."""
    data, names = _user_features_roundtrip(spark, sf_dir)
    df = csv_io.scan_with_manifest(spark, data, names, types={"user_id": "long"})
    return round_doubles(df)


@register("scan_with_manifest", compose(f"SELECT user_id, {r6(USER_COLS)} FROM uf", "uf"))
def q_scan_with_manifest(spark, sf_dir):
    data, names = _user_features_roundtrip(spark, sf_dir)
    return round_doubles(csv_io.scan_with_manifest(spark, data, names, types={"user_id": "long"}))


@register("scan_as_factor", compose("""
SELECT user_id, CAST(max_count_of_products AS INTEGER) AS label, round(mean_count_of_products, 6) AS mean_count_of_products
FROM uf""", "uf"))
def q_scan_as_factor(spark, sf_dir):
    """Manifest read with one column taken as an integer category label."""
    data, names = _user_features_roundtrip(spark, sf_dir)
    df = csv_io.scan_with_manifest(spark, data, names, types={"user_id": "long"})
    return round_doubles(df.select("user_id", F.col("max_count_of_products").cast("int").alias("label"),
                                   "mean_count_of_products"))


_LABEL = "count_ord_no_prev_purchased_items"


@register("scan_labelled_matrix")
def q_scan_labelled_matrix(spark, sf_dir):
    """Manifest CSV → (features vector, label) with the label found by name."""
    data, names = _user_features_roundtrip(spark, sf_dir)
    df = csv_io.scan_with_manifest(spark, data, names, types={"user_id": "long"})
    cols = csv_io.read_manifest(spark, names)
    feats = [c for c in cols if c not in ("user_id", _LABEL)]
    out = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep").transform(df)
    return out.select("user_id", F.col(_LABEL).alias("label"),
                      F.lit(csv_io.label_index(cols, _LABEL)).alias("label_index"), "features")


_MATRIX = [c for c in USER_COLS if c != _LABEL]


@register("scan_labelled_matrix_cells", compose(" UNION ALL ".join(
    f"SELECT user_id, round({_LABEL}, 6) AS label, {1 + USER_COLS.index(_LABEL)} AS label_index, {i} AS position, "
    f"round({c}, 6) AS value FROM uf" for i, c in enumerate(_MATRIX)), "uf"))
def q_scan_labelled_matrix_cells(spark, sf_dir):
    """The labelled matrix, one row a vector entry: label and layout as other engines see them."""
    out = q_scan_labelled_matrix(spark, sf_dir)
    return round_doubles(out.select("user_id", "label", "label_index", F.posexplode(vector_to_array("features")).alias("position", "value")))


@register("scan_folds", compose("""
SELECT l.*, o.user_id, CAST(CAST(('0x' || substr(md5(CAST(o.user_id AS VARCHAR)), 1, 13)) AS BIGINT) % 3 AS INTEGER) AS fold
FROM order_products_v l JOIN orders_v o ON l.order_id = o.order_id""", views=_V))
def q_scan_folds(spark, sf_dir):
    """Lines split into 3 fold files by a hash of user_id and read back as one set."""
    b = basket(spark, sf_dir)
    path = csv_io.new_scratch(spark, "folds")
    csv_io.write_folds(b.line_facts.select(*b.lines.columns, "user_id"), path, key="user_id", folds=3)
    return csv_io.scan_folds(spark, path)
