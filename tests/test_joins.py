"""The pair-free co-occurrence count equals the self-join, duplicates included."""

import random

from conftest import make_lines
from pyspark.sql import functions as F

from cartwise.operators import joins


def test_cooccurrence_equals_self_join(spark):
    rnd = random.Random(3)
    rows = []
    for o in range(40):
        for _ in range(rnd.randint(1, 6)):
            rows.append((o, rnd.randint(1, 8), 1, 0))  # repeats of a product in an order allowed
    lines = make_lines(spark, rows)
    a, b = lines.alias("a"), lines.alias("b")
    pairs = (a.join(b, (F.col("a.order_id") == F.col("b.order_id")) & (F.col("a.product_id") != F.col("b.product_id")),
                    "left")
             .groupBy("a.order_id", "a.product_id").agg(F.count("b.product_id").alias("n")))
    expect = {(r[0], r[1]): r[2] for r in pairs.collect()}
    got = {(r.order_id, r.product_id): r.n_co_occurring for r in joins.cooccurrence_counts(lines).collect()}
    assert got == expect
