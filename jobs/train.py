"""Batch job: fit a model on a training frame, score the candidate frame,
choose baskets and write metrics.

    spark-submit jobs/train.py --frames <folder from build_dataset> --output <folder> [--kind gbm|glm|rf]
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cartwise.models import fit as M  # noqa: E402
from cartwise.operators import basket as B  # noqa: E402
from cartwise.operators import evaluate as E  # noqa: E402
from cartwise.session import ensure_checkpoint_dir, materialize  # noqa: E402


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--frames", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--kind", default="gbm", choices=["gbm", "glm", "rf"])
    ap.add_argument("--params", default="{}", help="JSON booster-style parameters")
    ap.add_argument("--rounds", type=int, default=M.ROUNDS, help="boosting rounds at most")
    ap.add_argument("--patience", type=int, default=M.PATIENCE, help="rounds without a better held-out loss that end boosting")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("cartwise-train").getOrCreate()
    ensure_checkpoint_dir(spark)
    params = json.loads(args.params)
    frame = spark.read.parquet(os.path.join(args.frames, "train_frame"))
    train = materialize(M.validation_flag(M.vectorize(frame)), "train-vectors")
    where = os.path.join(args.output, "model")
    if args.kind == "gbm":
        model = M.train_gbm(train, {"num_boost_round": args.rounds, **params}, "is_valid", args.patience)
        model.save(spark, where)
        M.loss_history(spark, model).write.mode("overwrite").json(os.path.join(args.output, "loss_history"))
    else:
        rows = train.where(~F.col("is_valid"))
        model = M.train_glm(rows, **params) if args.kind == "glm" else M.train_rf(rows, params)
        model.write().overwrite().save(where)
    # scored once, read by every metric
    valid = materialize(M.score(model, train.where(F.col("is_valid"))).withColumnRenamed("label", "reordered")
                        .withColumn("reordered", F.col("reordered").cast("int")), "valid-scores")
    metrics = E.classification_metrics(valid)
    metrics.select("*", E.auc(valid).select("auc").scalar().alias("auc")) \
        .write.mode("overwrite").json(os.path.join(args.output, "validation_metrics"))
    # a frame of lines (not leak-free) repeats a (user, product): a basket holds it once
    pairs = valid.groupBy("user_id", "product_id").agg(F.max("p").alias("p"), F.max("reordered").alias("reordered"))
    E.basket_f1(materialize(pairs, "valid-pairs")).write.mode("overwrite").json(os.path.join(args.output, "validation_basket_f1"))
    test = M.vectorize(spark.read.parquet(os.path.join(args.frames, "test_frame")), label=None)
    B.select(M.score(model, test)).write.mode("overwrite").parquet(os.path.join(args.output, "baskets"))


if __name__ == "__main__":
    main()
