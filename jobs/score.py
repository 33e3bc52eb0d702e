"""Batch job: load a saved model and score a feature frame.

    spark-submit jobs/score.py --model <folder written by train.py> --frame <parquet frame> --output <folder> [--kind gbm|glm|rf]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from cartwise.models import boost  # noqa: E402
from cartwise.models import fit as M  # noqa: E402


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--model", required=True)
    ap.add_argument("--frame", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--kind", default="gbm", choices=["gbm", "glm", "rf"])
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("cartwise-score").getOrCreate()
    model = {"gbm": lambda: boost.load(spark, args.model), "glm": lambda: LogisticRegressionModel.load(args.model),
             "rf": lambda: RandomForestClassificationModel.load(args.model)}[args.kind]()
    M.score(model, M.vectorize(spark.read.parquet(args.frame), label=None)).write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
