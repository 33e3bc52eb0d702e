"""Batch job: basket tables → training frame and candidate frame (parquet).

    spark-submit jobs/build_dataset.py --input <folder> --output <folder> [--leak-free]
        [--format star|csv|parquet] [--keywords organic,asian,"gluten free"]

``csv`` and ``parquet`` read the four retail tables (orders, order_products__prior,
order_products__train, products); ``star`` adapts the star-schema test tables.

Frames are written in parallel, partitioned output, column names in the
files (no positional side files, no single-task write).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from cartwise.plans import assemble  # noqa: E402
from cartwise.plans.base import split_inputs  # noqa: E402
from cartwise.plans.user import REFERENCE_KEYWORDS  # noqa: E402
from cartwise.session import ensure_checkpoint_dir  # noqa: E402
from cartwise.sources.retail import lines_without_order, load_retail, rejected  # noqa: E402
from cartwise.sources.views import dropped_rows, load_basket  # noqa: E402


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--input", required=True, help="folder with the source parquet tables")
    ap.add_argument("--output", required=True)
    ap.add_argument("--format", default="star", choices=["star", "csv", "parquet"])
    ap.add_argument("--keywords", default=",".join(REFERENCE_KEYWORDS), help="comma-separated words of the product-type flag")
    ap.add_argument("--leak-free", action="store_true", help="features from prior orders only")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("cartwise-build-dataset").getOrCreate()
    ensure_checkpoint_dir(spark)
    b = load_basket(spark, args.input, materialize=True) if args.format == "star" else load_retail(spark, args.input, args.format)
    dropped = dropped_rows(spark, args.input) if args.format == "star" else lines_without_order(b)
    dropped.write.mode("overwrite").json(os.path.join(args.output, "dropped_lines"))
    if args.format == "csv":
        rejected(spark, args.input).write.mode("overwrite").json(os.path.join(args.output, "rejected_cells"))
    leak_free = args.leak_free
    words = tuple(w.strip().lower() for w in args.keywords.split(",") if w.strip())
    if leak_free:
        train = assemble.train_frame(b.orders, b.lines, b.products, leak_free=True, line_facts=b.line_facts, keywords=words)
        test = assemble.test_frame(b.orders, b.lines, b.products, leak_free=True, line_facts=b.line_facts, keywords=words)
    else:
        fs = assemble.FeatureSet(split_inputs(b.orders, b.lines, b.products, line_facts=b.line_facts), words)
        train = assemble.train_frame_from(fs)
        test = assemble.test_frame(b.orders, b.lines, b.products, fs=fs, line_facts=b.line_facts)
    train.write.mode("overwrite").parquet(os.path.join(args.output, "train_frame"))
    test.write.mode("overwrite").parquet(os.path.join(args.output, "test_frame"))


if __name__ == "__main__":
    main()
