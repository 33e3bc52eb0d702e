"""CSV round trips: untyped header CSV with bulk try_cast, headerless CSV + manifest."""

from cartwise.sources import csv_io


def test_untyped_csv_bad_text_is_null(spark):
    path = csv_io.new_scratch(spark, "t-untyped")
    df = spark.createDataFrame([("1", "2.5"), ("x", "3")], "a string, b string")
    csv_io.write_header_csv(df, path)
    got = csv_io.scan_csv_untyped(spark, path, {"a": "long", "b": "double"}).orderBy("b").collect()
    assert [(r.a, r.b) for r in got] == [(1, 2.5), (None, 3.0)]


def test_checked_csv_gives_back_what_it_cannot_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n,x,day,name\n1,2,0.5,2024-01-31,one\n2,oops,,2024-02-30,\n3,4\n,300,1e400,,x\n5,6.5,z,2024-01-01,y\n6,7,1,2024-01-01,y,more\n")
    rows, rejects = csv_io.scan_csv_checked(spark, str(tmp_path / "a.csv"), {"id": "long", "n": "tinyint", "x": "decimal(9,2)", "day": "date"})
    assert rows.columns == ["id", "n", "x", "day", "name"]
    got = sorted(((r.id or 0, r.n, None if r.x is None else float(r.x), str(r.day), r.name) for r in rows.collect()), key=lambda r: r[0])
    assert got == [(0, None, None, "None", "x"), (1, 2, 0.5, "2024-01-31", "one"), (2, None, None, "None", None), (5, None, None, "2024-01-01", "y")]
    assert sorted(((r.column or "", r.text, r.reason) for r in rejects.collect())) == [
        ("", "3,4", "number of fields"), ("", "6,7,1,2024-01-01,y,more", "number of fields"), ("day", "2024-02-30", "not a date"),
        ("n", "300", "out of range"), ("n", "6.5", "not an integer"), ("n", "oops", "not a number"),
        ("x", "1e400", "out of range"), ("x", "z", "not a number")]
    counts = csv_io.reject_counts(rejects)
    assert rows.count() + counts.where("column IS NULL").agg({"n_rejected": "sum"}).first()[0] == 6


def test_checked_csv_reads_what_the_unchecked_scan_reads(spark):
    path = csv_io.new_scratch(spark, "t-checked")
    csv_io.write_header_csv(spark.createDataFrame([("1", "a,b"), ("x", None)], "a string, `b.c` string"), path)
    rows, rejects = csv_io.scan_csv_checked(spark, path, {"a": "long"})
    assert sorted(map(str, rows.collect())) == sorted(map(str, csv_io.scan_csv_untyped(spark, path, {"a": "long"}).collect()))
    assert [tuple(r) for r in rejects.collect()] == [("a", "x", "not a number")]
    none = csv_io.new_scratch(spark, "t-checked-empty")
    spark.createDataFrame([], "a string").write.text(none)
    rows, rejects = csv_io.scan_csv_checked(spark, none, {"a": "long"}, names=["a", "b"])
    assert rows.count() == 0 and rejects.count() == 0


def test_folds_follow_the_key_alone(spark):
    import hashlib

    from pyspark.sql import functions as F
    df = spark.createDataFrame([(k,) for k in [None, *range(60)]], "k long")
    got = {r.k: r.fold for r in df.select("k", csv_io.fold_of(F.col("k"), 5).alias("fold")).collect()}
    assert got == {k: int(hashlib.md5(b"" if k is None else str(k).encode()).hexdigest()[:13], 16) % 5 for k in got}
    assert set(got.values()) == set(range(5))


def test_manifest_roundtrip(spark):
    df = spark.createDataFrame([(1, 0.5, 2.0), (2, 1.5, None)], "user_id long, f1 double, f2 double")
    data, names = csv_io.sink_feature_csv(df, csv_io.new_scratch(spark, "t-manifest"))
    assert csv_io.read_manifest(spark, names) == ["user_id", "f1", "f2"]
    back = csv_io.scan_with_manifest(spark, data, names, types={"user_id": "long"}).orderBy("user_id").collect()
    assert [tuple(r) for r in back] == [(1, 0.5, 2.0), (2, 1.5, None)]
    assert csv_io.label_index(["a", "b", "reordered"], "reordered") == 2


def test_product_ids_unique_per_name(spark):
    from conftest import SF_CHECK
    from pyspark.sql import functions as F

    from cartwise.sources.views import products_view
    p = products_view(spark, SF_CHECK)
    row = p.agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("ids"),
                F.count_distinct("product_name").alias("names")).collect()[0]
    assert row.n == row.ids == row.names


def test_jobs_end_to_end(spark, tmp_path):
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "jobs"))
    import build_dataset
    import train
    from conftest import SF_SMALL
    build_dataset.main(["--input", SF_SMALL, "--output", str(tmp_path / "frames"), "--leak-free"])
    train.main(["--frames", str(tmp_path / "frames"), "--output", str(tmp_path / "out"), "--kind", "glm"])
    metrics = spark.read.json(str(tmp_path / "out" / "validation_metrics")).collect()[0]
    assert 0.0 <= metrics.auc <= 1.0
    baskets = spark.read.parquet(str(tmp_path / "out" / "baskets"))
    test_users = spark.read.parquet(str(tmp_path / "frames" / "test_frame")).select("user_id").distinct().count()
    assert baskets.count() == test_users


def test_saved_booster_scores_a_new_frame(spark, tmp_path):
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "jobs"))
    import build_dataset
    import score
    import train
    from conftest import SF_SMALL
    frames, out = str(tmp_path / "frames"), str(tmp_path / "out")
    build_dataset.main(["--input", SF_SMALL, "--output", frames, "--leak-free"])
    train.main(["--frames", frames, "--output", out, "--rounds", "6", "--patience", "2", "--params", '{"max_depth": 2, "lambda": 2}'])
    history = spark.read.json(out + "/loss_history")
    assert 1 <= history.where("kept").count() <= history.count() <= 6
    score.main(["--model", out + "/model", "--frame", frames + "/test_frame", "--output", out + "/scores"])
    scores = spark.read.parquet(out + "/scores")
    assert scores.count() == spark.read.parquet(frames + "/test_frame").count() and scores.where("p > 0 AND p < 1").count() == scores.count()
