"""Inputs that every document operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, `n_hit.x` string, cls string, shard int"

LONG = " ".join(f"wort{i % 977} été{i % 31}" for i in range(60_000))
NEAR = " ".join(f"w{i}" for i in range(60))


def documents(spark):
    rows = [(1, "The quick brown fox jumps over the lazy dog again and again today."), (2, None), (3, ""), (4, "   \n\t "),
            (5, LONG), (6, "one two three"), (7, NEAR), (8, NEAR + " tail"), (9, NEAR), (9, NEAR), (None, NEAR), (10, "a" * 50_000),
            (11, "é\u2028ü\x1f x\x0by"), (12, "a.\na.\na.\na.\na.\na.\na.\na.\na.\na."), (None, None)]
    full = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None, 0.5, "x", "c", 7) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def texts(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")
