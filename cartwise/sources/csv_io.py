"""CSV sources and sinks.

The analysed jobs exchange data as CSV: header CSVs read as all-string
columns and cast in bulk, and headerless CSVs with the column names kept in
a side "manifest" (``name1,name2,...,`` with a trailing comma). These
helpers keep those formats but write in parallel (no ``coalesce(1)``) and
always under a folder the caller names (the shared checkpoint folder for
intermediate tables).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartwise.session import scratch_path


def new_scratch(spark: SparkSession, stem: str) -> str:
    """Fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, f"{stem}-{uuid.uuid4().hex[:12]}")


def write_header_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def scan_csv_untyped(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Read a header CSV (every column a string), then cast in bulk.

    ``try_cast`` turns text that does not parse into null instead of failing
    the job (Spark 4 casts are ANSI by default). Columns absent from
    ``types`` stay strings.
    """
    raw = spark.read.option("header", True).csv(path)
    text = {c: F.col(f"`{c}`") for c in raw.columns}
    return raw.select(*[text[c].try_cast(types[c]).alias(c) if c in types else text[c] for c in raw.columns])


#: Holds a line as it stands when its number of fields is not the schema's.
LINE = "__line"
#: Bits of the integer types, by the names that Spark takes.
INTEGER_BITS = {"tinyint": 8, "byte": 8, "smallint": 16, "short": 16, "int": 32, "integer": 32, "bigint": 64, "long": 64}


def reject_reason(text: F.Column, kind: str) -> F.Column:
    """Why ``text`` is no value of type ``kind`` (null where it is one, and where there is no text)."""
    number = text.try_cast("double")
    fits = text.isNull() | text.try_cast(kind).isNotNull()
    if kind in INTEGER_BITS:
        wrong = (F.when(number.isNull() | F.isnan(number), "not a number")
                 .when(F.abs(number) >= float(2 ** (INTEGER_BITS[kind] - 1)), "out of range").otherwise("not an integer"))
    elif kind in ("double", "float") or kind.startswith("decimal"):
        wrong = F.when(number.isNull(), "not a number").otherwise("out of range")
    else:
        wrong = F.lit(f"not a {kind}")
    return F.when(~fits, wrong)


def scan_csv_checked(spark: SparkSession, path: str, types: dict[str, str],
                     names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``scan_csv_untyped`` that keeps what it cannot read: ``(rows, rejects)``.

    ``rows`` are the lines with the right number of fields, cast in bulk; a cell
    that does not parse is null in them. ``rejects`` (column, text, reason) has a row for
    each such cell, and one with a null column and the whole line for each line with too
    few or too many fields, so rows and rejected lines add up to the lines of the files.
    Both read the files once, without a shuffle. ``names`` are the columns of files
    without a header. At least one column must be typed.
    """
    header = names is None
    names = spark.read.option("header", True).csv(path).columns if header else names
    typed = [c for c in names if c in types]
    if not typed:
        raise ValueError(f"no column of {path} is typed: there is nothing to check")
    schema = StructType([StructField(n, StringType()) for n in (*names, LINE)])
    raw = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False)
           .option("columnNameOfCorruptRecord", LINE).csv(path))
    text = {c: F.col(f"`{c}`") for c in names}
    # always true where LINE is null: Spark refuses to read the column of malformed lines alone (a count would)
    whole = F.col(LINE).isNull() & (F.coalesce(F.length(text[names[0]]), F.lit(0)) >= 0)
    rows = raw.where(whole).select(*[(text[c].try_cast(types[c]) if c in types else text[c]).alias(c) for c in names])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), text[c].alias("text"), reject_reason(text[c], types[c]).alias("reason")) for c in typed])
    line = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.col(LINE).alias("text"), F.lit("number of fields").alias("reason")))
    found = F.when(whole, F.filter(cells, lambda x: x["reason"].isNotNull())).otherwise(line)
    return rows, raw.select(F.inline(found))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(column, reason, n_rejected) of the second frame of ``scan_csv_checked``."""
    return rejects.groupBy("column", "reason").agg(F.count("*").alias("n_rejected"))


def manifest_text(columns: list[str]) -> str:
    return "".join(f"{c}," for c in columns)


def sink_feature_csv(df: DataFrame, path: str) -> tuple[str, str]:
    """Headerless CSV data + one-line manifest of column names.

    Data is written by all tasks in parallel; the manifest is a one-row
    text table written next to it.
    """
    data = os.path.join(path, "data")
    names = os.path.join(path, "columns")
    df.write.mode("overwrite").option("header", False).csv(data)
    spark = df.sparkSession
    spark.createDataFrame([(manifest_text(df.columns),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(names)
    return data, names


def read_manifest(spark: SparkSession, names_path: str) -> list[str]:
    """Column names from a manifest; the empty name after the trailing comma is dropped."""
    line = spark.read.text(names_path).first()[0]
    names = line.split(",")
    if names and names[-1] == "":
        names = names[:-1]
    return names


def scan_with_manifest(spark: SparkSession, data_path: str, names_path: str,
                       types: dict[str, str] | None = None, default_type: str = "double") -> DataFrame:
    """Headerless CSV with names from the manifest, typed by an explicit schema."""
    names = read_manifest(spark, names_path)
    types = types or {}
    # read as text and cast to the declared type: a long that went through a double would lose digits
    df = spark.read.schema(StructType([StructField(n, StringType(), True) for n in names])).option("header", False).csv(data_path)
    return df.select(*(_typed(F.col(f"`{n}`"), types.get(n, default_type)).alias(n) for n in names))


def _typed(text: F.Column, kind: str) -> F.Column:
    """Text as ``kind``; an integer written with a decimal point ("7.0") is still read."""
    if kind == "string":
        return text
    value = text.try_cast(kind)
    return F.coalesce(value, text.try_cast("decimal(38,10)").try_cast(kind)) if kind in ("int", "long", "bigint") else value


def label_index(columns: list[str], label: str) -> int:
    """Position of the label column (the manifests are positional)."""
    return columns.index(label)


def fold_of(key: F.Column, folds: int) -> F.Column:
    """Fold (0 .. folds - 1) of a key by the first 52 bits of its text's MD5: other engines compute the same one."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 13), 16, 10).cast("long"), F.lit(folds)).cast("int")


def write_folds(df: DataFrame, path: str, key: str = "user_id", folds: int = 3) -> str:
    """Write ``df`` split into ``folds`` files by a hash of ``key`` (partitioned folders)."""
    df.withColumn("fold", fold_of(F.col(key), folds)).write.mode("overwrite").partitionBy("fold").parquet(path)
    return path


def scan_folds(spark: SparkSession, path: str) -> DataFrame:
    """Read all fold files as one set; the fold id comes from the folder name."""
    return spark.read.parquet(path)
