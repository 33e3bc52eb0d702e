"""Helpers shared by the operators: inputs, shipping code to executors, scratch tables."""

from __future__ import annotations

import ctypes
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import scratch_path


def ship(module_name: str) -> None:
    """Pickle a module's functions by value, so executors need only the third-party packages."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns that text operators read; every other column, whatever its name, is left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def remainder(column: str, modulus: int):
    """crc32 of an id written as text, modulo ``modulus`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Scratch:
    """Parquet tables in the shared checkpoint folder; each cuts lineage and survives lost executors.

    ``drop`` removes tables that no later step reads, so that the folder holds
    only what the returned result still needs.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Memory that Arrow and the C library hold but do not use goes back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def lean(run):
    """``run`` of a map over batches, whose Python worker gives unused memory back.

    Spark keeps workers for later tasks and steps: without this, an idle one
    holds, and a busy one starts from, the most that an earlier task took.
    """
    def held(batches):
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return held


def annotate(df: DataFrame, prefix: str, fields: str, make) -> DataFrame:
    """``df`` with columns computed from its text, in one map without a shuffle.

    ``make()`` runs once per task and returns a function from the text column
    (Arrow) to one Arrow array per field. Added columns are named
    ``prefix + field``; all columns of ``df`` pass through untouched.
    """
    import pyarrow as pa
    from pyspark.sql.types import StructField, StructType

    added = [StructField(prefix + f.name, f.dataType) for f in StructType.fromDDL(fields)]
    at = [c.lower() for c in df.columns].index("text")
    names = [*df.columns, *(f.name for f in added)]
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))  # names with dots cannot be addressed

    def run(batches):
        work = make()
        for batch in batches:
            text = batch.column(at).cast(pa.large_string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *work(text)], names=[*batch.schema.names, *(f.name for f in added)])

    return plain.mapInArrow(lean(run), StructType([*plain.schema.fields, *added])).toDF(*names)
