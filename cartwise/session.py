"""Spark session helpers.

Library code never creates its own session; it takes the one it is given.
These helpers exist for jobs, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "cartwise", driver_memory: str = "8g") -> SparkSession:
    """Session for local runs (tests, bench). A cluster run passes its own session."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    That setting must name storage that every executor and the driver share.
    Only in local mode (one process: tests, bench) a scratch folder per
    application stands in for it; on a cluster a missing setting is an error,
    because executors would write to their own disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: intermediate tables go there")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_CKPT:
        _LOCAL_CKPT[app] = tempfile.mkdtemp(prefix="cartwise-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", _LOCAL_CKPT[app])
        except Exception:  # noqa: BLE001 - some deployments reject core confs at run time
            pass
        spark.sparkContext.setCheckpointDir(_LOCAL_CKPT[app])
    return _LOCAL_CKPT[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate table that no later step reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the plan once (an
    eager reliable checkpoint runs it twice: count, then write), stores it
    columnar and compressed, and gives the planner real file sizes for its
    join decisions. A lost executor re-reads the files instead of recomputing.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)
