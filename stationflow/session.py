"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "stationflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call sites are looked up for every expression otherwise, which doubles plan building
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    defaults.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive times are UTC throughout, so the session zone has to be UTC too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.isModifiable("spark.python.sql.dataFrameDebugging.enabled"):
        spark.conf.set("spark.python.sql.dataFrameDebugging.enabled", "false")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there the driver and the
    executors are one process. On a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stationflow-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder; never reused, so a rerun cannot read stale files."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name: str):
    """Materialise ``df`` as a table in the shared folder and read it back.

    The files outlive lost executors, so an iterative or many-times-read result is never
    recomputed from its sources.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
