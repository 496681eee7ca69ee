"""Tables written between stages.

A staged table cuts lineage, survives the loss of executors, and gives Catalyst
the true size of a small side: joins against one need no broadcast hint.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = "file://" + tempfile.mkdtemp(prefix="tidepanel-")
    return _local_root


def staging_path(spark: SparkSession, tag: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{staging_root(spark)}/tidepanel/{app}/{tag}-{uuid4().hex}"


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the staging folder and return a scan of what was written."""
    path = staging_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staging(spark: SparkSession) -> None:
    """Delete everything this application staged. Frames that read it stop working."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{staging_root(spark)}/tidepanel/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
