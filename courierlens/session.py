"""Session settings the library relies on, and the folder it may write below."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """All event times are naive UTC, so the session must read them as such."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def named_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names, if it names one; nothing of the session is changed."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    return path or context.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application that every executor can see, below the one the cluster names.

    Without such a setting a machine-local folder is made, but only where
    driver and executors are one process; anywhere else executors would each
    write to a disk of their own, so that is an error.
    """
    context = spark.sparkContext
    base = named_dir(spark)
    if base is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="courierlens-")
        base = _local_folders[context.applicationId]
    return f"{base.rstrip('/')}/courierlens-{context.applicationId}"


def remove_shared(spark: SparkSession) -> bool:
    """Remove everything this application has staged; to be called once its results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read several times to the shared folder and read it back.

    A written table cuts the lineage, survives lost executors and is cheaper
    than computing its windows again for every reader.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
