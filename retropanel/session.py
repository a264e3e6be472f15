"""Session settings and materialisation points."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "retropanel", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on.

    Shuffle width is left to the cluster's own configuration; adaptive execution coalesces small
    partitions and splits skewed join partitions at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.scheduler.mode": "FAIR",  # concurrent fits of a search share the cluster evenly
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site capture per column
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else one beside the warehouse's tables."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


_MARKED: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under this application's part of the shared folder.

    Frames are lazy, so their files are needed as long as the application may read them; the part is
    deleted when the driver ends.
    """
    root = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if root not in _MARKED:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        _MARKED.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write a frame once to the shared folder, where several later plans read it.

    The files outlive any executor, so a lost executor re-reads them instead of recomputing the scan. With
    ``partition_by`` each value of that column is a directory of its own.
    """
    path = scratch_path(df.sparkSession, "stage")
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
