"""Tables in between, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the context's checkpoint folder; where neither is set, a folder of our own on a local master, and an error elsewhere, since executors would each write to their own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='terrace-')}")
    return shared_dir(spark)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written as a Parquet table and read back, and the table's path: its plan begins there, and a lost executor costs nothing."""
    path = f"{shared_dir(df.sparkSession)}/terrace/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)
