"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Bytes of rows that Spark hands to a Python worker at a time, unless one row is longer.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound batches for Python workers by bytes: with a bound on rows alone they grow with the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def workspace(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, removed when the driver's JVM ends.

    Where that is unset a local folder serves a local master; on a cluster it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="loamline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/loamline/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table, read back: computed once, and a lost executor costs its running tasks only."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
