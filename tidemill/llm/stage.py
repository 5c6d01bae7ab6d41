"""Tables in the shared folder: they cut lineage and outlive a lost executor."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where that is unset a local session (tests) gets a new one; a cluster's has to name one that all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a reader of those files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Plans that nothing refers to any more go on both sides of the gateway, and Arrow gives freed memory back.
    gc.collect()
    pa.default_memory_pool().release_unused()
    out = spark.read.schema(df.schema).parquet(path)
    out._settled = path
    return out


def drop(df: DataFrame) -> None:
    """Delete the files of a settled table that no later step reads."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._settled)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
