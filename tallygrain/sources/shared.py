"""What is made once and read several times, in the folder that all nodes share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


#: Folders that this driver has made; they go when it ends, as nothing can read the frames over them later.
MADE: list[str] = []


@atexit.register
def swept() -> None:
    """Remove the folders that folder() gave out, through the file system that Spark uses, while its JVM is there."""
    jvm, sc = SparkContext._jvm, SparkContext._active_spark_context
    for path in MADE if jvm is not None else ():
        with contextlib.suppress(Exception):  # the driver is ending; what can't be removed stays
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration() if sc else jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)
    MADE.clear()


def folder(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, until the driver ends. Without that setting a local session takes a
    temporary folder and keeps to it; a cluster is refused, as its nodes share no local disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        base = "file://" + tempfile.mkdtemp(prefix="tallygrain-")
        spark.conf.set("spark.checkpoint.dir", base)
    MADE.append(f"{base.rstrip('/')}/tallygrain-{uuid.uuid4().hex}")
    return MADE[-1]


def shared(df: DataFrame) -> DataFrame:
    """df written as Parquet and read again, so that what follows doesn't make it anew for each use."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
