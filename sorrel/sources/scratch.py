"""Tables written to the folder that driver and executors share, so that what several steps read is computed once and a lost executor repeats no more than its own tasks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset and all run on one machine, a temporary folder."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isEmpty():
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
            current = sc._jsc.sc().getCheckpointDir()
        path = current.get()
    return path.rstrip("/")


_PATHS: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written once and read back. It stays until `clear`, as what is built on it may be read at any time."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _PATHS.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all written tables of this process. Results that were built on them can't be read after."""
    sc = spark.sparkContext
    while _PATHS:
        path = sc._jvm.org.apache.hadoop.fs.Path(_PATHS.pop())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
