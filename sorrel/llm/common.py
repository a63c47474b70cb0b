"""Small helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Stands for a missing doc_id where documents are ordered: after every real id.
NO_ID = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session, or where it is unset and all run on one machine (tests), one of our own."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if path is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = path or tempfile.mkdtemp(prefix="spark-checkpoint-")
        sc.setCheckpointDir(path)
        current = sc._jsc.sc().getCheckpointDir()
    return path or current.get()


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, for one written table or one set of files."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, so that a lost executor repeats no earlier stage."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t.written_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.LargeStringArray:
    """One contiguous string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_string())
    return column.cast(pa.large_string()).fill_null("")


def slices(lengths: np.ndarray, most: int):
    """Row ranges whose summed length stays under `most`, or single rows above it."""
    at, n, ends = 0, len(lengths), np.cumsum(lengths)
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, to
        at = to
