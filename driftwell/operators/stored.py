"""Cutting lineage by a checkpoint in the folder that the cluster names, or one of our own where it names none; tasks of bounded size."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is set, one of our own on a single machine, else an error."""
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    path = spark.conf.get("spark.checkpoint.dir", None) or (held.get() if held.isDefined() else None)
    if not path:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="driftwell-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    if not held.isDefined():
        context.setCheckpointDir(path)
    return path.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The rows, computed once and read again from Parquet; a checkpoint computes them twice, but takes every type."""
    kinds = df.schema.simpleString()
    if any(k in kinds for k in ("void", "interval", "variant")):
        return stored(df)
    path = f"{shared(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    shared(df.sparkSession)
    return df.checkpoint()


def tasks(df: DataFrame, rows: int = 1 << 20) -> int:
    """Partitions for a table that is dealt out by a key: each core has one, and none has many more rows than that, however large the table."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
