"""Incremental evaluation: new rows select the series to look at again, and finished rows are marked.

Row-count frames cannot run on a stream, so each micro-batch is a batch computation over the series that it touches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import null_safe


def unmarked(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that are not in the table of finished rows."""
    return df.alias("d").join(done.alias("m"), null_safe("d", "m", keys), "left_anti")


def with_look_back(df: DataFrame, fresh: DataFrame, series: list[str], order: str, rows: int) -> DataFrame:
    """The touched series from ``rows`` rows before their first fresh row on, so that its window is full."""
    start = fresh.groupBy(*series).agg(F.min(order).alias("start_"))
    touched = df.alias("d").join(start.alias("s"), null_safe("d", "s", series)).select("d.*", "start_")
    w = W.partitionBy(*series).orderBy(order)
    n = touched.withColumn("n_", F.row_number().over(w))
    first = n.withColumn("first_", F.min(F.when(F.col(order) >= F.col("start_"), F.col("n_"))).over(W.partitionBy(*series)))
    return first.filter(F.col("n_") >= F.col("first_") - rows).drop("n_", "first_", "start_")


def run_available(spark: SparkSession, path: str, schema: str, checkpoint: str, batch: Callable[[DataFrame, int], None], most_files: int = 1000) -> None:
    """Every file that has not been seen goes through ``batch`` once; progress is kept in ``checkpoint``."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def tumbling(stream: DataFrame, at: str, width: str, late: str, keys: list[str], *aggs: Column) -> DataFrame:
    """Aggregates of event-time windows; rows later than the watermark are dropped by the stream's contract."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(*aggs)


def sessions(stream: DataFrame, at: str, gap: str, late: str, keys: list[str], *aggs: Column) -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys).agg(*aggs)
