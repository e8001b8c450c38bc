"""What the operators share: intermediate tables in the cluster's shared folder, and shipping Python kernels."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: With this setting Spark deletes a query's shuffle files as soon as the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(module: ModuleType) -> None:
    """Send a module's functions to executors by value, so that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(module)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where that is unset on one machine, one of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = held.get() if held.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="driftwell-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


class Stash:
    """Intermediate tables of one operator call, written once as Parquet so that no lineage has to be computed again."""

    #: Roots of the stashes that ``released`` deletes.
    roots: list[str] | None = None

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        if Stash.roots is not None:
            Stash.roots.append(self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path, before = f"{self.root}/{name}", self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            delete(self.spark, f"{self.root}/{name}")


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables of all operators called inside, once their results are written."""
    before, Stash.roots = Stash.roots, []
    try:
        yield
    finally:
        for root in Stash.roots:
            delete(spark, root)
        Stash.roots = before


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
