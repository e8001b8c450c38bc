"""The registry that query modules fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder, opened when they are named."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    __getattr__ = __getitem__


def case_sensitive(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one, where names that differ by case only are different columns. The one given stays as it is."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own


def query(sql: str | None = None) -> Callable:
    """Registers a function of Tables under its name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register
