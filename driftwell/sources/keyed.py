"""Tables indexed by a key and its prefixes: bucketed by the first key, sorted by all of them.

A lookup by the first key opens one bucket's files, and there the row groups whose range of the next keys fits. (The plan
names the selected buckets where ``spark.sql.sources.bucketing.autoBucketedScan.enabled`` is false; they are selected either
way.) Joins on the first key need no shuffle of the indexed side.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Index:
    """``keys``: the first one finds the bucket."""

    def __init__(self, spark: SparkSession, table: str, keys: list[str]) -> None:
        self.spark, self.table, self.keys = spark, table, keys

    @classmethod
    def build(cls, df: DataFrame, table: str, keys: list[str], path: str, buckets: int = 64) -> Index:
        """Write the rows below ``path``. Each bucket is one file, as rows are dealt by bucket first."""
        rows = df.repartition(buckets, keys[0])
        rows.write.bucketBy(buckets, keys[0]).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)
        return cls(df.sparkSession, table, keys)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def get(self, *values: Any) -> DataFrame:
        """Rows whose first keys have these values; a list stands for any of its members, None for missing ones."""
        if not 0 < len(values) <= len(self.keys):
            raise ValueError(f"one to {len(self.keys)} values are needed")
        out = self.rows()
        for k, v in zip(self.keys, values, strict=False):
            out = out.filter(F.col(k).isNull() if v is None else F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == F.lit(v))
        return out

    def matching(self, df: DataFrame, how: str = "inner") -> DataFrame:
        """``df`` joined on the keys that it has; of the indexed table only the first key's buckets meet."""
        return df.join(self.rows(), [k for k in self.keys if k in df.columns], how)
