"""Rows and seconds of a job's steps, observed while the steps run: no count is computed for the sake of the figures."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Steps:
    """``run`` does a step's action; ``table`` gives step, calls, rows and seconds in the order of first calls."""

    def __init__(self) -> None:
        self.taken: dict[str, list] = {}

    def run(self, name: str, df: DataFrame, action: Callable[[DataFrame], Any], **more: Column) -> Any:
        """The action on ``df``, whose rows are counted as they pass; ``more``: further aggregates to observe."""
        seen, began = Observation(), time.perf_counter()
        out = action(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]))
        found = seen.get
        held = self.taken.setdefault(name, [0, 0, 0.0, {}])
        held[0] += 1
        held[1] += found["rows"]
        held[2] += time.perf_counter() - began
        held[3] = {k: v for k, v in found.items() if k != "rows"}
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(name, calls, n, seconds) for name, (calls, n, seconds, _) in self.taken.items()]
        return spark.createDataFrame(rows, "step string, calls long, rows long, seconds double")
