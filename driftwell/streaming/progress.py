"""Stages that go on after a crash: each stage takes each batch once.

A stage's rows and the mark that it has taken a batch are published by one pointer of the store, so there is no moment at
which one is there without the other. A run that is started again skips what is marked and reads that stage's rows of the
batch from the store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store

#: The column that says which batch a stage's row comes from.
BATCH = "batch_"


class Stages:
    """``steps``: (name, function of the rows of the step before); each step's rows are a table of the store."""

    def __init__(self, store: Store, steps: list[tuple[str, Callable[[DataFrame], DataFrame]]]) -> None:
        self.store, self.steps = store, steps

    def done(self, step: str, batch: int) -> bool:
        return self.store.last_batch(step, step) >= batch

    def take(self, rows: DataFrame, batch: int) -> DataFrame:
        """One batch through all steps. Batches are numbered from 0 and come in order."""
        for name, fn in self.steps:
            if not self.done(name, batch):
                if batch and not self.done(name, batch - 1):
                    raise ValueError(f"{name} has not taken batch {batch - 1}")
                self.store.insert(name, fn(rows).withColumn(BATCH, F.lit(batch)), batch=(name, batch))
            rows = self.store.read(name).filter(F.col(BATCH) == batch).drop(BATCH)
        return rows

    def rows(self, step: str) -> DataFrame:
        return self.store.read(step).drop(BATCH)

    def last_runs(self) -> dict[str, tuple[int, str | None]]:
        """For each step the last batch that it has taken (-1: none) and when (UTC, ISO)."""
        return {name: (self.store.last_batch(name, name), self.store.last_written(name)) for name, _ in self.steps}
