"""Six ordered stages, each reading the stored table of the one before."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from reviewgrain.sources.files import first_existing, save

STAGES = ["load", "preprocess", "impute", "categorise", "analyse", "report"]


class StageStore:
    """One Parquet table per stage below a folder all executors can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def path(self, stage: str) -> str:
        return f"{self._folder}/{stage}"

    def read(self, stage: str) -> DataFrame:
        return self._spark.read.parquet(self.path(stage))

    def best_available(self) -> DataFrame | None:
        """The analysed reviews when they exist, else the preprocessed ones, else None."""
        return first_existing(self._spark, [self.path("analyse"), self.path("preprocess")])

    def run(
        self,
        steps: Mapping[str, Callable[[DataFrame | None], DataFrame]],
        only: str | None = None,
        start_from: str | None = None,
    ) -> DataFrame:
        """Run all stages, a single one, or those from ``start_from`` on.

        Each stage gets the table of its predecessor, whatever stage comes
        first, and stages without a step pass it on.
        """
        for name in (only, start_from):
            if name is not None and name not in STAGES:
                raise ValueError(f"unknown stage {name!r}; stages are {STAGES}")
        first = STAGES.index(only or start_from or STAGES[0])
        chosen = [only] if only else STAGES[first:]
        table = self.read(STAGES[first - 1]) if first else None
        for stage in chosen:
            result = steps[stage](table) if stage in steps else table
            if result is None:
                raise ValueError(f"stage {stage!r} has no input")
            save(result, self.path(stage))
            table = self.read(stage)
        return table
