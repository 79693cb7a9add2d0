"""Row counts of the stages of a plan, taken by the job that runs it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class StageCounts:
    """Counts rows where ``at`` stands in a plan, without a job or a scan of its own.

    Counts are for reports: where a lost executor makes Spark run tasks of a stage again, their rows may count twice.
    ``get`` waits for the first job that runs the plan, so call it after one.
    """

    def __init__(self) -> None:
        self._stages: dict[str, Observation] = {}

    def at(self, df: DataFrame, stage: str) -> DataFrame:
        if stage in self._stages:
            raise ValueError(f"stage {stage} is counted already")
        self._stages[stage] = Observation()
        return df.observe(self._stages[stage], F.count(F.lit(1)).alias("n_rows"))

    def get(self) -> dict[str, int]:
        return {stage: seen.get["n_rows"] for stage, seen in self._stages.items()}


def counted(df: DataFrame, counts: StageCounts | None, stage: str) -> DataFrame:
    return df if counts is None else counts.at(df, stage)
