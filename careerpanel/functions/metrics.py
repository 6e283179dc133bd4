"""Numbers that a job counts while it does its work, without a job of their own."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Metrics:
    """Named counts over frames; a name may be counted on several frames and is added up.

    The numbers are there once the frames have been written or collected; asking earlier waits for that.
    """

    def __init__(self) -> None:
        self._watched: list[Observation] = []

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """The same rows; each of ``counts`` (aggregates) is taken while they pass."""
        observation = Observation()
        self._watched.append(observation)
        return df.observe(observation, *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in counts.items()])

    def numbers(self) -> dict[str, int]:
        total: dict[str, int] = defaultdict(int)
        for observation in self._watched:
            for name, n in observation.get.items():
                total[name] += n
        return dict(total)
