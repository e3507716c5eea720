"""Counts of what passes each stage of a micro-batch, taken by the run that does the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "stage string, rows long, bytes long, most_bytes long"


class StageCounts:
    """Watches frames by ``observe``: their rows, and the sum and maximum of a size.

    The numbers come with the first action that runs a frame to its end, such as a write; no
    frame is run for them. A frame that no action runs must not be watched.
    """

    def __init__(self) -> None:
        self.watched: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, stage: str, size: Column | None = None) -> DataFrame:
        seen = Observation()
        self.watched.append((stage, seen))
        size = F.lit(None) if size is None else size
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(size.cast("long")).alias("bytes"), F.max(size.cast("long")).alias("most"))

    def rows(self, spark: SparkSession) -> DataFrame:
        """``stage, rows, bytes, most_bytes``, a row per watched stage, after the actions that ran them."""
        found = [(stage, seen.get) for stage, seen in self.watched]
        return spark.createDataFrame([(stage, m["rows"], m["bytes"], m["most"]) for stage, m in found], _SCHEMA)
