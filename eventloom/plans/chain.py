"""Pluggable steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def run_chain(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """Apply the steps in order; the result is still one lazy plan."""
    return reduce(DataFrame.transform, steps, df)
