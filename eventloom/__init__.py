"""Log and event analytics on Spark: every operator takes and returns a DataFrame."""

from .session import get_spark

__all__ = ["get_spark"]
