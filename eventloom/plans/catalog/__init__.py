"""All named queries and their SQL."""

from . import alarms, delivery, expansion, lookups, rules, streams, text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
