"""Priority codes: three bits of severity below the facility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed import (
    FACILITY_MASK, FACILITY_NAMES, SEVERITY_MASK, SEVERITY_NAMES,
    UNKNOWN_CODE, UNKNOWN_FACILITY, UNKNOWN_SEVERITY,
)

_FACILITIES = FACILITY_NAMES + [UNKNOWN_FACILITY]


def facility_of(code: Column) -> Column:
    """Facility name; null for a number beyond the table."""
    number = F.shiftright(code.bitwiseAND(FACILITY_MASK), 3).cast("int")
    names = F.array(*[F.lit(n) for n in _FACILITIES])
    return F.when(code == UNKNOWN_CODE, F.lit(UNKNOWN_FACILITY)).otherwise(
        F.try_element_at(names, number + 1)
    )


def severity_of(code: Column) -> Column:
    names = F.array(*[F.lit(n) for n in SEVERITY_NAMES])
    return F.when(code == UNKNOWN_CODE, F.lit(UNKNOWN_SEVERITY)).otherwise(
        F.try_element_at(names, code.bitwiseAND(SEVERITY_MASK).cast("int") + 1)
    )


def decode_priority(df: DataFrame, col: str | Column) -> DataFrame:
    """Add ``facility`` and ``severity``; rows with a facility beyond the table are dropped."""
    code = F.col(col) if isinstance(col, str) else col
    return df.withColumns({"facility": facility_of(code), "severity": severity_of(code)}).filter(
        F.col("facility").isNotNull()
    )


def _number(name: Column, names: list[str], fold: bool) -> Column:
    key = F.lower(name) if fold else name
    known = F.array(*[F.lit(n.lower() if fold else n) for n in names])
    return F.when(key == (F.lit("unknown")), F.lit(UNKNOWN_CODE)).otherwise(
        F.nullif(F.array_position(known, key), F.lit(0)).cast("int") - 1
    )


def priority_number(facility: Column, severity: Column) -> Column:
    """The packed code. The facility number is masked but not shifted."""
    return _number(facility, FACILITY_NAMES, True).bitwiseAND(FACILITY_MASK).bitwiseOR(
        _number(severity, SEVERITY_NAMES, True)
    )


def encode_priority(df: DataFrame, facility: str = "facility", severity: str = "severity") -> DataFrame:
    return df.withColumn("priority", priority_number(F.col(facility), F.col(severity)))
