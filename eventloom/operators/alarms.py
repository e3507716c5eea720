"""Events with alarm keys to one row per alarm: counted, last state kept, cleared by later events.

An extension: event processing prepares the keys, and what they reduce to is defined here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Alarm type of an event that clears the alarm its ``clear_key`` names.
CLEARS = 2


def reduce_alarms(
    df: DataFrame, ts: str = "time", order: tuple[str, ...] = ("event_id",), severity: str = "severity",
) -> DataFrame:
    """``reduction_key, alarm_type, n_events, first_time, last_time, last_severity, cleared, cleared_time, n_open``.

    One row per ``reduction_key`` of ``df``; rows without one are no alarms, but still clear. Events are
    in order of (``ts``, ``order``), nulls first; ``alarm_type`` and severity are the last event's, the
    greater ones where the order ties. A type-2 event clears the alarm with its ``clear_key`` as of its
    time: ``cleared`` says that one came after the last event, ``cleared_time`` is the first such, and
    ``n_open`` counts the events after the last clear, whether there was one or none.

    All aggregates are sums, minima and maxima, combined before they are shuffled, and what is joined is a
    row per key; so a busy key is never gathered, and adaptive execution can split its rows in the joins.
    """
    place = F.struct(ts, *order)
    events = df.filter(F.col("reduction_key").isNotNull()).select(
        "reduction_key", F.col(ts).alias("_ts"), place.alias("_at"), "alarm_type", F.col(severity).alias("_severity"))
    clears = df.filter((F.col("alarm_type") == CLEARS) & F.col("clear_key").isNotNull()).select(
        F.col("clear_key").alias("_clears"), F.col(ts).alias("_clear_ts"), place.alias("_clear_at"))
    last_clear = clears.groupBy("_clears").agg(F.max("_clear_at").alias("_last_clear"))
    reduced = events.join(last_clear, F.col("reduction_key") == F.col("_clears"), "left").groupBy("reduction_key").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("_ts").alias("first_time"), F.max("_ts").alias("last_time"),
        F.max(F.struct("_at", "_severity", "alarm_type")).alias("_last"),
        F.max("_last_clear").alias("_last_clear"),
        F.sum(F.when(F.col("_last_clear").isNull() | (F.col("_at") > F.col("_last_clear")), 1).otherwise(0)).alias("n_open"),
    ).withColumn("cleared", F.coalesce(F.col("_last_clear") > F.col("_last._at"), F.lit(False)))
    # Only alarms that are cleared ask for the first clear behind their last event.
    ended = reduced.filter("cleared").select(F.col("reduction_key").alias("_ended"), F.col("_last._at").alias("_end"))
    first_clear = (clears.join(ended, F.col("_clears") == F.col("_ended")).filter(F.col("_clear_at") > F.col("_end"))
                   .groupBy("_ended").agg(F.min(F.struct("_clear_at", "_clear_ts")).alias("_first")))
    return reduced.join(first_clear, F.col("reduction_key") == F.col("_ended"), "left").select(
        "reduction_key", F.col("_last.alarm_type").alias("alarm_type"), "n_events", "first_time", "last_time",
        F.col("_last._severity").alias("last_severity"), "cleared", F.col("_first._clear_ts").alias("cleared_time"), "n_open")
