"""The event table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.events import persistable, to_event_rows


def event_rows(df: DataFrame) -> DataFrame:
    """The rows to store of a frame of events."""
    return to_event_rows(persistable(df))


def write_events(df: DataFrame, path: str, batch_id: int | None = None) -> bool:
    """Append the events to store as parquet; nothing is written when there are none.

    With ``batch_id`` the batch has a folder of its own, so that a repeated batch
    replaces itself. Returns whether anything was written.
    """
    rows = event_rows(df)
    if rows.isEmpty():
        return False
    if batch_id is None:
        rows.write.mode("append").parquet(path)
    else:
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return True


def write_events_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> bool:
    """Append the events to store to a database table."""
    rows = event_rows(df)
    if rows.isEmpty():
        return False
    rows.write.jdbc(url, table, mode="append", properties=properties)
    return True
