"""Batches of a source that leave at a number of items or after a time, whichever comes first."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ITEM = "at long, place long, item string"
_COLUMNS = ["at", "place", "item"]


class SizeOrTime(StatefulProcessor):
    """Holds a source's items until the watermark has passed them, and then batches them in order of time.

    The first item of a batch starts its clock: the batch leaves with its ``size``-th item, or when
    ``micros`` have passed, without the items from then on. State is what is inside the watermark, and
    one open batch. Timers stand at the earliest item that waits and at the end of the open batch.
    """

    def __init__(self, size: int, micros: int):
        self.size, self.micros = size, micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _ITEM)
        self.open = handle.getListState("open", _ITEM)
        self.done = handle.getValueState("done", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        earliest = None
        for part in rows:
            items = [(int(a), int(p), None if i is None else str(i)) for a, p, i in part[_COLUMNS].itertuples(index=False)]
            if items:
                self.waiting.appendList(items)
                first = min(items)[0]
                earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wake(earliest)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, held = sorted(self.waiting.get()), list(self.open.get())
        count = self.done.get()[0] if self.done.exists() else 0
        out, later = [], []

        def leave(reason: str) -> None:
            nonlocal count
            out.append((*key, count, reason, held[0][0], held[-1][0], [x[2] for x in held]))
            count += 1
            held.clear()

        for item in waiting:
            if item[0] > now:
                later.append(item)
                continue
            if held and item[0] >= held[0][0] + self.micros:
                leave("time")
            held.append(tuple(item))
            if len(held) == self.size:
                leave("size")
        if held and held[0][0] + self.micros <= now:
            leave("time")
        for state, items in ((self.waiting, later), (self.open, held)):
            if items:
                state.put([tuple(x) for x in items])
            else:
                state.clear()
        self.done.update((count,))
        ends = [x[0] for x in later[:1]] + ([held[0][0] + self.micros] if held else [])
        if ends:
            self._wake(min(ends))
        names = [f"_{k}" for k in range(len(key))]
        yield pd.DataFrame(out, columns=[*names, "batch_no", "reason", "first", "last", "payloads"])

    def _wake(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs this state store; set it before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def batch_by_size_or_time(
    df: DataFrame, size: int, seconds: float, watermark: str, payload: str, order: str,
    keys: tuple[str, ...] = ("source_ip", "source_port"), ts: str = "ts", shards: int = 8,
) -> DataFrame:
    """Batches of a source: ``keys, shard, batch_no, reason, first_ts, last_ts, payloads``.

    Items are taken in order of (``ts``, ``order``), ``order`` being a whole number, however they arrive
    inside the watermark; later rows are dropped by Spark (``with_late_rows`` keeps them). Rows without a
    time are dropped. Each item is in one batch, also over restarts from the checkpoint. A busy source is
    spread over ``shards`` that batch on their own; ``shards=1`` keeps it together. A stream that ends
    keeps its open batches in the state. Append mode.
    """
    use_state_store(df.sparkSession)
    kinds = dict(df.dtypes)
    spread = F.pmod(F.xxhash64(ts, order), F.lit(shards)).cast("int")
    items = df.filter(F.col(ts).isNotNull()).withWatermark(ts, watermark).select(
        *keys, spread.alias("shard"), F.col(ts).cast("timestamp").alias(ts), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"),
        F.coalesce(F.col(order).cast("long"), F.lit(0)).alias("place"), F.col(payload).cast("string").alias("item"))
    names = [*keys, "shard"]
    schema = ", ".join([*[f"_{k} {kinds.get(c, 'int')}" for k, c in enumerate(names)],
                        "batch_no long, reason string, first long, last long, payloads array<string>"])
    out = items.groupBy(*names).transformWithStateInPandas(SizeOrTime(size, int(seconds * 1_000_000)), schema, "Append", "EventTime")
    return out.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(names)], "batch_no", "reason",
                      F.timestamp_micros("first").alias("first_ts"), F.timestamp_micros("last").alias("last_ts"), "payloads")
