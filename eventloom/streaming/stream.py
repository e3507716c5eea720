"""Structured Streaming: one plan per micro-batch, two sinks, an error channel, hot reload."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import empty_parms, parm
from ..operators.events import MESSAGE_FIELDS, broadcastable, is_reload
from ..operators.route import route
from ..plans.flow import Config, add_row_lookups, build_events, parse_messages
from ..schema import as_events
from ..session import small_cache_batches
from ..sources.envelopes import read_envelopes
from ..sources.sinks import write_events
from .metrics import StageCounts


@dataclass(frozen=True)
class Sinks:
    """Folders below which each output keeps one folder per batch."""

    table: str
    routed: str
    errors: str
    control: str | None = None
    metrics: str | None = None


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that go on, rows for the error channel with their reason).

    Rows that a rule discards are neither: they were meant to go.
    """
    good = df.filter(F.col("reject_reason").isNull() & ~F.col("discarded"))
    bad = df.filter(F.col("reject_reason").isNotNull())
    return good, bad.select("raw", "value", "source_address", "reject_reason") if "value" in df.columns else bad


def needed_later(matched: DataFrame) -> DataFrame:
    """Matched messages with only what events and the error channel read; the envelope stays in rejected rows alone."""
    kept = [c for c in matched.columns if c in MESSAGE_FIELDS]
    envelope = [F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("value")] if "value" in matched.columns else []
    return matched.select(*kept, *envelope, "reject_reason", "discarded")


def write_batch_folder(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch to a folder of its own; a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


# Characters of a failure's text that a reload event carries: its parm is meant for display.
REASON_CHARS = 128


def reload_result(
    spark: SparkSession, success_uei: str, daemon: str, reason: str | None, reason_chars: int = REASON_CHARS
) -> DataFrame:
    """The event that tells how a reload went. A failure has the same name and a reason of
    ``reason_chars`` characters at most."""
    parms = F.array(parm("daemonName", F.lit(daemon)))
    if reason is not None:
        parms = F.concat(parms, F.array(parm("reason", F.lit(reason[:reason_chars]))))
    return as_events(spark.range(1).select(
        F.lit(success_uei).alias("uei"), F.lit(f"{daemon}:reload").alias("source"),
        F.coalesce(parms, empty_parms()).alias("parms"),
    ))


def with_reload(
    batch_fn: Callable[[DataFrame, int, Any], DataFrame],
    reader: Callable[[], Any],
    wanted: Column,
    emit: Callable[[str | None, int, SparkSession], None],
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that reads its state again when a control event asks for it.

    ``batch_fn`` gets (batch, batch id, state) and returns the batch's events. After a
    control event the next batch works on what ``reader`` gives; if that fails the old
    state stays. ``emit`` gets the failure text, or None.
    """
    held = {"state": reader()}

    def run(batch: DataFrame, batch_id: int) -> None:
        events = batch_fn(batch, batch_id, held["state"])
        try:
            if events.filter(wanted).isEmpty():
                return
            try:
                held["state"] = reader()
                reason = None
            except Exception as error:
                reason = str(error) or type(error).__name__
            emit(reason, batch_id, batch.sparkSession)
        finally:
            events.unpersist()

    return run


# Parts that the events of one name are split into on their way to the subscribers.
_NAME_SALTS = 64


def publish(
    events: DataFrame, subscriptions: DataFrame, config: Config, sinks: Sinks, batch_id: int, counts: StageCounts | None = None
) -> None:
    """Hand the same expanded events to the table and to the subscribers."""
    counts = counts or StageCounts()
    write_events(add_row_lookups(events, config), sinks.table, batch_id)
    routed = counts.watch(route(broadcastable(events), subscriptions, salts=_NAME_SALTS), "broadcast")
    write_batch_folder(
        routed.select("listener", "uei", "nodeid", "time", "interface", "severity",
                      F.col("logmsg.content").alias("logmsg"), "parms"),
        sinks.routed, batch_id,
    )


def process_batch(
    batch: DataFrame, batch_id: int, config: Config, subscriptions: DataFrame, sinks: Sinks
) -> DataFrame:
    """One micro-batch of envelopes: parse once, then errors, table and subscribers.

    Returns the expanded events without their definitions, persisted; the caller lets go of them. With ``sinks.metrics`` the
    stages' counts follow: log documents and messages with their sizes, errors, events and broadcasts.
    """
    counts = StageCounts()
    logs = counts.watch(batch, "logs", F.octet_length("value")) if "value" in batch.columns else batch
    envelopes = counts.watch(read_envelopes(logs), "messages", F.octet_length("raw"))
    ref_time = F.coalesce("msg_time", F.current_timestamp())
    with small_cache_batches(batch.sparkSession):
        matched = needed_later(parse_messages(envelopes, config, ref_time)).persist()
        good, bad = split_errors(matched)
        events = counts.watch(build_events(good, config).drop("def"), "events").persist()
        try:
            write_batch_folder(counts.watch(bad, "errors"), sinks.errors, batch_id)
            publish(events, subscriptions, config, sinks, batch_id, counts)
            if sinks.metrics:
                write_batch_folder(counts.rows(batch.sparkSession), sinks.metrics, batch_id)
        finally:
            matched.unpersist()
    return events


def run_stream(
    source: DataFrame,
    config: Config | Callable[[], Config],
    subscriptions: DataFrame,
    sinks: Sinks,
    checkpoint: str,
    reload_uei: str = "uei.example.org/internal/reload",
    changed_uei: str = "uei.example.org/internal/eventsChanged",
    success_uei: str = "uei.example.org/internal/reloadSuccessful",
    daemon: str = "events",
    available_now: bool = False,
    interval: str = "1 second",
) -> StreamingQuery:
    """Run the whole way from envelopes (column ``value``) to both sinks as a stream.

    Outputs are written per batch id, so a batch repeated after a failure leaves no
    duplicates. A control event makes the next batch read its configuration again.
    """
    reader = config if callable(config) else lambda: replace(config)

    def emit(reason: str | None, batch_id: int, spark: SparkSession) -> None:
        if sinks.control:
            result = reload_result(spark, success_uei, daemon, reason)
            write_batch_folder(result.select("uei", "source", "parms"), sinks.control, batch_id)

    step = with_reload(
        lambda batch, batch_id, state: process_batch(batch, batch_id, state, subscriptions, sinks),
        reader, is_reload(reload_uei, changed_uei, daemon), emit,
    )
    writer = source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def batch_by_source_stream(
    df: DataFrame, interval: str, watermark: str, size: int, payload: str,
    keys: tuple[str, ...] = ("source_ip", "source_port"), ts: str = "ts", shards: int = 8,
) -> DataFrame:
    """Batches of a source per ``interval``, cut at ``size`` items.

    Write it in append mode: a batch then comes out once, when the watermark has passed its
    interval. Later rows are dropped by Spark and counted in the query's progress
    (``numRowsDroppedByWatermark``), so ``watermark`` should cover the lateness there is.
    State holds what is inside the watermark. A busy source is spread over ``shards``
    groups, each of which batches on its own; ``shards=1`` keeps a source together.
    """
    spread = F.pmod(F.xxhash64(ts, payload), F.lit(shards)).cast("int")
    grouped = (
        df.withColumn("shard", spread)
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, interval).alias("slot"), *keys, "shard")
        .agg(F.array_sort(F.collect_list(F.struct(ts, payload))).alias("items"))
    )
    starts = F.sequence(F.lit(0), F.size("items") - 1, F.lit(size))
    return grouped.select(
        F.col("slot.start").alias("slot"), *keys, "shard", "items", F.posexplode(starts).alias("batch_no", "at")
    ).select(
        "slot", *keys, "shard", "batch_no",
        F.transform(F.slice("items", F.col("at") + 1, F.lit(size)), lambda x: x[payload]).alias("payloads"),
    )
