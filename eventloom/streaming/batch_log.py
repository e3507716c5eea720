"""What a stream knows by batch id: late rows and the configuration in force, the same when a batch is repeated."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .stream import write_batch_folder


class BatchLog:
    """One value per batch id in a shared folder; a batch reads what its predecessor left.

    A value is written when its batch is done. A batch that is repeated reads the same value
    again and replaces its own. Batch ids follow each other, so only one small file is read.
    """

    def __init__(self, spark: SparkSession, path: str, kind: str):
        self.spark, self.path, self.kind = spark, path.rstrip("/"), kind

    def before(self, batch_id: int) -> Any:
        """What the batch before left; None if there is no such batch."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={batch_id - 1}/_SUCCESS")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        return self.spark.read.schema(f"value {self.kind}").parquet(f"{self.path}/batch_id={batch_id - 1}").first()[0]

    def leave(self, batch_id: int, value: Any) -> None:
        write_batch_folder(self.spark.createDataFrame([(value,)], f"value {self.kind}").coalesce(1), self.path, batch_id)


def with_late_rows(
    batch_fn: Callable[[DataFrame, int], None], ts: str, delay_seconds: float, errors: str, log: str,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that sends rows behind the watermark to the error channel.

    The watermark of a batch is the latest time of all batches before it, less ``delay_seconds``.
    Rows before it go to ``errors``, one folder per batch id, with ``reject_reason`` and the
    ``watermark`` they missed; the others, and rows without a time, go to ``batch_fn``. No row is lost
    or in both. A repeated batch is cut the same way.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = BatchLog(spark, log, "long")
        before = known.before(batch_id)
        micros = F.unix_micros(F.col(ts).cast("timestamp"))
        batch = batch.persist()
        try:
            if before is None:
                late, good = batch.filter(F.lit(False)), batch
                limit = F.lit(None).cast("long")
            else:
                limit = F.lit(before - int(delay_seconds * 1_000_000))
                is_late = F.coalesce(micros < limit, F.lit(False))
                late, good = batch.filter(is_late), batch.filter(~is_late)
            write_batch_folder(late.withColumns({
                "reject_reason": F.lit("late"), "watermark": F.timestamp_micros(limit)}), errors, batch_id)
            batch_fn(good, batch_id)
            latest = batch.agg(F.max(micros)).first()[0]
            known.leave(batch_id, max((x for x in (before, latest) if x is not None), default=None))
        finally:
            batch.unpersist()

    return run


def with_versions(
    batch_fn: Callable[[DataFrame, int, Any], DataFrame],
    newest: Callable[[], str],
    read: Callable[[str], Any],
    wanted: Column,
    emit: Callable[[str | None, int, SparkSession], None],
    log: str,
) -> Callable[[DataFrame, int], None]:
    """As ``with_reload``, but the version in force is kept by batch id and survives a restart.

    ``newest`` names the newest version (a path, say) and ``read`` reads one by name; a version's
    content must not change. The first batch takes the newest one and logs it before it works. A
    control event in a batch makes the next one use what was newest then; a version that can't be read
    leaves the old one in force. A repeated batch uses the version it first had.
    """
    held: dict[str, Any] = {}

    def state(version: str) -> Any:
        if version not in held:
            held.clear()
            held[version] = read(version)
        return held[version]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = BatchLog(spark, log, "string")
        version = known.before(batch_id)
        if version is None:
            version = newest()
            known.leave(batch_id - 1, version)
        events = batch_fn(batch, batch_id, state(version))
        try:
            following = version
            if not events.filter(wanted).isEmpty():
                reason = None
                try:
                    named = newest()
                    state(named)
                    following = named
                except Exception as error:
                    reason = str(error) or type(error).__name__
                emit(reason, batch_id, spark)
            known.leave(batch_id, following)
        finally:
            events.unpersist()

    return run
