"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Field and rule chains make long generated methods. Beyond 8000 bytes of byte code the JVM
# only interprets a method, so such a stage is better off with its expressions split up.
_LIMITS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def get_spark(app: str = "eventloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; sizes come from the cluster's own conf."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Without call sites per column operation, large plans are built several times faster.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **_LIMITS,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Set what the plans here need on a session made elsewhere, where it is still unset."""
    for key, value in _LIMITS.items():
        if spark.conf.get(key) in ("65535", value):
            spark.conf.set(key, value)
    return spark


@contextmanager
def small_cache_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Frames that are persisted and first run inside are kept in batches of ``rows`` rows.

    While Spark stores such batches, it looks at its memory only once in 16 of them, and writes or reads up to 100 of
    them on disk with all in memory. At its own 10,000 rows each, wide rows fill a heap that Spark takes to be free.
    """
    key = "spark.sql.inMemoryColumnarStorage.batchSize"
    held = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(held))))
    try:
        yield
    finally:
        spark.conf.set(key, held)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    A temporary folder stands in only where nothing is set and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="eventloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
