"""Batches that readers see whole or not at all: folders of files, and a manifest that names those that count."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import event_rows


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its object."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _entry(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/manifest/batch-{batch_id}.json"


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    files, entry = _files(spark, _entry(path, batch_id))
    return files.exists(entry)


def write_committed(df: DataFrame, path: str, batch_id: int) -> bool:
    """Write a batch below ``path``; it counts from the moment its manifest entry is there.

    Every attempt has a folder of its own. The entry is one small file, renamed into place when all data
    are written, so that a writer that dies leaves an attempt that no reader sees. A batch that
    has an entry is not written again: the return value says whether this call made it count. Columns
    named ``batch_id`` or ``attempt`` are refused, as they name the folders. An empty batch is committed too.
    """
    clash = {"batch_id", "attempt"} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} have the names of folders")
    spark = df.sparkSession
    if is_committed(spark, path, batch_id):
        return False
    attempt = uuid.uuid4().hex
    df.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/data/batch_id={batch_id}/attempt={attempt}")
    return commit(spark, path, batch_id, attempt)


def commit(spark: SparkSession, path: str, batch_id: int, attempt: str) -> bool:
    """Name the attempt that counts for a batch, unless another one does; returns whether it does now."""
    files, entry = _files(spark, _entry(path, batch_id))
    # Names with a dot in front are no data for Spark's readers.
    _, draft = _files(spark, f"{path.rstrip('/')}/manifest/.batch-{batch_id}-{attempt}")
    out = files.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"batch_id": batch_id, "attempt": attempt}).encode()))
    finally:
        out.close()
    if not files.exists(entry) and files.rename(draft, entry):
        return True
    files.delete(draft, False)
    return False


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, attempt``, a row per committed batch."""
    schema = "batch_id long, attempt string"
    files, folder = _files(spark, f"{path.rstrip('/')}/manifest")
    return spark.read.schema(schema).json(str(folder)) if files.exists(folder) else spark.createDataFrame([], schema)


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches, with ``batch_id``.

    The manifest is joined on the folder columns: Spark prunes the folders of other attempts when it runs, and no
    list of batches passes through the driver. A path without batches gives no rows.
    """
    files, folder = _files(spark, f"{path.rstrip('/')}/data")
    whole = StructType(schema.fields).add("batch_id", "long").add("attempt", "string")
    rows = spark.read.schema(whole).parquet(str(folder)) if files.exists(folder) else spark.createDataFrame([], whole)
    return rows.join(manifest(spark, path), ["batch_id", "attempt"], "left_semi").select(*schema.names, "batch_id")


def write_events_committed(df: DataFrame, path: str, batch_id: int) -> bool:
    """Store a batch of events so that a repeated or half-written batch is never seen twice or in part."""
    return write_committed(event_rows(df), path, batch_id)


def stale_attempts(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, attempt`` of data folders that no manifest entry names, for a clean-up job to delete."""
    files, folder = _files(spark, f"{path.rstrip('/')}/data")
    if not files.exists(folder):
        return spark.createDataFrame([], "batch_id long, attempt string")
    seen = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary, batch_id long, attempt string"
    ).option("pathGlobFilter", "*.parquet").load(str(folder)).select("batch_id", "attempt").distinct()
    return seen.join(manifest(spark, path), ["batch_id", "attempt"], "left_anti").select(
        F.col("batch_id"), F.col("attempt"))
