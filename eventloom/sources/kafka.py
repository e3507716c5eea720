"""The Kafka log source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_STRINGS = ["CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "timestamp"]


def kafka_options(servers: str, topics: list[str] | str, group: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options: all topics from the earliest offset. Servers and group are required."""
    if not servers:
        raise ValueError("servers are required")
    if not group:
        raise ValueError("a consumer group is required")
    names = [topics] if isinstance(topics, str) else list(topics)
    if not names:
        raise ValueError("at least one topic is required")
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(names),
        "kafka.group.id": group, "startingOffsets": "earliest",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_kafka_logs(
    spark: SparkSession, servers: str, topics: list[str] | str, group: str,
    max_per_trigger: int | None = None, streaming: bool = True,
) -> DataFrame:
    """Text records of the topics. Needs the Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    options = kafka_options(servers, topics, group, max_per_trigger)
    return reader.format("kafka").options(**options).load().selectExpr(*_STRINGS)


def read_file_logs(
    spark: SparkSession, path: str, max_files: int | None = None, streaming: bool = True, wholetext: bool = True
) -> DataFrame:
    """The same shape from text files, for replays and tests: a record per file or per line."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.text(path, wholetext=wholetext).select("value")
