"""Kafka source. Needs the ``spark-sql-kafka-0-10`` package on the class path."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"


def kafka_options(
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """One topic from its earliest offset, with a consumer group of its own.

    After the first start the checkpoint's offsets take over. ``min_partitions``
    above the topic's own number splits its fuller partitions over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "groupIdPrefix": f"roadpulse-{uuid.uuid4().hex}",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Messages with ``value`` and broker ``timestamp``."""
    return spark.readStream.format("kafka").options(**options).load().select("value", "timestamp")
