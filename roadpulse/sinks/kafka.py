"""Kafka sink. Needs the ``spark-sql-kafka-0-10`` package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roadpulse.operators.payloads import encode_payload


def publish(records: DataFrame, servers: str, topic: str) -> None:
    """Send every record as one JSON message; executors write in parallel."""
    (
        encode_payload(records)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
