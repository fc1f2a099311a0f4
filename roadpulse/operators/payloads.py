"""JSON message payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators.readings import INGEST_TIME
from roadpulse.schemas import STATION_TEXT

_BAD = "_corrupt_record"


def decode_payload(
    messages: DataFrame, schema: T.StructType = STATION_TEXT, drop_malformed: bool = False
) -> DataFrame:
    """Messages (value, timestamp) to records plus the broker time.

    Empty messages are dropped. A message that is not JSON stays as a record
    without values, unless ``drop_malformed`` is set.
    """
    text = F.col("value").cast("string")
    if drop_malformed:
        schema = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
        parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": _BAD})
    else:
        parsed = F.from_json(text, schema)
    records = (
        messages.where(F.col("value").isNotNull())
        .select(parsed.alias("record"), F.col("timestamp").alias(INGEST_TIME))
        .select("record.*", INGEST_TIME)
    )
    return records.where(F.col(_BAD).isNull()).drop(_BAD) if drop_malformed else records


def encode_payload(records: DataFrame) -> DataFrame:
    """Each record as one JSON object of strings; a missing cell is ``""``."""
    cells = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name) for name in records.columns]
    return records.select(F.to_json(F.struct(*cells)).alias("value"))


def payload_key_profile(messages: DataFrame) -> DataFrame:
    """For every key of the JSON objects, how many messages have it.

    Looks at all messages, and only at their keys.
    """
    text = F.col("value").cast("string")
    return (
        messages.select(F.explode(F.json_object_keys(text)).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def payload_samples(messages: DataFrame, n: int = 3, cells: int = 3) -> DataFrame:
    """Keys of the earliest ``n`` JSON messages and their first ``cells`` values.

    A top-n: no more than ``n`` messages per task are kept.
    """
    text = F.col("value").cast("string")
    keys = F.json_object_keys(text)
    earliest = messages.where(keys.isNotNull()).orderBy("timestamp", "value").limit(n)
    values = F.map_values(F.from_json(text, T.MapType(T.StringType(), T.StringType())))
    return earliest.select(
        "timestamp",
        F.array_join(keys, "|").alias("keys"),
        F.array_join(F.slice(values, 1, cells), "|", "").alias("sample_values"),
    )
