"""Session settings for batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes batch shuffles and splits skewed joins at run time. A stream fixes
# its shuffle width at its first start, so that number must be chosen for the
# cluster. RocksDB keeps window state off the JVM heap and, with the changelog,
# commits only what a batch changed.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Batch shuffles start this wide and AQE merges what is too small: at 100 TB
    # the default of 200 would mean 500 GB per task. Streams do not use it.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "roadpulse", **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` overrides or adds to them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
