"""Comments from a topic, or from any table with a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    brokers: str,
    topics: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    group_id: str | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source for a comma-separated topic list.

    Offsets live in the query checkpoint; nothing is auto-committed.
    """
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def read_comments(spark: SparkSession, brokers: str, topics: str, **kw) -> DataFrame:
    """Streaming comments ``key, value, partition, offset, timestamp``.

    Needs the Kafka connector on the classpath (not bundled with PySpark).
    """
    raw = spark.readStream.format("kafka").options(**kafka_options(brokers, topics, **kw)).load()
    return record_view(raw)


def record_view(raw: DataFrame) -> DataFrame:
    """Key and value as strings with the message envelope."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        "timestamp",
    )


def comments_from_table(
    df: DataFrame, text: str = "text", key: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Any table as comments: ``value`` from ``text``, ``key`` from ``key``."""
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(*keep, k.alias("key"), F.col(text).alias("value"))
