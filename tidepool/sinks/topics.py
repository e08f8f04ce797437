"""Text payloads to a message topic (Kafka sink; connector jar required)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def topic_payload(df: DataFrame, value: str | Column, key: str | Column | None = None) -> DataFrame:
    """The ``key``/``value`` columns the topic sink expects, as text."""
    v = F.col(value) if isinstance(value, str) else value
    cols = [v.cast("string").alias("value")]
    if key is not None:
        k = F.col(key) if isinstance(key, str) else key
        cols.insert(0, k.cast("string").alias("key"))
    return df.select(*cols)


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str,
                value: str | Column = "line", key: str | Column | None = None) -> StreamingQuery:
    """Stream ``value`` (and optional ``key``) into ``topic``."""
    return (topic_payload(df, value, key).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
