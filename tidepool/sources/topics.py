"""Message topics (Kafka source).  The connector jar must be on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(servers: str, pattern: str | None = None, topic: str | None = None,
                  starting: str = "latest", group_id: str | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Source options: one topic (``subscribe``) or a regex (``subscribePattern``)."""
    if (pattern is None) == (topic is None):
        raise ValueError("give exactly one of pattern or topic")
    opts = {"kafka.bootstrap.servers": servers, "startingOffsets": starting}
    if pattern is not None:
        opts["subscribePattern"] = pattern
    else:
        opts["subscribe"] = topic
    if group_id is not None:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_topics(spark: SparkSession, servers: str, **kw) -> DataFrame:
    """Stream of topic records with the payload as text in ``line``."""
    df = spark.readStream.format("kafka").options(**topic_options(servers, **kw)).load()
    return df.select(F.col("value").cast("string").alias("line"), "topic", "partition",
                     "offset", "timestamp")
