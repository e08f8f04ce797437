"""Typed CSV with a fixed field order (user behaviour logs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed field order of the behaviour log: id of user, item, category, the
# behaviour name and the event time in epoch seconds.
BEHAVIOR_SCHEMA = "user_id long, item_id long, category_id int, behavior string, timestamp long"


def read_behaviors(spark: SparkSession, path: str, stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Behaviour CSV (no header) with an event-time column ``ts`` from epoch seconds."""
    if stream:
        r = spark.readStream.schema(BEHAVIOR_SCHEMA).option("header", "false")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.csv(path)
    else:
        df = spark.read.schema(BEHAVIOR_SCHEMA).option("header", "false").csv(path)
    return df.withColumn("ts", F.timestamp_seconds("timestamp"))
