"""Driver tables and event-time preparation."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """One driver table as a DataFrame (parquet; pushdown and pruning by Catalyst).

    ``partitions`` deals the rows out to that many tasks; for a table that is
    one row group (read by one task) before CPU-heavy work per row.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.repartition(partitions) if partitions else df


def events_with_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the item id of ``props`` (``{"k": n}``) as ``item_id``."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("item_id", F.get_json_object("props", "$.k").cast("long"))
