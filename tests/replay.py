"""Write a table as ordered files for stream tests.

An optional last folder holds one sentinel row far in the future: it moves the
watermark past every open window.  It must pass the query's filters, since they
are pushed below ``withWatermark``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINEL_TIME = "2200-01-01 00:00:00"


def write_replay(df: DataFrame, path: str, time_col: str, n_files: int,
                 sentinel: dict | None = None) -> list[str]:
    """Write ``df`` as ``n_files`` time-ordered folders under ``path``; return them.

    ``time_col`` is cast to ``timestamp`` (streams need it).  ``sentinel`` maps
    column names to values for the closing row (its time is ``SENTINEL_TIME``).
    """
    data = df.withColumn(time_col, F.col(time_col).cast("timestamp"))
    bounds = data.select(F.min(time_col).cast("long").alias("lo"),
                         F.max(time_col).cast("long").alias("hi")).first()
    lo, hi = bounds.lo, bounds.hi
    width = max(1, (hi - lo) // n_files + 1)
    part = F.least(F.lit(n_files - 1), ((F.col(time_col).cast("long") - lo) / width).cast("int"))
    folders = []
    for i in range(n_files):
        folder = os.path.join(path, f"{i:05d}")
        data.filter(part == i).coalesce(1).write.mode("overwrite").parquet(folder)
        folders.append(folder)
    if sentinel is not None:
        spark = df.sparkSession
        row = {c: None for c in data.columns}
        row.update(sentinel)
        row[time_col] = None
        s = (spark.createDataFrame([tuple(row[c] for c in data.columns)], data.schema)
             .withColumn(time_col, F.lit(SENTINEL_TIME).cast("timestamp")))
        folder = os.path.join(path, f"{n_files:05d}")
        s.coalesce(1).write.mode("overwrite").parquet(folder)
        folders.append(folder)
    return folders


def drop_sentinel(df: DataFrame, col: str) -> DataFrame:
    """Remove rows or windows produced by the sentinel (time column or window bound)."""
    return df.filter(F.col(col) < F.lit(SENTINEL_TIME).cast("timestamp"))
