"""Event time and watermarks.

Spark keeps one watermark per query: the highest event time seen so far minus
the allowed delay, advanced between micro-batches.  Rows behind it are
dropped by stateful operators (and counted in ``numRowsDroppedByWatermark``);
Spark applies the watermark of the previous batch, so a late row is dropped
only once a later batch has moved the watermark past its window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.intervals import spark_interval


def with_event_time(df: DataFrame, col: str, delay: str | int = "0 seconds") -> DataFrame:
    """Use ``col`` as event time with bounded out-of-orderness ``delay``.

    ``delay=0`` is the ascending-timestamps case; ``"2 seconds"`` the bounded
    out-of-order case; a periodic "highest seen minus 3 s" is ``"3 seconds"``.
    ``timestamp_ntz`` columns are cast to ``timestamp`` (the session zone is
    UTC, so wall-clock values are kept).
    """
    dtype = dict(df.dtypes)[col]
    if dtype != "timestamp":
        df = df.withColumn(col, F.col(col).cast("timestamp"))
    return df.withWatermark(col, spark_interval(delay))


def dropped_by_watermark(progress: list[dict]) -> int:
    """Total rows dropped as late, from a query's ``recentProgress``."""
    n = 0
    for p in progress:
        for op in p.get("stateOperators", []):
            n += int(op.get("numRowsDroppedByWatermark", 0))
    return n
