"""Start, drain and stop streaming queries.

A query reads a source, transforms it with the same functions as the batch
form, and writes to a sink with a checkpoint folder under the shared
``spark.checkpoint.dir``, so a restarted query resumes from its offsets and
state.  ``drain`` runs everything available (``availableNow``) and returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start(df: DataFrame, *, output_mode: str = "append", checkpoint: str,
          sink: str | None = None, path: str | None = None, query_name: str | None = None,
          foreach_batch: Callable[[DataFrame, int], None] | None = None,
          trigger: dict | None = None, **options) -> StreamingQuery:
    """Start a streaming query on one sink: a format (``parquet``, ``memory``,
    ``console``, ``noop``, ...) or a ``foreach_batch`` function."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink or "parquet")
    if query_name:
        w = w.queryName(query_name)
    for k, v in options.items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path) if path else w.start()


def rows_per_batch(query: StreamingQuery) -> list[int]:
    """Input rows of the micro-batches of a drained query that had any."""
    return [n for n in (int(p["numInputRows"]) for p in query.recentProgress) if n]


def drain(query: StreamingQuery, timeout_s: int = 600) -> StreamingQuery:
    """Wait until an ``availableNow`` query has processed everything, then stop it."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
