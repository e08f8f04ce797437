"""Database sinks: append a DataFrame, or every micro-batch of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               driver: str | None = None, user: str | None = None,
               password: str | None = None, batch_size: int = 10_000,
               num_partitions: int | None = None) -> None:
    """Append (or overwrite) ``df`` into ``table``; each task uses its own connection.

    ``num_partitions`` caps concurrent connections (a coalesce, no shuffle).
    """
    w = df.coalesce(num_partitions) if num_partitions else df
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    for k, v in (("driver", driver), ("user", user), ("password", password)):
        if v is not None:
            opts[k] = v
    w.write.format("jdbc").options(**opts).mode(mode).save()


def stream_to_jdbc(df: DataFrame, checkpoint: str, url: str, table: str,
                   trigger: dict | None = None, **kw) -> StreamingQuery:
    """Write every micro-batch of a stream with ``write_jdbc`` (at-least-once)."""
    def each(batch: DataFrame, _epoch: int) -> None:
        write_jdbc(batch, url, table, mode="append", **kw)
    w = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
