"""Late rows as an output of their own.

A windowed aggregate drops rows whose window the watermark has passed and only
counts them.  ``split_late`` writes both kinds: per micro-batch, the rows whose
window is still open and those that came too late, each with the watermark that
held when it arrived.

The watermark of a micro-batch is the latest event time of the micro-batches
before it, less the delay, as Spark's own.  Each micro-batch records its latest
time in a folder beside the output, so a restarted query goes on with the same
watermark, and a micro-batch that is retried overwrites what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions.intervals import millis
from tidepool.streaming.runner import start


def split_late(df: DataFrame, time: str, size: str | int, delay: str | int, path: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Write ``df``'s rows to ``<path>/rows`` with ``window_end, watermark, is_late``, partitioned by micro-batch.

    ``size`` is the tumbling window that decides: a row is late if its window's end
    is not after the watermark.  Rows without a time are late to no window.
    ``read_split`` reads the two tables.
    """
    size_ms = millis(size)

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        marks = f"{path}/marks"
        # not F.window, which drops rows without a time
        ms = F.unix_millis(F.col(time).cast("timestamp"))
        end = F.timestamp_millis(ms - F.pmod(ms, F.lit(size_ms)) + size_ms)
        before = None
        if epoch:   # every earlier micro-batch has left its mark
            before = (spark.read.schema("latest timestamp, batch long").parquet(marks).filter(F.col("batch") < epoch)
                      .agg(F.max("latest")).first()[0])
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {millis(delay)} MILLISECONDS")
        out = (batch.withColumn("window_end", end).withColumn("watermark", mark)
               .withColumn("is_late", F.coalesce(F.col("window_end") <= F.col("watermark"), F.lit(False))))
        out.write.mode("overwrite").parquet(f"{path}/rows/batch={epoch}")
        (batch.agg(F.max(F.col(time).cast("timestamp")).alias("latest"))
         .write.mode("overwrite").parquet(f"{marks}/batch={epoch}"))

    return start(df, foreach_batch=each, checkpoint=checkpoint, trigger=trigger)


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The on-time and the late rows that ``split_late`` has written (with their ``batch``)."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.filter("not is_late"), rows.filter("is_late")
