"""Replay of a table as a stream, in event-time order, closed at its end.

``write_replay`` writes a table as files that follow each other in time: one range
partitioning by the order columns, each range a sorted file, and modification
times in the order of the ranges, which is the order in which a file stream reads
them.  The number of files may grow with the data; ``replay_stream`` reads a fixed
share of them per micro-batch.

A bounded stream ends with open windows: its watermark never passes the last rows.
``closing`` adds a last file with one row, later than every other by ``reach`` (the
longest window plus the allowed delay), which moves the watermark past all of them.
The row carries a marker column (``CLOSING``); pass filters with ``or_closing``, as
Catalyst moves filters below the watermark, and drop what the row leaves behind
with ``without_closing``.  Its own windows never close, so append-mode aggregates
do not show it.
"""

from __future__ import annotations

import math
import re
import time as clock
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.intervals import spark_interval

CLOSING = "_tp_closing"


def or_closing(condition: Column) -> Column:
    """A filter that lets the closing row pass."""
    return condition | F.col(CLOSING)


def without_closing(df: DataFrame) -> DataFrame:
    """Rows without the closing row and without the marker column."""
    return df.filter(~F.col(CLOSING)).drop(CLOSING)


def _set_order(spark: SparkSession, folders: Sequence[str]) -> int:
    """Give the folders' files modification times a second apart, in order of folder and part number."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = []
    for folder in folders:
        path = hadoop.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        parts = []
        for status in fs.listStatus(path):
            m = re.match(r"part-(\d+)", status.getPath().getName())
            if m:
                parts.append((int(m[1]), status.getPath()))
        found += [(fs, p) for _, p in sorted(parts, key=lambda x: x[0])]
    first = (int(clock.time()) - len(found) - 1) * 1000
    for i, (fs, p) in enumerate(found):
        fs.setTimes(p, first + 1000 * i, -1)
    return len(found)


def write_replay(df: DataFrame, folder: str, order: Sequence[str], files: int, time: str | None = None,
                 reach: str | int = 0, closing: Mapping[str, Column] | None = None) -> int:
    """Write ``df`` below ``folder`` as files in ``order``; returns their number.

    ``files`` is the number of ranges (an empty range gives no file).  ``time``
    names the event-time column; it is cast to ``timestamp``.  With ``closing`` (the
    values of the closing row that matter, by column; the rest is null) a last file
    holds a row ``reach`` after the latest time.  The file system must keep
    modification times (HDFS and local ones do).
    """
    spark = df.sparkSession
    if time:
        df = df.withColumn(time, F.col(time).cast("timestamp"))
    rows = df.withColumn(CLOSING, F.lit(False))
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(f"{folder}/rows")
    folders = [f"{folder}/rows"]
    if closing is not None:
        last = spark.read.schema(rows.schema).parquet(folders[0]).agg(
            (F.max(time) + F.expr(f"INTERVAL {spark_interval(reach)}")).alias("_tp_last")).filter("_tp_last is not null")
        value = {time: F.col("_tp_last"), CLOSING: F.lit(True), **closing}
        (last.select(*[value.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])
         .write.parquet(f"{folder}/closing"))
        folders.append(f"{folder}/closing")
    return _set_order(spark, folders)


def replay_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Read the parquet files below ``path`` as a stream, oldest first."""
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true")
            .parquet(path))


def replay(df: DataFrame, folder: str, order: Sequence[str], batches: int, files: int, time: str | None = None,
           reach: str | int = 0, closing: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` as a stream of at least ``batches`` micro-batches in ``order`` (if it has as many rows), see ``write_replay``.

    The closing row, if any, has the last micro-batch or shares it with the last
    files.  The result has the marker column.
    """
    spark = df.sparkSession
    n = write_replay(df, folder, order, max(files, batches), time, reach, closing)
    schema = (df.withColumn(time, F.col(time).cast("timestamp")) if time else df).withColumn(CLOSING, F.lit(False)).schema
    return replay_stream(spark, folder, schema, max(1, math.floor(n / batches)))
