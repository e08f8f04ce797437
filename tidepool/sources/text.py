"""Line sources: text files (batch or stream) and unbounded line streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as one ``line`` column (batch, or a file stream)."""
    if stream:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.load(path)
    else:
        df = spark.read.text(path)
    return df.select(F.col("value").alias("line"))


def line_stream(spark: SparkSession, fmt: str = "socket", **options) -> DataFrame:
    """An unbounded stream of lines, as ``line``.

    ``fmt="socket"`` with ``host``/``port`` is the reference's text socket (a
    test/demo source in Spark: not fault tolerant).  Any other line format
    works the same, e.g. ``fmt="text", path=...`` or ``fmt="rate"`` for load.
    """
    r = spark.readStream.format(fmt)
    path = options.pop("path", None)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(path) if path else r.load()
    col = "value" if "value" in df.columns else df.columns[0]
    return df.select(F.col(col).cast("string").alias("line"))
