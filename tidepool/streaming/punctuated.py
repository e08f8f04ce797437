"""Punctuated watermarks: the watermark moves only on marker rows.

Spark keeps one watermark per streaming query, derived from the highest event
time seen; it has no per-row watermark hook.  This module gives the batch
form over a recorded, arrival-ordered sequence (e.g. lines with their
offsets): the watermark before each row is the highest marker time among the
rows that arrived earlier; a row whose window is already closed by then is
late and dropped; a window is emitted only once some marker has closed it
(``window end - tick <= marker time``, tick 1 ms).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.intervals import spark_interval
from tidepool.operators.sequence import running_max

MARKER_PREFIX = "punctuated_"


def parse_marked_lines(df: DataFrame, col: str, fields: Sequence[tuple[str, str]] = (),
                       time: str = "t_ms") -> DataFrame:
    """``[punctuated_]<t_ms>,<f1>,<f2>...`` lines: marker flag, time, typed fields.

    The time is read after removing the marker prefix (the reference's
    extractor could not parse its own marker rows).
    """
    c = F.col(col)
    marker = c.startswith(MARKER_PREFIX)
    body = F.when(marker, F.expr(f"substring({col}, {len(MARKER_PREFIX) + 1})")).otherwise(c)
    parts = F.split(body, ",")
    out = [F.col("*"), marker.alias("is_marker"),
           F.try_element_at(parts, F.lit(1)).try_cast("long").alias(time)]
    for i, (name, typ) in enumerate(fields):
        out.append(F.try_element_at(parts, F.lit(i + 2)).try_cast(typ).alias(name))
    return df.select(*out)


def punctuated_windows(df: DataFrame, seq: str, time: str, is_marker: str | Column,
                       keys: Sequence[str], size: str | int, aggs: Sequence[Column],
                       blocks: str | Sequence[str], emit_open: bool = False,
                       tick: str = "1 millisecond") -> DataFrame:
    """Tumbling windows under a punctuated watermark (batch form).

    ``seq`` is the arrival order, ``blocks`` columns monotone in it, from coarse to
    fine (e.g. ``seq div 2^30``, ``seq div 2^20``), that split the running maximum.
    Output: ``keys``,
    ``window`` and ``aggs``; only windows a marker closed, unless ``emit_open``.
    """
    m = F.col(is_marker) if isinstance(is_marker, str) else is_marker
    marked = df.withColumn("_tp_mark", F.when(m, F.col(time)))
    wm = running_max(marked, [], [seq], blocks, "_tp_mark", "_tp_wm_before", inclusive=False)
    last = F.col("window.end") - F.expr(f"INTERVAL {tick}")
    win = F.window(time, spark_interval(size))
    with_win = wm.withColumn("window", win)
    on_time = with_win.filter(F.col("_tp_wm_before").isNull()
                              | (F.col("_tp_wm_before") < last))
    out = on_time.groupBy(*keys, "window").agg(*aggs)
    if emit_open:
        return out
    return out.filter(last <= marked.agg(F.max("_tp_mark")).scalar())
