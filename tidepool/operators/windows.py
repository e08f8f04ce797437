"""Time windows: tumbling, sliding (by panes), sessions.

Windows are aligned to the epoch like the reference's assigners (offset 0).
All of them work on batch and streaming DataFrames; on streams add
``withWatermark`` first (see ``tidepool.streaming.watermarks``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.intervals import millis, spark_interval

_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def tumbling(df: DataFrame, time: str, size: str | int, keys: Sequence[str],
             aggs: Sequence[Column]) -> DataFrame:
    """Aggregate per key and tumbling window ``[start, start + size)``."""
    return (df.groupBy(*keys, F.window(time, spark_interval(size)).alias("window"))
            .agg(*aggs))


def sliding(df: DataFrame, time: str, size: str | int, slide: str | int, keys: Sequence[str],
            measures: Mapping[str, tuple[str, Column | str]]) -> DataFrame:
    """Sliding windows of any size and slide, by panes.

    Rows are first aggregated per pane of ``gcd(size, slide)``; only the pane
    aggregates are copied to the windows that hold them, so a row is written
    once however many windows overlap.  ``measures`` maps an output name to
    ``(kind, expr)`` with kind one of ``sum``, ``count``, ``min``, ``max`` (any
    measure that merges).  Output: ``keys``, ``window_start``, ``window_end``,
    measures; only windows that hold a row.

    On a stream the second aggregation is a window over the panes' own time, so
    its windows close by the same watermark (append mode).
    """
    size_ms, slide_ms = millis(size), millis(slide)
    pane_ms = gcd(size_ms, slide_ms)
    parts = []
    for name, (kind, expr) in measures.items():
        c = F.col(expr) if isinstance(expr, str) else expr
        parts.append(_PARTIAL[kind](c).alias(name))
    merge = [_MERGE[kind](name).alias(name) for name, (kind, _) in measures.items()]
    panes = df.groupBy(*keys, F.window(time, spark_interval(pane_ms)).alias("_pane")).agg(*parts)
    if df.isStreaming:
        # the pane's own time is its last instant, so it falls into the windows that hold the pane
        out = panes.groupBy(*keys, F.window(F.window_time("_pane"), spark_interval(size_ms),
                                            spark_interval(slide_ms)).alias("_w")).agg(*merge)
        return out.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                          *measures)
    dtype = panes.schema["_pane"].dataType["start"].dataType.simpleString()
    start_ms = F.unix_millis(F.col("_pane.start").cast("timestamp"))
    # window starts are the multiples of slide in (pane end - size, pane start]
    last = F.floor(start_ms / slide_ms).cast("long")
    first = F.floor((start_ms + pane_ms - size_ms + slide_ms - 1) / slide_ms).cast("long")
    spread = panes.filter(first <= last).withColumn("_at", F.explode(F.sequence(first, last)))
    spread = spread.withColumn("_at", F.col("_at") * slide_ms)
    back = lambda ms: F.timestamp_millis(ms).cast(dtype)
    return (spread.groupBy(*keys, "_at").agg(*merge)
            .select(*keys, back(F.col("_at")).alias("window_start"), back(F.col("_at") + size_ms).alias("window_end"),
                    *measures))


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap: str | int,
             aggs: Sequence[Column]) -> DataFrame:
    """Session windows per key: a gap of more than ``gap`` starts a new session.

    Rows exactly ``gap`` apart share a session (windows ``[t, t+gap)`` that
    touch are merged), as in the reference.  Session bounds are
    ``[first time, last time + gap)``.
    """
    return (df.groupBy(*keys, F.session_window(time, spark_interval(gap)).alias("session"))
            .agg(*aggs))


def split_sessions(df: DataFrame, keys: Sequence[str], time: str, gap: str | int,
                   measures: Mapping[str, tuple[str, Column | str]],
                   first: Mapping[str, str] | None = None, order: Sequence[str] = (),
                   block_unit: str = "hour") -> DataFrame:
    """Session windows per key, split by time blocks so a hot key is not one task.

    Same result as ``sessions`` (batch only).  ``session_window`` alone sends
    all rows of a key to one task.  Here sessions are first merged per
    ``(key, date_trunc(block_unit, time))``; a per-block table (small) then
    finds, with windows over a key's blocks, which block-first partial session
    continues the previous block's last session and from which start; partial
    results are merged per ``(key, session start)`` with partial aggregation.

    ``measures`` maps output names to ``(kind, expr)`` with kind ``sum``,
    ``count``, ``min`` or ``max``; ``first`` maps output names to columns
    taken from the session's first row in ``order`` (default ``time``).
    Output: ``keys``, ``session`` (start, end), measures, first fields.
    """
    keys = list(keys)
    first = dict(first or {})
    okey = F.struct(*(list(order) or [time]))
    blk = "_tp_sblk"
    parts = [_PARTIAL[kind](F.col(e) if isinstance(e, str) else e).alias(n)
             for n, (kind, e) in measures.items()]
    parts += [F.min_by(F.col(c), okey).alias(n) for n, c in first.items()]
    parts += [F.min(okey).alias("_tp_fkey")]
    p = (df.withColumn(blk, F.date_trunc(block_unit, F.col(time)))
         .groupBy(*keys, blk, F.session_window(time, spark_interval(gap)).alias("_tp_sw"))
         .agg(*parts)
         .withColumn("_tp_start", F.col("_tp_sw.start"))
         .withColumn("_tp_end", F.col("_tp_sw.end"))
         .drop("_tp_sw"))
    # one row per (key, block): does its first partial session continue the previous block's?
    bt = p.groupBy(*keys, blk).agg(F.min("_tp_start").alias("_tp_first"),
                                   F.max("_tp_start").alias("_tp_last"),
                                   F.max("_tp_end").alias("_tp_bend"),
                                   F.count(F.lit(1)).alias("_tp_n"))
    wk = Window.partitionBy(*keys).orderBy(blk)
    cont = F.lag("_tp_bend").over(wk).isNotNull() & (F.col("_tp_first") <= F.lag("_tp_bend").over(wk))
    bt = bt.withColumn("_tp_cont", cont)
    # start of the session that the block's last partial session belongs to
    own = F.when((F.col("_tp_n") >= 2) | ~F.col("_tp_cont"), F.col("_tp_last"))
    bt = bt.withColumn("_tp_root", F.last(own, ignorenulls=True).over(
        wk.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    bt = bt.withColumn("_tp_prev_root", F.lag("_tp_root").over(wk))
    g = "_tp_g"
    bt = bt.select(F.struct(*keys, blk).alias(g), "_tp_cont", "_tp_first", "_tp_prev_root")
    j = p.withColumn(g, F.struct(*keys, blk)).join(bt, g, "left")
    sid = F.when(F.col("_tp_cont") & (F.col("_tp_start") == F.col("_tp_first")),
                 F.col("_tp_prev_root")).otherwise(F.col("_tp_start"))
    merged = j.withColumn("_tp_sid", sid).groupBy(*keys, "_tp_sid").agg(
        F.max("_tp_end").alias("_tp_end"),
        *[_MERGE[kind](n).alias(n) for n, (kind, _) in measures.items()],
        *[F.min_by(F.col(n), F.col("_tp_fkey")).alias(n) for n in first])
    return merged.select(
        *keys, F.struct(F.col("_tp_sid").alias("start"), F.col("_tp_end").alias("end")).alias("session"),
        *measures.keys(), *first.keys())


def processing_time(df: DataFrame, out: str = "proc_time") -> DataFrame:
    """Stamp each row with the current time (ingestion/processing-time windows).

    Constant within a micro-batch in Spark; results are not repeatable.
    """
    return df.withColumn(out, F.current_timestamp())
