"""Hot items: views per item over long sliding windows, top N per window end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.topn import top_n
from tidepool.operators.windows import sliding


def item_view_counts(df: DataFrame, time: str, item: str, size: str, slide: str,
                     behavior_col: str | None = None, behavior: str | None = None) -> DataFrame:
    """``(item_id, window_end, view_count)`` per item and sliding window.

    The filter goes before the exchange (pushed into the scan by Catalyst);
    windows are built from panes, on batches and on streams.
    """
    if behavior_col is not None:
        df = df.filter(F.col(behavior_col) == behavior)
    df = df.select(F.col(item).alias("item_id"), time)
    return sliding(df, time, size, slide, ["item_id"],
                   {"view_count": ("count", F.lit(1))}).drop("window_start")


def hot_items(df: DataFrame, time: str, item: str, size: str = "60 minutes",
              slide: str = "5 seconds", n: int = 5, behavior_col: str | None = None,
              behavior: str | None = None) -> DataFrame:
    """Top ``n`` items per window end by view count, ties by item id.

    Output: ``window_end, rank, item_id, view_count`` with rank from 1.
    """
    counts = item_view_counts(df, time, item, size, slide, behavior_col, behavior)
    ranked = top_n(counts, ["window_end"], [F.desc("view_count"), F.asc("item_id")], n)
    return ranked.select("window_end", "rank", "item_id", "view_count")
