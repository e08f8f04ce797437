"""Top N per group.

``row_number() <= n`` over a window is rewritten by Catalyst into a partial
``WindowGroupLimit`` before the exchange, so each task ships at most ``n``
rows per group: a group with millions of candidates never lands whole in one
task.  Ties are broken by the full ``order`` (give it a unique tie-break).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: Sequence[str | Column], order: Sequence[str | Column],
          n: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group in ``order``; ``rank_col`` from 1."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def format_top_n(df: DataFrame, group: str, rank: str, item: str, count: str,
                 n: int, time_format: str = "yyyy-MM-dd HH:mm:ss.S") -> DataFrame:
    """One text block per group: a rule line, the time, one line per rank.

    Input has at most ``n`` rows per group (the output of ``top_n``), so the
    list gathered per group is bounded by ``n``.
    """
    rule = "=" * 36
    line = F.format_string("No%d:  item=%s  views=%s", F.col(rank), F.col(item), F.col(count))
    ranked = df.groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), line.alias("l")))).alias("_ls"))
    body = F.concat_ws("\n", F.transform("_ls", lambda x: x["l"]))
    # The time shown is the window end (the timer fires at end + 1 and prints time - 1).
    shown = F.date_format(F.col(group), time_format)
    return ranked.select(
        group,
        F.concat(F.lit(rule + "\ntime: "), shown, F.lit("\n"), body,
                 F.lit("\n" + rule + "\n\n")).alias("report"))
