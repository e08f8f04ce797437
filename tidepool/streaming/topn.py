"""Top N per window on a stream.

``row_number`` is refused on streaming DataFrames.  Windowed counts in append
mode are emitted once, when the watermark closes their window, so every
micro-batch holds complete windows: the batch ``top_n`` (with its partial
``WindowGroupLimit``) runs on each micro-batch in ``foreachBatch`` and the
result is appended to a table folder.  This is the reference's keyed process
function with list state and a timer at window end + 1, without user state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.topn import top_n
from tidepool.streaming.runner import start


def stream_top_n(counts: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int,
                 path: str, checkpoint: str, trigger: dict | None = None,
                 fmt: str = "parquet") -> StreamingQuery:
    """Append the top ``n`` rows of every closed group of ``counts`` to ``path``.

    ``counts`` must be an append-mode windowed aggregation (with a watermark).
    Each micro-batch writes its own folder ``<path>/batch=<id>`` and overwrites
    it when it is retried, so every group appears once.
    """
    def each(batch: DataFrame, epoch: int) -> None:
        top_n(batch, group, order, n).write.mode("overwrite").format(fmt).save(f"{path}/batch={epoch}")

    return start(counts, output_mode="append", foreach_batch=each, checkpoint=checkpoint,
                 trigger=trigger)
