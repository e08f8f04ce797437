"""User-defined aggregates with create, add, merge and result, and whole-window functions.

``user_aggregate`` runs an ``Aggregate`` per key (and window) with map-side
combination: every task folds its Arrow batches into one accumulator per key,
accumulators are exchanged once and merged in sorted order, so a key that holds a
third of all rows sends one accumulator per task and no task sees its rows.

``whole_window`` hands a body all rows of a key's window, without pre-aggregation:
for functions that cannot merge.  A window is then one task's work; bound it by
the window's size and the keys.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidepool.functions.intervals import spark_interval
from tidepool.operators.delta import group_starts, whole_groups

HELD = 10_000       # accumulators a task holds before it passes them on


class Aggregate(ABC):
    """An aggregate over the rows of a key.

    ``state`` and ``output`` are Spark schemas (``"total long, n long"``) whose
    fields an accumulator and a result hold as a dict.  ``merge`` must not depend
    on how rows were split.
    """

    state: str
    output: str

    @abstractmethod
    def create(self) -> dict[str, Any]:
        """An empty accumulator."""

    @abstractmethod
    def add(self, acc: dict[str, Any], rows: pa.Table) -> dict[str, Any]:
        """The accumulator with some of the key's rows added."""

    @abstractmethod
    def merge(self, a: dict[str, Any], b: dict[str, Any]) -> dict[str, Any]:
        """Two accumulators of a key as one."""

    @abstractmethod
    def result(self, acc: dict[str, Any]) -> dict[str, Any]:
        """The result of a key."""


def _windowed(df: DataFrame, keys: Sequence[str], time: str | None, size: str | int | None) -> tuple[DataFrame, list[str]]:
    if time is None:
        return df, list(keys)
    w = F.window(time, spark_interval(size))
    return (df.withColumn("_tp_w", w).withColumns({"window_start": F.col("_tp_w.start"), "window_end": F.col("_tp_w.end")})
            .drop("_tp_w")), [*keys, "window_start", "window_end"]


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    kind = dict(df.dtypes)
    return ", ".join(f"`{c}` {kind[c]}" for c in names)


def _arrow(df: DataFrame, fields: str) -> pa.StructType:
    """Arrow type of a struct with these fields (a Spark schema as text)."""
    return to_arrow_type(df.sparkSession.createDataFrame([], f"s struct<{fields}>").schema["s"].dataType)


def _out(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def user_aggregate(df: DataFrame, keys: Sequence[str], aggregate: Aggregate, values: Sequence[str],
                   time: str | None = None, size: str | int | None = None) -> DataFrame:
    """``keys`` (and ``window_start, window_end``) with the aggregate's output fields.

    ``values`` are the columns that ``add`` sees.  ``time`` and ``size`` make it a
    tumbling window.  Null keys are keys; an empty table gives no row.
    """
    df, by = _windowed(df, keys, time, size)
    acc_type, out_fields = _arrow(df, aggregate.state), list(_arrow(df, aggregate.output))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict] = {}
        schema = None

        def flush() -> pa.RecordBatch:
            rows = [dict(zip(by, k)) | {"acc": acc} for k, acc in held.items()]
            held.clear()
            return _out(rows, schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            if schema is None:
                schema = pa.schema([*(batch.schema.field(k) for k in by), pa.field("acc", acc_type)])
            table = pa.Table.from_batches([batch]).sort_by([(k, "ascending") for k in by])
            bounds = np.append(group_starts(table, by), table.num_rows)
            names = list(zip(*(table.column(k).take(pa.array(bounds[:-1])).to_pylist() for k in by)))
            rows = table.select(list(values))
            for name, a, b in zip(names, bounds, bounds[1:]):
                acc = held.get(name)
                held[name] = aggregate.add(aggregate.create() if acc is None else acc, rows.slice(a, b - a))
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, acc, schema, rows = None, None, None, []
        for batch in batches:
            if schema is None:
                schema = pa.schema([*(batch.schema.field(k) for k in by), *out_fields])
            accs = batch.column(len(by))
            for i, name in enumerate(zip(*(batch.column(j).to_pylist() for j in range(len(by))))):
                new = accs[i].as_py()
                if name == now:
                    acc = aggregate.merge(acc, new)
                    continue
                if acc is not None:
                    rows.append(dict(zip(by, now)) | aggregate.result(acc))
                now, acc = name, new
            if len(rows) >= HELD:
                yield _out(rows, schema)
                rows = []
        if acc is not None:
            rows.append(dict(zip(by, now)) | aggregate.result(acc))
        if rows:
            yield _out(rows, schema)

    keyed = _fields(df, by)
    accs = df.select(*by, *[c for c in values if c not in by]).mapInArrow(partial, f"{keyed}, acc struct<{aggregate.state}>")
    return (accs.repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(final, f"{keyed}, {aggregate.output}").select(*by, *[f.name for f in out_fields]))


def whole_window(df: DataFrame, keys: Sequence[str], time: str, size: str | int, values: Sequence[str],
                 body: Callable[[pa.Table], dict[str, Any]], output: str, order: Sequence[str] = ()) -> DataFrame:
    """``keys, window_start, window_end`` and the fields of ``body(rows)`` for every key's tumbling window.

    ``body`` gets the window's rows (columns ``values``) in ``order`` as an Arrow table.
    """
    df, by = _windowed(df, keys, time, size)
    out_fields = list(_arrow(df, output))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, by):
            schema = pa.schema([*(table.schema.field(k) for k in by), *out_fields])
            names = zip(*(table.column(k).take(pa.array(bounds[:-1])).to_pylist() for k in by))
            rows = table.select(list(values))
            yield _out([dict(zip(by, name)) | body(rows.slice(a, b - a))
                        for name, a, b in zip(names, bounds, bounds[1:])], schema)

    cols = list(dict.fromkeys([*by, *order, *values]))
    return (df.select(*cols).repartition(*by).sortWithinPartitions(*by, *order)
            .mapInArrow(run, f"{_fields(df, by)}, {output}"))


class TrimmedMean(Aggregate):
    """Mean without the lowest and highest ``percent`` % of the values, over a histogram of bins of width 1.

    The accumulator holds the counts of the bins that occur, so it merges exactly.
    Nulls and non-finite values are left out.
    """

    state = "bins array<long>, counts array<long>"
    output = "n long, trimmed_mean double"

    def __init__(self, percent: int = 10):
        self.percent = percent

    def create(self):
        return {"bins": [], "counts": []}

    def add(self, acc, rows):
        v = rows.column(0).cast(pa.float64()).to_numpy()
        bins, counts = np.unique(np.floor(v[np.isfinite(v)]).astype(np.int64), return_counts=True)
        return self.merge(acc, {"bins": bins, "counts": counts})

    def merge(self, a, b):
        both = np.concatenate([np.asarray(a["bins"], dtype=np.int64), np.asarray(b["bins"], dtype=np.int64)])
        n = np.concatenate([np.asarray(a["counts"], dtype=np.int64), np.asarray(b["counts"], dtype=np.int64)])
        bins, at = np.unique(both, return_inverse=True)
        counts = np.zeros(len(bins), dtype=np.int64)
        np.add.at(counts, at, n)
        return {"bins": bins, "counts": counts}

    def result(self, acc):
        bins, counts = np.asarray(acc["bins"], dtype=np.int64), np.asarray(acc["counts"], dtype=np.int64)
        n = int(counts.sum())
        if not n:
            return {"n": 0, "trimmed_mean": None}
        cut = n * self.percent // 100
        high = np.cumsum(counts)
        kept = np.maximum(0, np.minimum(high, n - cut) - np.maximum(high - counts, cut))
        total = int(kept.sum())
        return {"n": n, "trimmed_mean": int((bins * kept).sum()) / total if total else None}
