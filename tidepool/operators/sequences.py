"""Operators over a keyed, ordered sequence of rows.

All numbering goes through ``sequence_number`` (split by blocks, see
``tidepool.operators.sequence``).  Count windows, every-n averages and full
batches are then plain aggregations over derived group ids, combined
map-side, so one hot key does not end up in one task.

``delta_trigger_max`` is a left-to-right fold (each trigger depends on the
previous one): it streams each key's rows in order through one task, with memory
bounded by the eviction span.  ``delta.delta_trigger_split`` gives the same rows
with a key's rows walked in many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.intervals import millis
from tidepool.operators.sequence import Levels, block_offsets, sequence_number


def count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                 slide: int, value: str, blocks: Levels, seq: str = "fire_seq",
                 out: str = "window_sum", fields: Sequence[str] = ()) -> DataFrame:
    """Sliding count window: every ``slide`` rows of a key, sum the last ``size``.

    The window firing at the key's row ``f`` (``f`` a multiple of ``slide``)
    holds rows ``max(1, f - size + 1) .. f``.  ``fields`` are copied from the
    firing row.  The rows are exchanged once, by key and block: a frame gives the
    sum, and a marker row per block brings the rows before it and their last
    ``size - 1`` values, which are taken from at most ``size - 1`` rows per block
    and task.  Output: ``keys, fire_seq, window_sum, n_rows, fields``.
    """
    keys, fine = list(keys), [c for b in blocks for c in ([b] if isinstance(b, str) else b)]
    rows = df.select(*dict.fromkeys([*keys, *fine, *order, value, *fields])).withColumn("_tp_kind", F.lit(1).cast("long"))
    part = Window.partitionBy(*keys, *fine).orderBy("_tp_kind", *order)
    so_far = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frame = part.rowsBetween(-(size - 1), Window.currentRow)     # markers have no value
    if fine:
        levels = [[b] if isinstance(b, str) else list(b) for b in blocks]
        offsets = block_offsets(rows.groupBy(*keys, *fine).agg(F.sum("_tp_kind").alias("_tp_rows")), keys, levels, ("_tp_rows",))
        rows = rows.unionByName(offsets.select(*keys, *fine, F.coalesce("_tp_rows_off", F.lit(0)).alias("_tp_off"), F.lit(0).cast("long").alias("_tp_kind")),
                                allowMissingColumns=True)
        if size > 1:
            rows = rows.unionByName(_tails(df, keys, fine, order, size - 1, value), allowMissingColumns=True)
    rn = F.sum("_tp_kind").over(so_far)
    out_cols = {"_tp_rn": rn, "_tp_sum": F.sum(value).over(frame)}
    if fine:
        out_cols["_tp_off"] = F.first("_tp_off", ignorenulls=True).over(so_far)
        out_cols |= {"_tp_tail": F.first("_tp_tail", ignorenulls=True).over(so_far)} if size > 1 else {}
    rows = rows.withColumns(out_cols).filter(F.col("_tp_kind") == 1)
    rows = rows.withColumn(seq, F.col("_tp_rn") + F.col("_tp_off") if fine else F.col("_tp_rn"))
    rows = rows.filter(F.col(seq) % slide == 0)
    if fine and size > 1:   # the newest carried value comes first
        short = F.greatest(F.lit(size) - F.col("_tp_rn"), F.lit(0)).cast("int")
        more = F.aggregate(F.slice(F.coalesce("_tp_tail", F.array()), 1, short), F.lit(None).cast(dict(rows.dtypes)["_tp_sum"]),
                           lambda a, x: F.when(a.isNull(), x).when(x.isNull(), a).otherwise(a + x))
        rows = rows.withColumn("_tp_sum", F.when(F.col("_tp_sum").isNull(), more).when(more.isNull(), F.col("_tp_sum"))
                               .otherwise(F.col("_tp_sum") + more))
    return rows.select(*keys, seq, F.col("_tp_sum").alias(out), F.least(F.col(seq), F.lit(size)).cast("long").alias("n_rows"), *fields)


def _tails(df: DataFrame, keys: list[str], fine: list[str], order: Sequence[str], n: int, value: str) -> DataFrame:
    """Marker rows with the last ``n`` values before each block, newest first.

    A limit per block and task comes before the exchange; what a key's blocks carry
    is then put together from its block rows.
    """
    back = Window.partitionBy(*keys, *fine).orderBy(*[F.desc(c) for c in order])
    last = (df.select(*dict.fromkeys([*keys, *fine, *order, value])).withColumn("_tp_back", F.row_number().over(back))
            .filter(F.col("_tp_back") <= n))
    table = last.groupBy(*keys, *fine).agg(F.sort_array(F.collect_list(
        F.struct((-F.col("_tp_back")).alias("at"), F.col(value).alias("v")))).alias("_tp_last"))
    before = Window.partitionBy(*keys).orderBy(*fine).rowsBetween(-n, -1)
    carried = F.transform(F.flatten(F.collect_list("_tp_last").over(before)), lambda x: x["v"])
    return table.select(*keys, *fine, F.reverse(carried).alias("_tp_tail"), F.lit(0).cast("long").alias("_tp_kind"))


def every_n_average(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    n: int, blocks: Levels, out: str = "average",
                    group: str = "group_no") -> DataFrame:
    """Average of every ``n`` consecutive rows of a key, then start again.

    Integer values use truncating division (``div``), as the reference's long
    arithmetic does; the last, incomplete group gives no output.
    Output: ``keys, group_no (from 1), average``.
    """
    numbered = sequence_number(df, keys, order, blocks, "_tp_seq")
    grouped = numbered.withColumn(group, F.expr(f"(_tp_seq - 1) div {n} + 1"))
    agg = (grouped.groupBy(*keys, group)
           .agg(F.sum(value).alias("_tp_sum"), F.count(F.lit(1)).alias("_tp_n"))
           .filter(F.col("_tp_n") == n))
    integral = isinstance(dict(df.dtypes).get(value), str) and dict(df.dtypes)[value] in (
        "tinyint", "smallint", "int", "bigint")
    avg = F.expr(f"_tp_sum div {n}") if integral else F.col("_tp_sum") / n
    return agg.select(*keys, group, avg.alias(out))


def full_batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
                 blocks: Levels, batch: str = "batch_no", slot: str = "slot",
                 remainder: bool = False) -> DataFrame:
    """Rows in groups of exactly ``n`` per key, in order (the buffering sink).

    ``remainder=False`` keeps rows of complete groups (what the sink emits);
    ``remainder=True`` gives the rows still buffered (the carried state).
    The group size check is a window over ``(key, batch)``: at most ``n`` rows.
    """
    numbered = sequence_number(df, keys, order, blocks, "_tp_seq")
    b = numbered.withColumn(batch, F.expr(f"(_tp_seq - 1) div {n} + 1")).withColumn(
        slot, F.expr(f"(_tp_seq - 1) % {n} + 1"))
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, batch))
    b = b.withColumn("_tp_size", size)
    kept = b.filter(F.col("_tp_size") < n) if remainder else b.filter(F.col("_tp_size") == n)
    return kept.drop("_tp_size", "_tp_seq")


# ---------------------------------------------------------------------------
# Distance trigger with time eviction

def first_beyond(v: np.ndarray, mark, delta) -> np.ndarray:
    """First number of ``v`` (ascending) with ``v - mark > delta``, for each mark."""
    mark = np.asarray(mark)
    if v.dtype.kind == "i":  # exact, and without overflow
        top = np.iinfo(np.int64).max
        with np.errstate(over="ignore"):
            return np.searchsorted(v, np.where(mark > top - delta, top, mark + delta), side="right")
    k = np.searchsorted(v, mark + delta, side="right")
    while True:  # the sum and the difference may round differently
        down = (k > 0) & (v[np.maximum(k, 1) - 1] - mark > delta)
        up = (k < len(v)) & ~(v[np.minimum(k, len(v) - 1)] - mark > delta)
        if not (down.any() or up.any()):
            return k
        k = k - down + (up & ~down)


def arrow_positions(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a column, integers as integers, and which of them are usable (not null, finite)."""
    ok = col.is_valid().to_numpy()
    if pa.types.is_integer(col.type):
        return col.cast(pa.int64()).fill_null(0).to_numpy(), ok
    v = col.cast(pa.float64()).fill_null(np.nan).to_numpy()
    return v, ok & np.isfinite(v)


def records(pos: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of the running maxima of the usable positions."""
    at = np.flatnonzero(ok)
    p = pos[at]
    if len(p):
        top = np.maximum.accumulate(p)
        new = np.append(True, top[1:] > top[:-1])
        at, p = at[new], p[new]
    return at, p


_POS_TEXT = "_tp_pos"


def pandas_positions(s: pd.Series, integral: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions and which are usable; integers come as text (see ``delta_trigger_max``)."""
    ok = s.notna().to_numpy()
    if integral:
        return np.array([int(x) if o else 0 for x, o in zip(s, ok)], dtype=np.int64), ok
    v = s.to_numpy(dtype=np.float64, na_value=np.nan)
    return v, ok & np.isfinite(v)


def delta_walk(pos: np.ndarray, ok: np.ndarray, t_us: np.ndarray, meas: np.ndarray, first_new: int,
               mark, delta, keep_us: int) -> tuple[list[tuple[int, int]], int | float | None]:
    """Walk one key's rows (sorted by time) from ``first_new`` on.

    Rows before ``first_new`` are carried rows still inside the eviction span.
    Returns ``(fires, mark)``: ``fires`` holds ``(firing row, top row)`` index
    pairs.  The first row ever seen sets the mark; a row more than ``delta``
    past the mark fires and becomes the mark; the top row is the first row
    with the largest measure among rows up to the firing one whose time is
    after ``fire time - keep``.  A firing row exceeds every new row before it,
    so only running maxima are looked at.
    """
    at, v = records(pos[first_new:], ok[first_new:])
    if not len(v):
        return [], mark
    nxt = first_beyond(v, v, delta)
    meas = np.where(np.isnan(meas), -np.inf, meas)
    if mark is None:
        mark, i = v[0], int(nxt[0])
    else:
        i = int(first_beyond(v, mark, delta))
    fires = []
    while i < len(v):
        j, mark = first_new + int(at[i]), v[i]
        lo = int(np.searchsorted(t_us, t_us[j] - keep_us, side="right"))
        if lo <= j:  # an empty window after eviction emits nothing
            fires.append((j, lo + int(np.argmax(meas[lo:j + 1]))))
        i = int(nxt[i])
    return fires, mark.item() if isinstance(mark, np.generic) else mark


def keep_span(t_us: np.ndarray, keep_us: int) -> int:
    """Index of the first row that a later firing can still see."""
    return int(np.searchsorted(t_us, t_us[-1] - keep_us, side="right"))


def _fold_delta_trigger(batches, key: str, time: str, position: str, measure: str,
                        delta: float, keep_us: int, fire_cols: list[str],
                        fields: list[str], out_cols: list[str], integral: bool):
    """Stream sorted rows, carrying one key's mark and eviction span across batches."""
    carry: pd.DataFrame | None = None
    mark = None
    for pdf in batches:
        if pdf.empty:
            continue
        n_old = 0 if carry is None else len(carry)
        if n_old:
            pdf = pd.concat([carry, pdf], ignore_index=True)
        keys = pdf[key].to_numpy()
        t_us = pdf[time].to_numpy(dtype="datetime64[us]").astype(np.int64)
        pos, ok = pandas_positions(pdf[position], integral)
        meas = pdf[measure].to_numpy(dtype=np.float64, na_value=np.nan)
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(pdf)]
        out_idx: list[tuple[int, int]] = []
        for s, e in zip(starts, ends):
            carried = s == 0 and n_old > 0
            fires, m = delta_walk(pos[s:e], ok[s:e], t_us[s:e], meas[s:e], max(0, n_old - s),
                                  mark if carried else None, delta, keep_us)
            out_idx.extend((s + a, s + b) for a, b in fires)
            if e - s > max(0, n_old - s):
                mark = m
        if out_idx:
            fi = np.array([a for a, _ in out_idx])
            ti = np.array([b for _, b in out_idx])
            res = pd.DataFrame({key: keys[fi]})
            for c in fire_cols:
                res[f"fire_{c}"] = pdf[c].to_numpy()[fi]
            for c in fields:
                res[c] = pdf[c].to_numpy()[ti]
            yield res[out_cols]
        # keep the last key's rows that can still be inside a later frame
        last = starts[-1]
        carry = pdf.iloc[last + keep_span(t_us[last:], keep_us):].reset_index(drop=True)


def delta_trigger_max(df: DataFrame, key: str, time: str, order: Sequence[str],
                      position: str, measure: str, delta: float, keep: str | int,
                      fields: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Global window per key with a distance trigger, time eviction and max-by.

    Walking a key's rows in ``(time, order)``: the first row sets the mark; a
    row whose ``position`` is more than ``delta`` past the mark fires and
    becomes the mark.  At each firing, rows at or before ``fire time - keep``
    are evicted and the row with the largest ``measure`` among the rest (first
    one on ties) is emitted.  Output: ``key``, ``fire_<time>``,
    ``fire_<order...>``, then ``fields`` of the top row.
    """
    keep_us = millis(keep) * 1000
    fire_cols = [time, *order]
    fields = [f for f in fields if f != key]
    out_cols = [key, *[f"fire_{c}" for c in fire_cols], *fields]
    sch = {f.name: f.dataType for f in df.schema.fields}
    out_schema = T.StructType(
        [T.StructField(key, sch[key])]
        + [T.StructField(f"fire_{c}", sch[c]) for c in fire_cols]
        + [T.StructField(c, sch[c]) for c in fields])
    integral = isinstance(sch[position], T.IntegralType)
    delta = math.floor(delta) if integral else float(delta)
    need = list(dict.fromkeys([key, time, *order, position, measure, *fields]))
    src = df.select(*need)
    src = src.repartition(num_partitions, key) if num_partitions else src.repartition(key)
    src = src.sortWithinPartitions(key, time, *order)

    def run(batches):
        yield from _fold_delta_trigger(batches, key, time, _POS_TEXT, measure, delta,
                                       keep_us, fire_cols, fields, out_cols, integral)

    # a long column with nulls reaches pandas as rounded doubles, its text does not
    src = src.withColumn(_POS_TEXT, F.col(position).cast("string") if integral else F.col(position))
    return src.mapInPandas(run, out_schema)


def position_from(value: str | Column, scale: int = 100) -> Column:
    """Exact position units: ``round(value * scale)`` as a long (cents for scale 100)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.round(v * scale).cast("long")
