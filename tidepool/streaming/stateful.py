"""Keyed-state stream operators (``applyInPandasWithState``).

The state per key is small and bounded: a count and a sum, the last
``size - 1`` values, the rows inside the eviction span, or fewer than ``n``
buffered rows.  Keys are dealt to ``buckets`` by hash: a micro-batch makes one
Python call per bucket, which works on the rows of all its keys as arrays, so the
cost follows the rows and not the number of keys.  A bucket's state holds its
keys' states as Arrow bytes, which a call reads and writes whole: take more
buckets for small micro-batches over many keys.

Within a micro-batch a key's rows are processed in an explicit order (``order``
columns), across batches in batch order, which is the arrival order of a file or
topic stream.  State lives in the state store under the query checkpoint, so a
restarted query continues where it stopped.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tidepool.functions.intervals import millis
from tidepool.operators.sequences import delta_walk, keep_span

_VALUE = ["_tp_v", "_tp_ok"]     # see _number_columns
BUCKETS = 256       # Python calls of a micro-batch at most
_NULL = "_tp_null_"  # flag column of a column with integers: nulls would make it rounded doubles in pandas


def _trunc_div(a: np.ndarray, b: int) -> np.ndarray:
    """Integer division toward zero (``//`` floors)."""
    q = a // b
    return q + ((a < 0) & (q * b != a))


def _field(df: DataFrame, c: str) -> T.StructField:
    return next(f for f in df.schema.fields if f.name == c)


def _integral(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in dict.fromkeys(columns) if c != "_tp_v" and isinstance(_field(df, c).dataType, T.IntegralType)]


def _bucketed(df: DataFrame, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """The columns in use and ``_tp_bucket``; integers with nulls as 0 and a flag.

    The null key has a bucket of its own (-1).  Other columns do not travel to Python.
    """
    whole = _integral(df, [key, *columns])
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(dict(df.dtypes)[c])).alias(c) for c in whole}
    bucket = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    return df.select(bucket.alias("_tp_bucket"), *[zero.get(c, F.col(c)) for c in dict.fromkeys([key, *columns])],
                     *[F.col(c).isNull().alias(_NULL + c) for c in whole])


def _codes(s: pd.Series) -> np.ndarray:
    """Numbers that sort like the values, nulls last."""
    if s.dtype.kind in "iufbmM":
        return s.to_numpy()
    codes, seen = pd.factorize(s, sort=True)
    return np.where(codes < 0, len(seen), codes)


def _number_columns(df: DataFrame, value: str) -> DataFrame:
    """``_tp_v`` (nulls as 0) and ``_tp_ok``: a long column with nulls would reach pandas as rounded doubles."""
    v = F.col(value)
    return df.withColumns({"_tp_v": F.coalesce(v, F.lit(0).cast(dict(df.dtypes)[value])), "_tp_ok": v.isNotNull()})


class _Rows:
    """A bucket's rows of a micro-batch behind its carried rows, by key and order; the keys as numbers.

    ``frame`` has the ``columns`` only.  ``keys`` are the carried keys in the order of their state, then the new ones;
    ``code`` is each row's key and ``lo`` and ``hi`` are a key's first row and the end.
    """

    def __init__(self, pdfs, key: str, order: Sequence[str], columns: Sequence[str], known: pd.DataFrame | None,
                 held: pd.DataFrame | None = None):
        frames = [p for p in pdfs if len(p)]
        new = pd.concat(frames, ignore_index=True) if frames else None
        self.found = new is not None
        if new is None:
            return
        n_known = 0 if known is None else len(known)
        keys = pd.concat([known["key"], new[key]], ignore_index=True) if n_known else new[key]
        code, distinct = pd.factorize(keys, use_na_sentinel=False)
        self.keys, self.n_known, code = pd.Series(distinct), n_known, code[n_known:]
        sort = [c for o in order for c in ([_NULL + o, o] if _NULL + o in new else [o])]
        at = np.lexsort([*[_codes(new[c]) for c in reversed(sort)], code])
        new, code = new[[c for f in columns for c in (f, _NULL + f) if c in new]].iloc[at], code[at]
        n_held = 0 if held is None else len(held)
        if n_held:      # a key's carried rows come before its new ones
            both = np.concatenate([held["_tp_code"].to_numpy(), code])
            at = np.argsort(both, kind="stable")
            new, code = pd.concat([held[list(new.columns)], new], ignore_index=True).iloc[at], both[at]
            self.is_new = at >= n_held
        else:
            self.is_new = np.ones(len(code), dtype=bool)
        self.frame, self.code = new.reset_index(drop=True), code
        self.lo = np.searchsorted(code, np.arange(len(self.keys)))
        self.hi = np.append(self.lo[1:], len(code))
        self.place = np.arange(len(code)) - self.lo[code]       # a row's place among its key's

    def carried(self, known: pd.DataFrame | None, column: str, dtype=np.int64) -> np.ndarray:
        """A number of every key's state, 0 for new keys."""
        return np.concatenate([*([known[column].to_numpy(dtype)] if self.n_known else []),
                               np.zeros(len(self.keys) - self.n_known, dtype)])

    def key_column(self, at: np.ndarray, bucket: int) -> pd.Series:
        """The keys of some codes; null in the bucket of the null key."""
        return pd.Series([None] * len(at), dtype=object) if bucket < 0 else self.keys.iloc[at].reset_index(drop=True)

    def fields(self, fields: Sequence[str], at: np.ndarray) -> dict[str, pd.Series]:
        """Columns of some rows, integers with their nulls."""
        rows = self.frame.iloc[at].reset_index(drop=True)
        return {c: pd.Series(pd.arrays.IntegerArray(rows[c].to_numpy(np.int64), rows[_NULL + c].to_numpy(dtype=bool)))
                if _NULL + c in rows else rows[c] for c in fields}


def _to_ipc(pdf: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_ipc(buf: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(buf)).read_all().to_pandas()


_STATE = T.StructType([T.StructField("keys", T.BinaryType()), T.StructField("rows", T.BinaryType())])


def _load(state) -> tuple[pd.DataFrame | None, pd.DataFrame | None]:
    """A bucket's keys with their numbers, and the rows they carry (``_tp_code``: number of the key)."""
    return tuple(None if b is None else _from_ipc(bytes(b)) for b in (state.get if state.exists else (None, None)))


def _store(state, rows: _Rows, numbers: dict, held: pd.DataFrame | None = None) -> None:
    known = pd.DataFrame({"key": rows.keys, **numbers})
    state.update((_to_ipc(known), _to_ipc(held) if held is not None and len(held) else None))


def _keyed(df: DataFrame, step, out_schema: T.StructType) -> DataFrame:
    return df.groupBy("_tp_bucket").applyInPandasWithState(
        step, out_schema, _STATE, "append", GroupStateTimeout.NoTimeout)


def every_n_average_stream(df: DataFrame, key: str, order: Sequence[str], value: str,
                           n: int, out: str = "average", buckets: int = BUCKETS) -> DataFrame:
    """Every ``n`` rows of a key: emit the truncated average and reset (long values).

    As in the batch form nulls count as rows and not in the sum; a group of nulls
    only has a null average.
    """
    out_schema = T.StructType([_field(df, key), T.StructField(out, T.LongType())])
    order = list(order)

    def step(k, pdfs, state):
        known, _ = _load(state)
        rows = _Rows(pdfs, key, order, _VALUE, known)
        if not rows.found:
            return
        count = rows.carried(known, "count")
        v, ok = rows.frame["_tp_v"].to_numpy(dtype=np.int64), rows.frame["_tp_ok"].to_numpy(dtype=bool)
        total = count + (rows.hi - rows.lo)
        last = np.cumsum(total // n + 1) - 1                # each key's groups, the open one last
        first = last - total // n                           # the first one continues the carried group
        group = first[rows.code] + (count[rows.code] + rows.place) // n
        sums, seen = np.zeros(last[-1] + 1, dtype=np.int64), np.zeros(last[-1] + 1, dtype=np.int64)
        np.add.at(sums, group, np.where(ok, v, 0))
        np.add.at(seen, group, ok)
        sums[first] += rows.carried(known, "sum")
        seen[first] += rows.carried(known, "known")
        full = np.ones(len(sums), dtype=bool)
        full[last] = False
        if full.any():
            yield pd.DataFrame({key: rows.key_column(np.repeat(np.arange(len(last)), total // n), k[0]),
                                out: pd.arrays.IntegerArray(_trunc_div(sums[full], n), seen[full] == 0)})
        _store(state, rows, {"count": total % n, "sum": sums[last], "known": seen[last]})

    numbered = _bucketed(_number_columns(df, value), key, [*order, *_VALUE], buckets)
    return _keyed(numbered, step, out_schema)


def count_window_stream(df: DataFrame, key: str, order: Sequence[str], size: int, slide: int,
                        value: str, out: str = "window_sum", buckets: int = BUCKETS) -> DataFrame:
    """Every ``slide`` rows of a key, the sum of its last ``size`` values (nulls skipped)."""
    vtype = _field(df, value).dataType
    integral = isinstance(vtype, T.IntegralType)
    out_schema = T.StructType([_field(df, key), T.StructField("fire_seq", T.LongType()),
                               T.StructField(out, vtype), T.StructField("n_rows", T.LongType())])
    order, number = list(order), np.int64 if integral else np.float64

    def step(k, pdfs, state):
        known, held = _load(state)
        rows = _Rows(pdfs, key, order, _VALUE, known, held)
        if not rows.found:
            return
        v, ok = rows.frame["_tp_v"].to_numpy(dtype=number), rows.frame["_tp_ok"].to_numpy(dtype=bool)
        count = rows.carried(known, "count")
        fresh = np.bincount(rows.code[rows.is_new], minlength=len(count))
        seqs = count[rows.code] + rows.place - (rows.hi - rows.lo - fresh)[rows.code] + 1    # position of each new row
        fire = np.flatnonzero(rows.is_new & (seqs % slide == 0))
        if len(fire):
            at = fire[:, None] - np.arange(size)[None, ::-1]  # each window by itself: no digits lost in long sums
            held_at = (at >= rows.lo[rows.code[fire]][:, None]) & ok[np.maximum(at, 0)]
            sums = np.where(held_at, v[np.maximum(at, 0)], 0).sum(axis=1)
            total = pd.array(sums, dtype="Int64" if integral else "Float64")
            total[~held_at.any(axis=1)] = pd.NA
            yield pd.DataFrame({key: rows.key_column(rows.code[fire], k[0]), "fire_seq": seqs[fire], out: total,
                                "n_rows": np.minimum(seqs[fire], size)})
        rest = rows.place >= (rows.hi - rows.lo)[rows.code] - (size - 1)
        _store(state, rows, {"count": count + fresh},
               rows.frame[rest].assign(_tp_code=rows.code[rest]))

    numbered = _bucketed(_number_columns(df, value), key, [*order, *_VALUE], buckets)
    return _keyed(numbered, step, out_schema)


def buffered_stream(df: DataFrame, key: str, order: Sequence[str], n: int,
                    fields: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The buffering sink's state: emit a key's rows in complete groups of ``n``.

    Fewer than ``n`` rows per key stay in state (as Arrow IPC bytes, exact for
    every column type).  Output: ``key, batch_no, slot, fields``.
    """
    fields = [f for f in fields if f != key]
    out_schema = T.StructType([_field(df, key), T.StructField("batch_no", T.LongType()),
                               T.StructField("slot", T.LongType())]
                              + [_field(df, f) for f in fields])
    order = list(order)

    def step(k, pdfs, state):
        known, held = _load(state)
        rows = _Rows(pdfs, key, order, fields, known, held)
        if not rows.found:
            return
        emitted = rows.carried(known, "emitted")
        full = (rows.hi - rows.lo) // n
        goes = rows.place < (full * n)[rows.code]
        if goes.any():
            at = np.flatnonzero(goes)
            code, place = rows.code[at], rows.place[at]
            yield pd.DataFrame({key: rows.key_column(code, k[0]), "batch_no": emitted[code] + place // n + 1,
                                "slot": place % n + 1, **rows.fields(fields, at)})
        _store(state, rows, {"emitted": emitted + full}, rows.frame[~goes].assign(_tp_code=rows.code[~goes]))

    return _keyed(_bucketed(df, key, [*order, *fields], buckets), step, out_schema)


def delta_trigger_stream(df: DataFrame, key: str, time: str, order: Sequence[str],
                         position: str, measure: str, delta: float, keep: str | int,
                         fields: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Stream form of ``delta_trigger_max``: mark and eviction span kept in state.

    Output: ``key``, ``fire_<time>``, ``fire_<order...>``, then ``fields`` of the top
    row.  The rows of the span are kept as Arrow bytes, exact for every column type;
    integer positions and marks stay integers.
    """
    keep_us = millis(keep) * 1000
    fields = [f for f in fields if f != key]
    integral = isinstance(_field(df, position).dataType, T.IntegralType)
    delta = math.floor(delta) if integral else float(delta)
    number = np.int64 if integral else np.float64
    fire_cols = [time, *order]
    need = list(dict.fromkeys([*fire_cols, measure, *fields, *_VALUE]))
    out_schema = T.StructType([_field(df, key)]
                              + [T.StructField(f"fire_{c}", _field(df, c).dataType) for c in fire_cols]
                              + [_field(df, f) for f in fields])

    def step(k, pdfs, state):
        known, held = _load(state)
        rows = _Rows(pdfs, key, fire_cols, need, known, held)
        if not rows.found:
            return
        t_us = rows.frame[time].to_numpy(dtype="datetime64[us]").astype(np.int64)
        pos, ok = rows.frame["_tp_v"].to_numpy(number), rows.frame["_tp_ok"].to_numpy(dtype=bool)
        ok = ok if integral else ok & np.isfinite(pos)
        meas = rows.frame[measure].to_numpy(np.float64, na_value=np.nan)
        if _NULL + measure in rows.frame:
            meas[rows.frame[_NULL + measure].to_numpy(dtype=bool)] = np.nan
        marked, mark = rows.carried(known, "marked", bool), rows.carried(known, "mark", number)
        fresh = np.bincount(rows.code[rows.is_new], minlength=len(mark))
        fires, stays = [], np.ones(len(t_us), dtype=bool)
        for i in np.flatnonzero(fresh):
            a, b = rows.lo[i], rows.hi[i]
            found, now = delta_walk(pos[a:b], ok[a:b], t_us[a:b], meas[a:b], b - a - fresh[i],
                                    mark[i] if marked[i] else None, delta, keep_us)
            fires += [(a + f, a + top, i) for f, top in found]
            if now is not None:
                marked[i], mark[i] = True, now
            stays[a:a + keep_span(t_us[a:b], keep_us)] = False
        _store(state, rows, {"marked": marked, "mark": mark}, rows.frame[stays].assign(_tp_code=rows.code[stays]))
        if fires:
            fi, ti, code = np.array(fires).T
            fired = {f"fire_{c}": v for c, v in rows.fields(fire_cols, fi).items()}
            yield pd.DataFrame({key: rows.key_column(code, k[0]), **fired, **rows.fields(fields, ti)})

    return _keyed(_bucketed(_number_columns(df, position), key, need, buckets), step, out_schema)
