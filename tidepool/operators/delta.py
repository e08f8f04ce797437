"""Distance trigger with time eviction, exact and split into chunks of a key's rows.

``delta_trigger_max`` walks each key's rows in one task: every firing depends on
the mark left by the previous one.  Here a key's rows are numbered (split, see
``sequence``), cut into chunks of ``chunk_rows`` rows, and handled in parallel:

1. *Transfer table* of a chunk: the mark that leaves it for every mark that can
   enter.  From any mark the first firing is a running maximum of the position,
   and so are all later ones (a firing exceeds everything before it), so the
   table lists the running maxima where the exit changes; above the last one
   nothing fires and the exit is the entry.  A summary (largest measure, first
   row that has it, last time) goes with it.
2. *Entries*: one pass per key over its tables, one lookup per chunk, gives the
   true entry mark of every chunk.  No rounds, no guesses.
3. *Firings* of every chunk follow from its entry, with the best row of their span
   as far as the chunk holds it.
4. A firing whose span reaches back over earlier chunks is looked up among the
   summaries of its key: chunks covered whole answer from their summary, the one
   covered in part gets a request and answers with its own best row (5).

Rows are hash-partitioned and sorted by (key, chunk, number), and one
``mapInArrow`` walks all keys and chunks of a partition (``whole_groups``); a task
holds one chunk, or one summary per chunk of a key.  Steps 1, 2, 4 and 5 run only
where a key has more than one chunk.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.intervals import millis
from tidepool.operators.sequence import Levels, sequence_number
from tidepool.operators.sequences import arrow_positions, first_beyond, records
from tidepool.session import checkpoint_dir

_KEY, _SEQ, _CHUNK, _TIME, _POS, _MEAS, _FIRE, _TOP = (
    "_tp_key", "_tp_seq", "_tp_chunk", "_tp_time", "_tp_pos", "_tp_meas", "_tp_fire", "_tp_top")


def transfer(v: np.ndarray, delta) -> tuple[np.ndarray, np.ndarray]:
    """Breakpoints and exits of a chunk whose running maxima are ``v``.

    For an entry mark whose first firing is maximum ``i``, the exit is
    ``exits[searchsorted(breaks, v[i])]``; runs of equal exits are one break.
    """
    n = len(v)
    if not n:
        return v, v
    nxt = first_beyond(v, v, delta)
    last = np.append(np.where(nxt == n, np.arange(n), nxt), n)   # pointer to a later firing
    while True:
        jump = last[last]
        if (jump == last).all():
            break
        last = jump
    exits = v[last[:n]]
    end = np.append(exits[1:] != exits[:-1], True)               # last maximum of a run of exits
    return v[end], exits[end]


def leave(mark, breaks: np.ndarray, exits: np.ndarray, delta):
    """Exit mark of a chunk for an entry mark."""
    k = int(first_beyond(breaks, mark, delta)) if len(breaks) else 0
    return mark if k == len(breaks) else exits[k]


# --- walking sorted partitions ---------------------------------------------------

def group_starts(table: pa.Table, by: Sequence[str]) -> np.ndarray:
    """Rows of a sorted table at which a new group of ``by`` starts (nulls are equal)."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for c in by:
        codes = table.column(c).combine_chunks().dictionary_encode("encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], by: Sequence[str],
                 least: int = 1 << 16) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches as tables of whole groups, about ``least`` rows each, with the groups' bounds."""
    held, n, enough = [], 0, least
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= enough:
            table = pa.Table.from_batches(held)
            at = group_starts(table, by)
            if at[-1]:
                yield table.slice(0, at[-1]), at
                table = table.slice(at[-1])
                enough = least
            held, n = table.to_batches(), table.num_rows
            enough = max(enough, 2 * n)      # a long group is looked at a few times only
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.append(group_starts(table, by), table.num_rows)


def _micros(table: pa.Table, col: str) -> np.ndarray:
    return table.column(col).cast(pa.timestamp("us", table.schema.field(col).type.tz)).cast(pa.int64()).to_numpy()


def _measures(table: pa.Table) -> np.ndarray:
    m = table.column(_MEAS).to_numpy().astype(np.float64)
    return np.where(np.isnan(m), -np.inf, m)


def _suffix_best(m: np.ndarray) -> np.ndarray:
    """For every row the first row from there on that has the largest measure."""
    top = np.maximum.accumulate(m[::-1])[::-1]
    return np.minimum.accumulate(np.where(m == top, np.arange(len(m)), len(m))[::-1])[::-1]


def _emit(schema: pa.Schema, **cols) -> Iterator[pa.RecordBatch]:
    arrays = [cols[f.name] if isinstance(cols[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(cols[f.name], f.type)
              for f in schema]
    yield from pa.Table.from_arrays(arrays, schema=schema).to_batches(max_chunksize=10_000)


class _Summaries:
    """Summaries of a key's chunks so far: which earlier chunks a span covers, and their best row."""

    def __init__(self):
        self.chunk, self.high = [], []
        self.at, self.best = [], []          # chunks no later one exceeds: falling best, for suffix maxima

    def add(self, chunk: int, high: int, best: float, row: int) -> None:
        while self.best and self.best[-1][0] < best:
            self.at.pop()
            self.best.pop()
        self.at.append(len(self.chunk))
        self.best.append((best, row))
        self.chunk.append(chunk)
        self.high.append(high)

    def cover(self, after: int) -> tuple[int | None, tuple[float, int] | None]:
        """Chunk that is covered in part by rows later than ``after``, and the best of the whole ones behind it."""
        i = bisect_right(self.high, after)
        if i == len(self.chunk):
            return None, None
        j = bisect_left(self.at, i + 1)
        return self.chunk[i], self.best[j] if j < len(self.best) else None


def delta_trigger_split(df: DataFrame, key: str, time: str, order: Sequence[str],
                        position: str, measure: str, delta: float, keep: str | int,
                        fields: Sequence[str], blocks: Levels = (), chunk_rows: int = 1 << 20,
                        seq: str | None = None) -> DataFrame:
    """Same result as ``delta_trigger_max``, with a key's rows walked in many tasks.

    ``seq`` names a column that numbers a key's rows by ``(time, order)`` from 1;
    without it they are numbered here, split by ``blocks`` (see
    ``running_totals``).  ``chunk_rows`` rows of a key form one chunk.  Output:
    ``key``, ``fire_<time>``, ``fire_<order...>``, then ``fields``.  Null keys are
    a key; a null position never fires, a null measure is the smallest.  Integer
    positions are compared exactly.
    """
    checkpoint_dir(df.sparkSession)
    keep_us = millis(keep) * 1000
    fields = [f for f in fields if f != key]
    fire_cols = [time, *order]
    sch = {f.name: f.dataType for f in df.schema.fields}
    integral = isinstance(sch[position], T.IntegralType)
    delta = math.floor(delta) if integral else float(delta)
    mark_type, mark_arrow = ("long", pa.int64()) if integral else ("double", pa.float64())

    if seq is None:
        df, seq = sequence_number(df, [key], [time, *order], blocks, _SEQ), _SEQ
    # a reliable checkpoint in the shared folder: the steps below re-read these rows
    rows = df.select(
        F.col(key).alias(_KEY), F.expr(f"(`{seq}` - 1) div {chunk_rows}").alias(_CHUNK), F.col(seq).cast("long").alias(_SEQ),
        F.col(time).alias(_TIME), F.col(position).cast(mark_type).alias(_POS), F.col(measure).cast("double").alias(_MEAS),
        F.struct(*fire_cols).alias(_FIRE), F.struct(*fields).alias(_TOP)).checkpoint()
    kinds = dict(rows.dtypes)
    split = not rows.filter(F.col(_CHUNK) > 0).isEmpty()

    def walk(d: DataFrame, by: Sequence[str], then: Sequence[str], schema: str,
             body: Callable[[pa.Table, np.ndarray, dict], Iterator[pa.RecordBatch]]) -> DataFrame:
        def run(batches):
            for table, bounds in whole_groups(batches, by):
                yield from body(table, bounds, {f.name: f.type for f in table.schema})
        return d.repartition(*by).sortWithinPartitions(*by, *then).mapInArrow(run, schema)

    # 1, 2: what enters each chunk
    table_schema = (f"{_KEY} {kinds[_KEY]}, {_CHUNK} long, breaks array<{mark_type}>, exits array<{mark_type}>, "
                    f"fresh {mark_type}, high_us long, best double, best_seq long, {_TOP} {kinds[_TOP]}")

    def tables(t: pa.Table, bounds: np.ndarray, types: dict) -> Iterator[pa.RecordBatch]:
        pos, ok = arrow_positions(t.column(_POS))
        us, m = _micros(t, _TIME), _measures(t)
        breaks, exits, fresh, top = [], [], [], []
        for a, b in zip(bounds, bounds[1:]):
            _, v = records(pos[a:b], ok[a:b])
            x, y = transfer(v, delta)
            breaks.append(x.tolist())
            exits.append(y.tolist())
            fresh.append(leave(v[0], x, y, delta) if len(v) else None)
            top.append(a + int(np.argmax(m[a:b])))
        first, last = pa.array(bounds[:-1]), bounds[1:] - 1
        schema = pa.schema([(_KEY, types[_KEY]), (_CHUNK, pa.int64()), ("breaks", pa.list_(mark_arrow)),
                            ("exits", pa.list_(mark_arrow)), ("fresh", mark_arrow), ("high_us", pa.int64()),
                            ("best", pa.float64()), ("best_seq", pa.int64()), (_TOP, types[_TOP])])
        yield from _emit(schema, **{
            _KEY: t.column(_KEY).take(first), _CHUNK: t.column(_CHUNK).take(first), "breaks": breaks, "exits": exits,
            "fresh": fresh, "high_us": us[last], "best": m[top], "best_seq": t.column(_SEQ).take(pa.array(top)),
            _TOP: t.column(_TOP).take(pa.array(top))})

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mark = None, None
        for batch in batches:
            out = []
            chunks, fresh = batch.column(1).to_pylist(), batch.column(4).to_pylist()
            for i, k in enumerate(batch.column(0).to_pylist()):
                if chunks[i] == 0 or k != now:
                    now, mark = k, None
                out.append(mark)
                if mark is None:
                    mark = fresh[i]
                else:
                    mark = leave(mark, np.asarray(batch.column(2)[i].values), np.asarray(batch.column(3)[i].values), delta)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, mark_arrow)],
                                             names=[_KEY, _CHUNK, "entry"])

    source = rows.select(_KEY, _CHUNK, _SEQ, _TIME, _POS, _MEAS, _FIRE, _TOP, F.lit(None).cast(mark_type).alias("entry"))
    if split:
        summary = walk(rows.select(_KEY, _CHUNK, _SEQ, _TIME, _POS, _MEAS, _TOP), [_KEY, _CHUNK], [_SEQ],
                       table_schema, tables).checkpoint()
        entry = (summary.select(_KEY, _CHUNK, "breaks", "exits", "fresh").repartition(_KEY).sortWithinPartitions(_KEY, _CHUNK)
                 .mapInArrow(entries, f"{_KEY} {kinds[_KEY]}, {_CHUNK} long, entry {mark_type}").filter("entry is not null"))
        source = source.unionByName(entry, allowMissingColumns=True)   # sorts before the chunk's rows

    # 3: the firings
    fire_schema = (f"{_KEY} {kinds[_KEY]}, {_CHUNK} long, fire_seq long, {_FIRE} {kinds[_FIRE]}, best double, best_seq long, "
                   f"{_TOP} {kinds[_TOP]}, after_us long")

    def fire(t: pa.Table, bounds: np.ndarray, types: dict) -> Iterator[pa.RecordBatch]:
        pos, ok = arrow_positions(t.column(_POS))
        mark_at, has_mark = arrow_positions(t.column("entry"))
        chunk = t.column(_CHUNK).to_numpy()
        marker = t.column(_SEQ).is_null().to_numpy()
        us, m = np.zeros(t.num_rows, dtype=np.int64), _measures(t)
        us[~marker] = _micros(t.filter(pa.array(~marker)), _TIME)
        hit, top, after = [], [], []
        for a, b in zip(bounds, bounds[1:]):
            entry = mark_at[a] if marker[a] and has_mark[a] else None
            a += int(marker[a])
            at, v = records(pos[a:b], ok[a:b])
            if not len(v):
                continue
            nxt = first_beyond(v, v, delta)
            i = int(nxt[0]) if entry is None else int(first_beyond(v, entry, delta))
            found = []
            while i < len(v):
                found.append(a + int(at[i]))
                i = int(nxt[i])
            if not found:
                continue
            lows = a + np.searchsorted(us[a:b], us[found] - keep_us, side="right")
            for j, lo in zip(found, lows):
                back = lo == a and chunk[a] > 0
                if lo <= j or back:
                    hit.append(j)
                    top.append(lo + int(np.argmax(m[lo:j + 1])) if lo <= j else None)
                    after.append(int(us[j]) - keep_us if back else None)
        schema = pa.schema([(_KEY, types[_KEY]), (_CHUNK, pa.int64()), ("fire_seq", pa.int64()), (_FIRE, types[_FIRE]),
                            ("best", pa.float64()), ("best_seq", pa.int64()), (_TOP, types[_TOP]), ("after_us", pa.int64())])
        j, k = pa.array(hit, pa.int64()), pa.array(top, pa.int64())
        yield from _emit(schema, **{
            _KEY: t.column(_KEY).take(j), _CHUNK: t.column(_CHUNK).take(j), "fire_seq": t.column(_SEQ).take(j),
            _FIRE: t.column(_FIRE).take(j), "best": pa.array(m).take(k), "best_seq": t.column(_SEQ).take(k),
            _TOP: t.column(_TOP).take(k), "after_us": after})

    fired = walk(source, [_KEY, _CHUNK], [_SEQ], fire_schema, fire)
    names = [F.col(_KEY).alias(key), *[F.col(f"{_FIRE}.{c}").alias(f"fire_{c}") for c in fire_cols],
             *[F.col(f"{_TOP}.{c}").alias(c) for c in fields]]
    if not split:
        return fired.select(*names)

    # 4: spans that reach back, answered by summaries; 5: and by the chunk they reach into
    fired = fired.checkpoint()
    asks = fired.filter("after_us is not null").select(_KEY, _CHUNK, "fire_seq", "after_us")
    cover_schema = (f"{_KEY} {kinds[_KEY]}, {_CHUNK} long, fire_seq long, after_us long, best double, best_seq long, "
                    f"{_TOP} {kinds[_TOP]}")

    def cover(t: pa.Table, bounds: np.ndarray, types: dict) -> Iterator[pa.RecordBatch]:
        chunk, ask = t.column(_CHUNK).to_numpy(), t.column("fire_seq").is_valid().to_numpy()
        high, after = t.column("high_us").to_pylist(), t.column("after_us").to_pylist()
        best = t.column("best").to_pylist()
        who, part, row = [], [], []
        for a, b in zip(bounds, bounds[1:]):
            have = _Summaries()
            for i in range(a, b):                # asks of a chunk come before its summary
                if not ask[i]:
                    have.add(int(chunk[i]), high[i], best[i], i)
                    continue
                c, whole = have.cover(after[i])
                if c is not None:
                    who.append(i)
                    part.append(c)
                    row.append(None)
                if whole is not None:
                    who.append(i)
                    part.append(None)
                    row.append(whole[1])
        schema = pa.schema([(_KEY, types[_KEY]), (_CHUNK, pa.int64()), ("fire_seq", pa.int64()), ("after_us", pa.int64()),
                            ("best", pa.float64()), ("best_seq", pa.int64()), (_TOP, types[_TOP])])
        i, k = pa.array(who, pa.int64()), pa.array(row, pa.int64())
        yield from _emit(schema, **{
            _KEY: t.column(_KEY).take(i), _CHUNK: part, "fire_seq": t.column("fire_seq").take(i),
            "after_us": t.column("after_us").take(i), "best": t.column("best").take(k),
            "best_seq": t.column("best_seq").take(k), _TOP: t.column(_TOP).take(k)})

    both = (summary.select(_KEY, _CHUNK, "high_us", "best", "best_seq", _TOP, F.lit(1).alias("_tp_kind"))
            .unionByName(asks.withColumn("_tp_kind", F.lit(0)), allowMissingColumns=True))
    covered = walk(both, [_KEY], [_CHUNK, "_tp_kind"], cover_schema, cover).checkpoint()
    requests = covered.filter(F.col(_CHUNK).isNotNull()).select(_KEY, _CHUNK, "fire_seq", "after_us")
    answer_schema = f"{_KEY} {kinds[_KEY]}, fire_seq long, best double, best_seq long, {_TOP} {kinds[_TOP]}"

    def answer(t: pa.Table, bounds: np.ndarray, types: dict) -> Iterator[pa.RecordBatch]:
        asked = t.column(_SEQ).is_null().to_numpy()
        us, m = np.zeros(t.num_rows, dtype=np.int64), _measures(t)
        us[~asked] = _micros(t.filter(pa.array(~asked)), _TIME)
        after = t.column("after_us").to_numpy()
        who, top = [], []
        for a, b in zip(bounds, bounds[1:]):
            mid = a + int(asked[a:b].sum())      # requests sort first
            if a < mid < b:
                best = _suffix_best(m[mid:b])
                lo = np.searchsorted(us[mid:b], after[a:mid].astype(np.int64), side="right")
                who.extend(range(a, mid))
                top.extend((mid + best[lo]).tolist())
        schema = pa.schema([(_KEY, types[_KEY]), ("fire_seq", pa.int64()), ("best", pa.float64()),
                            ("best_seq", pa.int64()), (_TOP, types[_TOP])])
        i, k = pa.array(who, pa.int64()), pa.array(top, pa.int64())
        yield from _emit(schema, **{
            _KEY: t.column(_KEY).take(i), "fire_seq": t.column("fire_seq").take(i), "best": pa.array(m).take(k),
            "best_seq": t.column(_SEQ).take(k), _TOP: t.column(_TOP).take(k)})

    at = F.struct(_KEY, _CHUNK)                  # structs compare nulls as equal
    wanted = requests.select(at.alias("_tp_at")).distinct()
    reached = (rows.select(_KEY, _CHUNK, _SEQ, _TIME, _MEAS, _TOP).withColumn("_tp_at", at).join(wanted, "_tp_at", "left_semi")
               .drop("_tp_at").unionByName(requests, allowMissingColumns=True))
    answers = walk(reached, [_KEY, _CHUNK], [_SEQ], answer_schema, answer)
    parts = (fired.filter("after_us is not null").select(_KEY, "fire_seq", _FIRE, "best", "best_seq", _TOP)
             .unionByName(covered.filter(F.col(_CHUNK).isNull()).select(_KEY, "fire_seq", "best", "best_seq", _TOP), allowMissingColumns=True)
             .unionByName(answers, allowMissingColumns=True))
    best = parts.groupBy(_KEY, "fire_seq").agg(
        F.first(_FIRE, ignorenulls=True).alias(_FIRE),
        F.min_by(_TOP, F.when(F.col("best_seq").isNotNull(), F.struct(-F.col("best"), "best_seq"))).alias(_TOP))
    return (fired.filter("after_us is null").select(_KEY, _FIRE, _TOP)
            .unionByName(best.filter(F.col(_TOP).isNotNull()).select(_KEY, _FIRE, _TOP)).select(*names))
