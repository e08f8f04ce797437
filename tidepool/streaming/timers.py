"""Keyed processes with list state, map state and event-time timers (``transformWithState``).

``hold_until`` keeps a key's rows in a list state until the watermark passes the
key's own time, then hands them to a function and clears the state: the keyed
process with a timer at window end + 1.  ``keep`` may thin the list whenever rows
arrive, so that a state that only needs the best few never holds more.

``running_count_stream`` keeps its counts in a map state with an entry for a few words
each: a micro-batch reads and writes the entries of its own words and no others, and
makes no more calls than there are entries, however many words it has.

The state store must be RocksDB; ``rocksdb`` sets the provider where it is unset.
Spark starts a process of its own on the driver to register a query's states; files
sent with ``addPyFile`` do not reach it, so this module's classes travel by value.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


def rocksdb(spark: SparkSession) -> None:
    """Choose the RocksDB state store for queries started from now on (needed for list and map states)."""
    if "RocksDB" not in (spark.conf.get(_PROVIDER_KEY, "") or ""):
        spark.conf.set(_PROVIDER_KEY, PROVIDER)


class HoldUntil(StatefulProcessor):
    """List state of a key's rows, given to ``on_timer`` one millisecond after the key's time."""

    def __init__(self, schema: T.StructType, time_at: int, keep, on_timer, chunk: int = 1000):
        self.schema, self.time_at, self.keep, self.on_timer, self.chunk = schema, time_at, keep, on_timer, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names, new = self.schema.names, []
        if self.keep is None:
            for row in rows:
                new.append(tuple(row[c] for c in names))
                if len(new) >= self.chunk:
                    self.rows.appendList(new)
                    new = []
            if new:
                self.rows.appendList(new)
        else:
            held = list(self.rows.get()) if self.rows.exists() else []
            for row in rows:
                held.append(tuple(row[c] for c in names))
                if len(held) >= self.chunk:
                    held = self.keep(held)
            self.rows.put(self.keep(held))
        end = key[self.time_at].replace(tzinfo=timezone.utc) if key[self.time_at].tzinfo is None else key[self.time_at]
        self.handle.registerTimer((end - EPOCH) // timedelta(milliseconds=1) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = [tuple(r) for r in self.rows.get()]
        self.rows.clear()
        yield from self.on_timer(tuple(key), held)

    def close(self) -> None:
        pass


def hold_until(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], out: str,
               on_timer: Callable[[tuple, list[tuple]], Iterator[Row]],
               keep: Callable[[list[tuple]], list[tuple]] | None = None) -> DataFrame:
    """Hold the ``values`` of each key's rows until the watermark passes ``time`` (one of ``keys``, a timestamp).

    ``on_timer(key, rows)`` yields the key's output rows (schema ``out``) and its
    state is cleared.  ``keep(rows)`` may drop rows that can no longer matter
    whenever rows have come; without it the state holds them all.  ``df`` needs a
    watermark; the session's time zone must be UTC.
    """
    rocksdb(df.sparkSession)
    schema = T.StructType([f for c in values for f in df.schema.fields if f.name == c])
    return (df.groupBy(*keys).transformWithState(
        HoldUntil(schema, list(keys).index(time), keep, on_timer), out, "Append", "EventTime"))


def top_n_on_timer(counts: DataFrame, end: str, item: str, count: str, n: int, buckets: int = 1) -> DataFrame:
    """``end, item, count``: the top ``n`` items of every window, per bucket of items, as its timer fires.

    A key's list holds its best ``n`` items at any time, so its state stays small.
    For windows of millions of items deal them to several ``buckets``, each a key:
    the batch ``top_n`` over the buckets' rows of a window (all in one micro-batch,
    as one watermark fires them) then gives the window's top ``n``.
    """
    def best(rows: list[tuple]) -> list[tuple]:
        return sorted(rows, key=lambda r: (-r[1], r[0]))[:n]

    def emit(key: tuple, rows: list[tuple]) -> Iterator[Row]:
        for name, number in best(rows):
            yield Row(**{end: key[0], item: name, count: number})

    kind = dict(counts.dtypes)
    dealt = counts.withColumn("_tp_bucket", F.pmod(F.xxhash64(item), F.lit(buckets)).cast("int"))
    return hold_until(dealt, [end, "_tp_bucket"], end, [item, count],
                      f"{end} {kind[end]}, {item} {kind[item]}, {count} {kind[count]}", emit, best)


class RunningCount(StatefulProcessor):
    """Counts of a bucket's words, a map entry for those of a slot."""

    def __init__(self, word: str, order: Sequence[str], keep: Sequence[str], out: str, slots: int):
        self.word, self.order, self.keep, self.out, self.slots = word, list(order), list(keep), out, slots

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", T.StructType([T.StructField("slot", T.LongType())]),
                                         T.StructType([T.StructField("words", T.ArrayType(T.StringType())),
                                                       T.StructField("n", T.ArrayType(T.LongType()))]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [p for p in rows if len(p)]
        if not frames:
            return
        frame = pd.concat(frames, ignore_index=True).sort_values(self.order, kind="stable").reset_index(drop=True)
        code, words = pd.factorize(frame[self.word])
        words, new, before = list(words), np.bincount(code).tolist(), np.zeros(len(words), dtype=np.int64)
        slot = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % self.slots for w in words])
        by_slot = np.argsort(slot, kind="stable")
        for at in np.split(by_slot, np.flatnonzero(np.diff(slot[by_slot])) + 1):
            entry = (int(slot[at[0]]),)
            old = self.counts.getValue(entry)
            held = {} if old is None else dict(zip(old[0], old[1]))
            for i in at:
                before[i] = held.get(words[i], 0)
                held[words[i]] = int(before[i]) + new[i]
            self.counts.updateValue(entry, (list(held), list(held.values())))
        res = frame[[*self.keep, self.word]].copy()
        res[self.out] = before[code] + pd.Series(code).groupby(code).cumcount().to_numpy() + 1
        yield res

    def close(self) -> None:
        pass


def running_count_stream(words: DataFrame, order: Sequence[str], keep: Sequence[str],
                         word: str = "word", out: str = "running_count", buckets: int = 64,
                         slots: int = 256) -> DataFrame:
    """Running count of each word, one output row per token: the counts are the state.

    Words are dealt to ``buckets`` by hash (a call per bucket and micro-batch, not
    per word); a bucket's counts are a map state of ``slots`` entries, each for the
    words of a hash, of which a micro-batch touches those of its own words only: at
    most an entry per word of the batch, and ``buckets * slots`` calls.  Take more
    buckets for more tasks, more slots for small micro-batches of large vocabularies.
    Output: ``keep``, ``word``, the count.
    """
    rocksdb(words.sparkSession)
    keep = [c for c in keep if c != word]
    kind = dict(words.dtypes)
    schema = ", ".join([*[f"{c} {kind[c]}" for c in keep], f"{word} {kind[word]}", f"{out} long"])
    bucketed = words.withColumn("_tp_bucket", F.pmod(F.xxhash64(word), F.lit(buckets)))
    return bucketed.groupBy("_tp_bucket").transformWithStateInPandas(
        RunningCount(word, order, keep, out, slots), schema, "Append", "None")
