"""The chunked delta trigger equals the sequential fold and a plain walk."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from tidepool.operators.delta import delta_trigger_split
from tidepool.operators.sequence import running_total, time_blocks
from tidepool.operators.sequences import delta_trigger_max, position_from
from tidepool.sources.tables import table


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def positions(spark):
    ev = table(spark, SF_ORACLE, "events").withColumn("cents", position_from("value"))
    ev, blocks = time_blocks(ev, "ts", ("day",))
    pos = running_total(ev, ["user_id"], ["ts", "event_id"], [[b] for b in blocks], "cents", "pos")
    return pos, [[b] for b in blocks]


@pytest.mark.parametrize("chunk_rows", [8, 1 << 20])
def test_split_equals_fold_on_events(spark, positions, chunk_rows):
    pos, blocks = positions
    args = ("user_id", "ts", ["event_id"], "pos", "value", 50_000, "1 day",
            ["event_id", "ts", "value", "pos"])
    want = delta_trigger_max(pos, *args)
    got = delta_trigger_split(pos, *args, blocks=blocks, chunk_rows=chunk_rows)
    cols = ["user_id", "fire_ts", "fire_event_id", "event_id", "ts", "value", "pos"]
    assert got.columns == want.columns
    assert _rows(got, cols) == _rows(want, cols)


def _walk(rows, delta, keep_us):
    """Plain walk of one key's rows (time, id, position, measure), sorted."""
    mark, out = None, []
    for j, (t, i, p, _) in enumerate(rows):
        if p is None:
            continue
        if mark is None:
            mark = p
        elif p - mark > delta:
            mark = p
            span = [r for r in rows[:j + 1] if r[0] > t - keep_us]
            if span:
                best = max(span, key=lambda r: (-1e300 if r[3] is None else r[3]))
                out.append((i, best[1]))
    return out


@pytest.mark.parametrize("chunk_rows", [4, 8, 16, 1 << 20])
def test_split_equals_plain_walk(spark, chunk_rows):
    """Rare firings, falling positions, spans longer than a chunk, nulls, a null key."""
    rnd = random.Random(chunk_rows)
    rows, want = [], set()
    for key in (1, 2, 3, None):
        step = {1: 3, 2: 60, 3: 1, None: 25}[key]  # key 3 never fires in a chunk
        t, p, own = 0, 0, []
        for i in range(150):
            t += rnd.choice([0, 1, 1, 30])
            p += rnd.randint(-step // 2, 2 * step)
            own.append((t * 1_000_000, i, None if rnd.random() < 0.05 else p,
                        None if rnd.random() < 0.05 else rnd.randint(0, 9)))
        rows += [(key, *r) for r in own]
        want |= {(key, *f) for f in _walk(own, 40, 90 * 1_000_000)}
    df = (spark.createDataFrame(rows, "k int, t long, id long, p long, m int")
          .withColumn("ts", F.timestamp_micros("t")))
    got = delta_trigger_split(df, "k", "ts", ["id"], "p", "m", 40, "90 seconds", ["id"], blocks=[],
                              chunk_rows=chunk_rows)
    assert {(r.k, r.fire_id, r.id) for r in got.collect()} == want


def test_chunks_of_one_key_run_in_several_tasks(spark):
    """One key only: its firings come from many tasks."""
    df = spark.range(20_000).selectExpr("1 AS k", "timestamp_seconds(id * 60) AS ts", "id", "id * 7 AS p", "id % 11 AS m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = delta_trigger_split(df, "k", "ts", ["id"], "p", "m", 40, "5 minutes", ["id"], chunk_rows=1000)
        rows = got.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(rows) == (20_000 - 1) // 6 and len({r.task for r in rows}) > 4


BIG = 1 << 60


@pytest.mark.parametrize("chunk_rows", [2, 1 << 20])
def test_positions_beyond_the_digits_of_a_double(spark, chunk_rows):
    rows = [(1, i, BIG + 3 * i if i != 4 else None, i) for i in range(9)]
    df = spark.createDataFrame(rows, "k int, id long, p long, m int").withColumn("ts", F.timestamp_seconds("id"))
    want = [r[1] for r in _plain_fires(rows, 5)]
    fold = delta_trigger_max(df, "k", "ts", ["id"], "p", "m", 5, "1 hour", ["m"])
    split = delta_trigger_split(df, "k", "ts", ["id"], "p", "m", 5, "1 hour", ["m"], chunk_rows=chunk_rows)
    assert sorted(r.fire_id for r in fold.collect()) == sorted(r.fire_id for r in split.collect()) == want


def _plain_fires(rows, delta):
    mark, out = None, []
    for r in rows:
        if r[2] is not None and mark is None:
            mark = r[2]
        elif r[2] is not None and r[2] - mark > delta:
            mark = r[2]
            out.append(r)
    return out


def test_long_spans_over_many_chunks(spark):
    """A span that covers hundreds of chunks whole is answered by their summaries."""
    rnd = random.Random(11)
    rows = [(1, i * 1_000_000, i, i, rnd.randint(0, 10_000)) for i in range(1500)]
    want = {(1, *f) for f in _walk([r[1:] for r in rows], 17, 1000 * 1_000_000)}
    df = spark.createDataFrame(rows, "k int, t long, id long, p long, m int").withColumn("ts", F.timestamp_micros("t"))
    got = delta_trigger_split(df, "k", "ts", ["id"], "p", "m", 17, "1000 seconds", ["id"], chunk_rows=3)
    assert {(r.k, r.fire_id, r.id) for r in got.collect()} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, ts timestamp, id long, p long, m int")
    assert delta_trigger_split(df, "k", "ts", ["id"], "p", "m", 5, "1 hour", ["m"]).count() == 0
