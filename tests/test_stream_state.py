"""Keyed-state streams against plain Python, over batch sizes, nulls, large batches and restarts."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidepool.operators.delta import delta_trigger_split
from tidepool.operators.sequences import count_window, every_n_average
from tidepool.operators.windows import sliding
from tidepool.streaming import stateful
from tidepool.streaming.timers import running_count_stream
from tidepool.streaming.runner import drain, start
from tidepool.streaming.watermarks import with_event_time

SCHEMA = "k int, id long, ts timestamp, v long, name string"


def _write(spark, rows, size, folder):
    df = spark.createDataFrame(rows, "k int, id long, t long, v long, name string")
    df = df.withColumn("ts", F.timestamp_seconds("t")).select("k", "id", "ts", "v", "name")
    for i, a in enumerate(range(0, len(rows), size)):
        ids = [r[1] for r in rows[a:a + size]]
        df.filter(F.col("id").isin(ids)).coalesce(1).write.parquet(os.path.join(folder, f"part={i:05d}"))


def _stream(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


def _run(df, out, ck):
    drain(start(df, sink="parquet", path=out, checkpoint=ck))
    return df.sparkSession.read.schema(df.schema).parquet(out)


def _dirs():
    return tempfile.mkdtemp(prefix="tp-out-"), tempfile.mkdtemp(prefix="tp-ck-")


BIG = (1 << 53) + 3


def _rows():
    vals = [1, None, 3, 4, None, 6, 7, 8, 1 << 55, 10, 11, 12, 13]
    return [(1, BIG + i, i, v, f"n{i}") for i, v in enumerate(vals)] + [(2, BIG + 100 + i, 20 + i, None, None) for i in range(4)]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7])
def test_count_window_over_batch_sizes(spark, size):
    src = tempfile.mkdtemp(prefix="tp-src-")
    _write(spark, _rows(), size, src)
    got = _run(stateful.count_window_stream(_stream(spark, src), "k", ["ts", "id"], 5, 3, "v"), *_dirs())
    want = set()
    for key in (1, 2):
        own = [r[3] for r in _rows() if r[0] == key]
        for f in range(3, len(own) + 1, 3):
            win = own[max(0, f - 5):f]
            seen = [x for x in win if x is not None]
            want.add((key, f, sum(seen) if seen else None, len(win)))
    assert {(r.k, r.fire_seq, r.window_sum, r.n_rows) for r in got.collect()} == want


@pytest.mark.parametrize("size", [1, 4])
def test_delta_trigger_keeps_large_ids_and_text(spark, size):
    rows = [(1, BIG + 2 * i, i, v, f"n{i}") for i, v in enumerate([0, 3, 9, 8, 12, 25, 26, 40])]
    src = tempfile.mkdtemp(prefix="tp-src-")
    _write(spark, rows, size, src)
    got = _run(stateful.delta_trigger_stream(_stream(spark, src), "k", "ts", ["id"], "v", "v", 10, "3 seconds",
                                             ["id", "ts", "name"]), *_dirs())
    # marks 0, 12, 25, 40; the largest value of the last three seconds is the firing row itself
    assert sorted((r.id, r.ts.second, r.name) for r in got.collect()) == [
        (BIG + 2 * i, i, f"n{i}") for i in (4, 5, 7)]


def test_buffer_keeps_order_in_a_large_batch(spark):
    n = 25_000
    src = tempfile.mkdtemp(prefix="tp-src-")
    (spark.range(n).select(F.lit(1).alias("k"), "id", F.timestamp_seconds(F.col("id")).alias("ts"),
                           F.col("id").alias("v"), F.lit("x").alias("name"))
     .orderBy(F.desc("id")).coalesce(1).write.parquet(os.path.join(src, "part=0")))
    got = _run(stateful.buffered_stream(_stream(spark, src), "k", ["id"], 10, ["id"]), *_dirs())
    bad = got.filter(F.col("id") != (F.col("batch_no") - 1) * 10 + F.col("slot") - 1).count()
    assert got.count() == n and bad == 0


def test_buffer_goes_on_after_a_restart(spark):
    rows = [(1, i, i, i, f"n{i}") for i in range(23)]
    src, (out, ck) = tempfile.mkdtemp(prefix="tp-src-"), _dirs()
    _write(spark, rows[:9], 9, os.path.join(src, "a"))
    make = lambda: stateful.buffered_stream(_stream(spark, src), "k", ["ts", "id"], 5, ["id", "name"])
    assert _run(make(), out, ck).count() == 5
    _write(spark, rows[9:], 14, os.path.join(src, "b"))
    got = {(r.batch_no, r.slot, r.id, r.name) for r in _run(make(), out, ck).collect()}
    assert got == {(i // 5 + 1, i % 5 + 1, i, f"n{i}") for i in range(20)}


def test_running_count_stream(spark):
    rows = [(1, i, i, i, name) for i, name in enumerate("abacabad")]
    src = tempfile.mkdtemp(prefix="tp-src-")
    _write(spark, rows, 3, src)
    got = _run(running_count_stream(_stream(spark, src), ["id"], ["id"], "name"), *_dirs())
    seen, want = {}, set()
    for i, name in enumerate("abacabad"):
        seen[name] = seen.get(name, 0) + 1
        want.add((i, name, seen[name]))
    assert {(r.id, r.name, r.running_count) for r in got.collect()} == want


def test_long_sliding_window_on_a_stream(spark):
    """60 minutes every 5 seconds: panes, not 720 copies of a row."""
    rows = [(1, i, 7 * i, i, "x") for i in range(40)] + [(1, 99, 40_000, 0, "x")]
    src = tempfile.mkdtemp(prefix="tp-src-")
    _write(spark, rows, 20, src)
    out = sliding(with_event_time(_stream(spark, src), "ts"), "ts", "60 minutes", "5 seconds", ["k"],
                  {"n": ("count", F.lit(1)), "s": ("sum", "v")})
    got = {(int(r.window_end.timestamp()), r.n, r.s) for r in _run(out, *_dirs()).collect()}
    want = set()
    for end in range(5, 40_001, 5):
        inside = [i for _, i, t, _, _ in rows if end - 3600 <= t < end]
        if inside:
            want.add((end, len(inside), sum(i for i in inside if i != 99)))
    assert {(e, n, s) for e, n, s in got} == want


def test_sliding_batch_of_any_size_and_slide(spark):
    rows = [(1, i, 13 * i % 997, i, "x") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, id long, t long, v long, name string").withColumn("ts", F.timestamp_seconds("t"))
    for size, slide in ((50, 20), (20, 50), (30, 10), (7, 7)):
        got = {(int(r.window_start.timestamp()), r.n, r.s) for r in sliding(
            df, "ts", f"{size} seconds", f"{slide} seconds", ["k"], {"n": ("count", F.lit(1)), "s": ("sum", "v")}).collect()}
        want = set()
        for a in range(-slide * (size // slide + 1), 1000, slide):
            inside = [v for _, _, t, v, _ in rows if a <= t < a + size]
            if inside:
                want.add((a, len(inside), sum(inside)))
        assert got == want, (size, slide)


def test_every_n_average_and_count_window_with_nulls(spark):
    """Nulls count as rows and not in the sum, and leave large longs exact, as in the batch forms."""
    big = (1 << 60) + 1
    values = [10, None, 30, None, None, None, big, big, None, 5]
    src = tempfile.mkdtemp(prefix="tp-src-")
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k long, id long, v long")
    for i in range(0, 10, 3):
        df.filter(f"id >= {i} and id < {i + 3}").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    for n in (2, 3, 4):
        got = _run(stateful.every_n_average_stream(stream, "k", ["id"], "v", n), *_dirs())
        want = every_n_average(df, ["k"], ["id"], "v", n, [])
        assert sorted(str(r.average) for r in got.collect()) == sorted(str(r.average) for r in want.collect())
    assert [r.average for r in every_n_average(df, ["k"], ["id"], "v", 3, []).orderBy("group_no").collect()][0] == 13
    got = _run(stateful.count_window_stream(stream, "k", ["id"], 4, 2, "v"), *_dirs())
    want = count_window(df, ["k"], ["id"], 4, 2, "v", [])
    cols = ["fire_seq", "window_sum", "n_rows"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_delta_trigger_stream_beyond_the_digits_of_a_double(spark):
    big = 1 << 60
    src = tempfile.mkdtemp(prefix="tp-src-")
    df = (spark.createDataFrame([(1, i, None if i == 4 else big + 3 * i, i) for i in range(9)], "k int, id long, p long, m int")
          .withColumn("ts", F.timestamp_seconds("id")))
    for i in range(0, 9, 2):
        df.filter(f"id >= {i} and id < {i + 2}").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = _run(stateful.delta_trigger_stream(stream, "k", "ts", ["id"], "p", "m", 5, "1 hour", ["m"]), *_dirs())
    want = delta_trigger_split(df, "k", "ts", ["id"], "p", "m", 5, "1 hour", ["m"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 3


def test_stream_calls_follow_the_buckets_not_the_keys(spark):
    """A micro-batch writes a state per bucket of keys; nulls in keys and fields and large longs stay exact."""
    src = tempfile.mkdtemp(prefix="tp-src-")
    rows = [(k if k else None, BIG + 10 * i + k, 100 * i + k, None if k == 5 else BIG + i, f"n{k}") for i in range(4) for k in range(900)]
    df = (spark.createDataFrame(rows, "k int, id long, t long, v long, name string")
          .select("k", "id", F.timestamp_seconds("t").alias("ts"), "v", "name"))
    df.filter("ts < timestamp_seconds(200)").coalesce(1).write.parquet(os.path.join(src, "part=0"))
    df.filter("ts >= timestamp_seconds(200)").coalesce(1).write.parquet(os.path.join(src, "part=1"))
    out, ck = _dirs()
    stream = stateful.buffered_stream(_stream(spark, src), "k", ["ts", "id"], 2, ["id", "v", "name"])
    query = drain(start(stream, sink="parquet", path=out, checkpoint=ck))
    written = [op["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"] for op in p["stateOperators"]]
    assert written and max(written) <= stateful.BUCKETS + 1
    got = sorted(((r.k or 0), r.batch_no, r.slot, r.id, r.v, r.name) for r in spark.read.schema(stream.schema).parquet(out).collect())
    assert [g[:4] + g[5:] for g in got] == [(k, i // 2 + 1, i % 2 + 1, BIG + 10 * i + k, f"n{k}") for k in range(900) for i in range(4)]
    assert [g[4] for g in got] == [None if k == 5 else BIG + i for k in range(900) for i in range(4)]


def test_running_count_stream_calls_follow_the_entries(spark):
    """Ten words in one entry: a state row written, not ten."""
    rows = [(1, i, i, i, f"w{i % 10}") for i in range(60)]
    src, (out, ck) = tempfile.mkdtemp(prefix="tp-src-"), _dirs()
    _write(spark, rows, 30, src)
    stream = running_count_stream(_stream(spark, src), ["id"], ["id"], "name", buckets=1, slots=1)
    query = drain(start(stream, sink="parquet", path=out, checkpoint=ck))
    written = [op["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"] for op in p["stateOperators"]]
    assert written == [1, 1]
    assert {(r.id, r.running_count) for r in spark.read.parquet(out).collect()} == {(i, i // 10 + 1) for i in range(60)}
