"""Streams equal their batch forms: replay ``events`` as ordered files, one per batch."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidepool.operators.hot import hot_items, item_view_counts
from tidepool.operators.sequences import (count_window, delta_trigger_max, every_n_average,
                                          full_batches, position_from)
from tidepool.operators.text import split_words, tokenize, word_count
from tidepool.operators.windows import sessions, tumbling
from replay import drop_sentinel, write_replay
from tidepool.sources.replay import replay_stream
from tidepool.sources.tables import table
from tidepool.sources.text import read_lines
from tidepool.streaming import stateful
from tidepool.streaming.runner import drain, start
from tidepool.streaming.topn import stream_top_n
from tidepool.streaming.watermarks import dropped_by_watermark, with_event_time

N_FILES = 4


@pytest.fixture(scope="module")
def replay(spark):
    ev = table(spark, SF_SMALL, "events")
    root = tempfile.mkdtemp(prefix="tp-replay-")
    write_replay(ev, root, "ts", N_FILES,
                 sentinel={"event_id": -1, "user_id": -1, "event_type": "view", "value": 0.0,
                           "props": '{"k": -1}'})
    schema = ev.withColumn("ts", F.col("ts").cast("timestamp")).schema
    return root, schema, ev


def _memory(df, mode="append"):
    name = "q" + os.urandom(4).hex()
    q = start(df, output_mode=mode, sink="memory", query_name=name,
              checkpoint=tempfile.mkdtemp(prefix="tp-ck-"))
    drain(q)
    return df.sparkSession.table(name), q


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _batch_events(ev):
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def test_tumbling_stream_equals_batch(spark, replay):
    root, schema, ev = replay
    s = with_event_time(replay_stream(spark, root, schema), "ts")
    out = tumbling(s, "ts", "1 hour", ["event_type"],
                   [F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")])
    got, _ = _memory(out.select("event_type", "window.start", "n", F.round("v", 2).alias("v")))
    got = drop_sentinel(got, "start").filter("not (event_type = 'view' and n = 1 and v = 0)")
    want = tumbling(_batch_events(ev), "ts", "1 hour", ["event_type"],
                    [F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")]).select(
        "event_type", "window.start", "n", F.round("v", 2).alias("v"))
    assert _rows(got, want.columns) == _rows(want, want.columns)


def test_session_stream_equals_batch(spark, replay):
    root, schema, ev = replay
    s = with_event_time(replay_stream(spark, root, schema), "ts")
    aggs = [F.count(F.lit(1)).alias("n")]
    got, _ = _memory(sessions(s, ["user_id"], "ts", "30 minutes", aggs)
                     .select("user_id", "session.start", "n"))
    got = got.filter("user_id >= 0")
    want = sessions(_batch_events(ev), ["user_id"], "ts", "30 minutes", aggs).select(
        "user_id", "session.start", "n")
    assert _rows(got, want.columns) == _rows(want, want.columns)


def test_hot_items_stream_top_n_per_batch(spark, replay):
    """Windowed counts close in append mode; top N of each closed window per micro-batch."""
    root, schema, ev = replay
    s = with_event_time(replay_stream(spark, root, schema), "ts")
    s = s.withColumn("item_id", F.get_json_object("props", "$.k").cast("long"))
    counts = item_view_counts(s, "ts", "item_id", "60 minutes", "5 minutes", "event_type", "view")
    out_dir = tempfile.mkdtemp(prefix="tp-top-")
    drain(stream_top_n(counts, ["window_end"], [F.desc("view_count"), F.asc("item_id")], 5,
                       out_dir, tempfile.mkdtemp(prefix="tp-ck-")))
    got = spark.read.parquet(out_dir).select("window_end", "rank", "item_id", "view_count")
    got = drop_sentinel(got, "window_end")
    bev = _batch_events(ev).withColumn("item_id", F.get_json_object("props", "$.k").cast("long"))
    want = hot_items(bev, "ts", "item_id", "60 minutes", "5 minutes", 5, "event_type", "view")
    assert _rows(got, want.columns) == _rows(want, want.columns)


def test_word_count_stream_complete_mode(spark):
    docs = table(spark, SF_SMALL, "conversations").select("text")
    d = tempfile.mkdtemp(prefix="tp-lines-")
    docs.repartition(3).write.mode("overwrite").text(os.path.join(d, "in"))
    lines = read_lines(spark, os.path.join(d, "in"), stream=True, max_files_per_trigger=1)
    got, _ = _memory(word_count(tokenize(lines, "line")), mode="complete")
    want = word_count(tokenize(docs, "text"))
    assert _rows(got, ["word", "count"]) == _rows(want, ["word", "count"])
    ws_got, _ = _memory(word_count(split_words(lines, "line")), mode="complete")
    ws_want = word_count(split_words(docs, "text"))
    assert _rows(ws_got, ["word", "count"]) == _rows(ws_want, ["word", "count"])


def test_keyed_state_streams_equal_batch(spark, replay):
    root, schema, ev = replay
    s = replay_stream(spark, root, schema).filter("user_id >= 0")
    s = s.withColumn("cents", position_from("value"))
    bev = _batch_events(ev).withColumn("cents", position_from("value"))
    order = ["ts", "event_id"]

    got, _ = _memory(stateful.every_n_average_stream(s, "user_id", order, "cents", 3))
    want = every_n_average(bev, ["user_id"], order, "cents", 3, [])
    assert _rows(got, ["user_id", "average"]) == _rows(want, ["user_id", "average"])

    got, _ = _memory(stateful.count_window_stream(s, "user_id", order, 5, 3, "cents"))
    want = count_window(bev, ["user_id"], order, 5, 3, "cents", [])
    cols = ["user_id", "fire_seq", "window_sum", "n_rows"]
    assert _rows(got, cols) == _rows(want, cols)

    got, _ = _memory(stateful.buffered_stream(s, "user_id", order, 10, ["event_id", "value"]))
    want = full_batches(bev, ["user_id"], order, 10, [])
    cols = ["user_id", "batch_no", "slot", "event_id"]
    assert _rows(got, cols) == _rows(want, cols)


def test_delta_trigger_stream_equals_batch(spark, replay):
    root, schema, ev = replay
    from tidepool.operators.sequence import running_total
    bev = _batch_events(ev).withColumn("cents", position_from("value"))
    pos = running_total(bev, ["user_id"], ["ts", "event_id"], [], "cents", "pos")
    want = delta_trigger_max(pos, "user_id", "ts", ["event_id"], "pos", "value",
                             50_000, "1 day", ["event_id", "value"])
    # the stream reads positions computed upstream (a replay of the batch table)
    d = tempfile.mkdtemp(prefix="tp-pos-")
    write_replay(pos, d, "ts", N_FILES)
    s = replay_stream(spark, d, pos.schema)
    got, _ = _memory(stateful.delta_trigger_stream(s, "user_id", "ts", ["event_id"], "pos",
                                                   "value", 50_000, "1 day", ["event_id", "value"]))
    cols = ["user_id", "fire_ts", "event_id", "value"]
    assert _rows(got, cols) == _rows(want, cols)


def test_restart_resumes_from_checkpoint(spark, replay):
    root, schema, ev = replay
    src = tempfile.mkdtemp(prefix="tp-src-")
    ck = tempfile.mkdtemp(prefix="tp-ck-")
    out = tempfile.mkdtemp(prefix="tp-out-")
    folders = sorted(os.listdir(root))

    def link(names):
        for n in names:
            os.symlink(os.path.join(root, n), os.path.join(src, n))

    def run():
        s = replay_stream(spark, src, schema).filter("user_id >= 0")
        counts = stateful.every_n_average_stream(s.withColumn("cents", position_from("value")),
                                                 "user_id", ["ts", "event_id"], "cents", 3)
        drain(start(counts, sink="parquet", path=out, checkpoint=ck))

    link(folders[:2])
    run()
    first = spark.read.parquet(out).count()
    link(folders[2:])
    run()
    got = spark.read.parquet(out)
    bev = _batch_events(ev).withColumn("cents", position_from("value"))
    want = every_n_average(bev, ["user_id"], ["ts", "event_id"], "cents", 3, [])
    assert 0 < first < got.count()
    assert _rows(got, ["user_id", "average"]) == _rows(want, ["user_id", "average"])


def test_late_rows_are_dropped(spark):
    root = tempfile.mkdtemp(prefix="tp-late-")
    batches = [[("a", 1_000), ("a", 2_000)], [("a", 11_000)], [("a", 12_000)],
               [("a", 1_500)], [("a", 13_000)]]
    for i, rows in enumerate(batches):
        (spark.createDataFrame(rows, "k string, t_ms long")
         .withColumn("ts", F.timestamp_millis("t_ms")).coalesce(1)
         .write.parquet(os.path.join(root, f"{i:05d}")))
    schema = "k string, t_ms long, ts timestamp"
    s = with_event_time(replay_stream(spark, root, schema), "ts", "2 seconds")
    got, q = _memory(tumbling(s, "ts", "5 seconds", ["k"], [F.count(F.lit(1)).alias("n")])
                     .select("k", "window.start", "n"))
    first = [r.n for r in got.collect() if r.start.second == 0 and r.start.minute == 0]
    assert first == [2]  # the row at 1.5 s came after the watermark passed 5 s
    assert dropped_by_watermark(q.recentProgress) >= 1


def test_buffered_stream_keeps_timestamps_across_batches(spark, replay):
    root, schema, ev = replay
    s = replay_stream(spark, root, schema).filter("user_id >= 0")
    got, _ = _memory(stateful.buffered_stream(s, "user_id", ["ts", "event_id"], 7,
                                              ["event_id", "ts", "value"]))
    want = full_batches(_batch_events(ev), ["user_id"], ["ts", "event_id"], 7, [])
    cols = ["user_id", "batch_no", "slot", "event_id", "ts"]
    assert _rows(got, cols) == _rows(want, cols)
