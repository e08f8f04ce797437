"""Replays in event-time order that close at their end; timers, map state, late rows, user aggregates, sized blocks."""

import os
import random
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from tidepool.operators.sequence import running_max, running_totals, sequence_number, sized_blocks
from tidepool.operators.sequences import count_window
from tidepool.operators.user_aggregate import Aggregate, TrimmedMean, user_aggregate, whole_window
from tidepool.operators.windows import tumbling
from tidepool.plans.streams import BATCHES, RUNS
from tidepool.sources.replay import CLOSING, or_closing, replay, without_closing, write_replay
from tidepool.streaming.late import read_split, split_late
from tidepool.streaming.runner import drain, rows_per_batch, start
from tidepool.streaming.timers import hold_until, running_count_stream
from tidepool.streaming.watermarks import with_event_time

Q = entry.queries()


def _dir():
    return tempfile.mkdtemp(prefix="tp-replay-")


def _times(spark, n=500):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(0, 50_000), rnd.choice("abc")) for i in range(n)]
    return spark.createDataFrame(rows, "id long, s long, kind string").withColumn("ts", F.timestamp_seconds("s"))


def _collect(stream, name):
    path = _dir() + "/out"
    query = drain(start(stream, sink="parquet", path=path, checkpoint=_dir()))
    return stream.sparkSession.read.schema(stream.schema).parquet(path), rows_per_batch(query)


def test_files_follow_each_other_in_time(spark):
    folder = _dir()
    n = write_replay(_times(spark), folder, ["ts", "id"], 12, "ts", "1 hour", {})
    files = sorted((os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")),
                   key=os.path.getmtime)
    assert n == len(files) and 10 <= n <= 13
    spans = [spark.read.parquet(f).agg(F.min("ts"), F.max("ts"), F.max(CLOSING)).first() for f in files]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert [s[2] for s in spans] == [False] * (n - 1) + [True]


def test_every_window_closes(spark):
    df = _times(spark)
    stream = with_event_time(replay(df, _dir(), ["ts", "id"], 6, 6, "ts", "10 minutes", {}), "ts")
    out = tumbling(stream.filter(or_closing(F.col("kind") == "a")), "ts", "10 minutes", ["kind"], [F.count(F.lit(1)).alias("n")])
    got, batches = _collect(out, "closed")
    want = tumbling(df.filter("kind = 'a'"), "ts", "10 minutes", ["kind"], [F.count(F.lit(1)).alias("n")])
    assert sorted((r.window.start, r.n) for r in got.collect()) == sorted((r.window.start, r.n) for r in want.collect())
    assert len(batches) >= 6 and sum(batches) == 501


def test_closing_row_is_dropped_from_plain_streams(spark):
    stream = without_closing(replay(_times(spark), _dir(), ["ts", "id"], 5, 5, "ts", "1 hour", {}))
    got, _ = _collect(stream, "plain")
    assert CLOSING not in got.columns and got.count() == 500


def test_empty_replay(spark):
    stream = replay(_times(spark).limit(0), _dir(), ["ts"], 3, 3, "ts", "1 hour", {})
    got, batches = _collect(stream, "none")
    assert got.count() == 0 and sum(batches) == 0


@pytest.mark.parametrize("name", ["stream_tumbling", "stream_hot_items_timer", "stream_running_count", "stream_every_n"])
def test_registered_streams_cross_micro_batches(spark, name):
    Q[name](spark, SF_SMALL).count()
    rows = {"stream_running_count": "conversations"}.get(name, "events")
    closing = int(name in ("stream_tumbling", "stream_hot_items_timer"))
    assert len(RUNS[name]) >= BATCHES
    assert sum(RUNS[name]) == spark.read.parquet(f"{SF_SMALL}/{rows}.parquet").count() + closing


def test_hold_until_emits_once_and_clears(spark):
    """Rows of a key are held over micro-batches and come out when the watermark has passed its time."""
    df = _times(spark).withColumn("end", F.timestamp_seconds(F.ceil((F.col("s") + 1) / 3600) * 3600))
    stream = with_event_time(replay(df, _dir(), ["ts", "id"], 6, 6, "ts", "2 hours",
                                    {"end": F.expr("timestamp'2100-01-01'")}), "ts")

    def emit(key, rows):
        yield Row(end=key[0], n=len(rows), top=max(r[0] for r in rows))

    out = hold_until(stream, ["end"], "end", ["id"], "end timestamp, n long, top long", emit)
    got, batches = _collect(out, "held")
    want = df.groupBy("end").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and len(batches) >= 6
    few = hold_until(stream, ["end"], "end", ["id"], "end timestamp, n long, top long", emit, lambda rows: [max(rows)])
    got, _ = _collect(few, "thinned")
    assert sorted((r.end, r.n, r.top) for r in got.collect()) == sorted((r.end, 1, r.top) for r in want.collect())


def test_running_count_touches_the_words_of_the_batch_only(spark):
    """State rows written per micro-batch follow the batch's words, not the vocabulary."""
    first = [(i, f"w{i}") for i in range(3000)]
    later = [(3000 + i, f"w{i % 5}") for i in range(50)]
    folder = _dir()
    df = spark.createDataFrame(first + later, "id long, word string")
    df.filter("id < 3000").coalesce(1).write.parquet(f"{folder}/a")
    out = running_count_stream(spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(folder),
                               ["id"], ["id"])
    path, ck = _dir() + "/out", _dir()
    drain(start(out, sink="parquet", path=path, checkpoint=ck))
    df.filter("id >= 3000").coalesce(1).write.parquet(f"{folder}/b")
    query = drain(start(out, sink="parquet", path=path, checkpoint=ck))     # also a restart
    written = sum(op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"])
    assert 0 < written <= 50
    got = {(r.id, r.running_count) for r in spark.read.parquet(path).collect()}
    assert got == {(i, 1) for i in range(3000)} | {(3000 + i, 2 + i // 5) for i in range(50)}


def test_late_rows(spark):
    folder, out, ck = _dir(), _dir() + "/split", _dir()
    rows = [[(1, 0), (2, 7000)], [(3, 100), (4, 3700), (5, 20_000)], [(6, 16_300), (7, 19_000), (8, None)]]
    for i, batch in enumerate(rows):
        (spark.createDataFrame(batch, "id long, s long").withColumn("ts", F.timestamp_seconds("s")).coalesce(1)
         .write.parquet(f"{folder}/{i}"))
        stream = (spark.readStream.schema("id long, s long, ts timestamp").option("recursiveFileLookup", "true").parquet(folder))
        drain(split_late(stream, "ts", "1 hour", "10 minutes", out, ck))
    on_time, late = read_split(spark, out)
    # their hours ended at 3600 and 18000, the watermarks were 6400 and 19400
    assert sorted(r.id for r in late.collect()) == [3, 6]
    assert sorted(r.id for r in on_time.collect()) == [1, 2, 4, 5, 7, 8]
    marks = {r.batch: r.watermark for r in on_time.select("batch", F.unix_seconds("watermark").alias("watermark")).collect()}
    assert marks == {0: None, 1: 6400, 2: 19_400}


def test_user_aggregate_merges_over_tasks(spark):
    class Longest(Aggregate):
        """The longest text and the number of rows."""

        state = "n long, text string"
        output = "n long, text string"

        def create(self):
            return {"n": 0, "text": None}

        def add(self, acc, rows):
            return self.merge(acc, {"n": rows.num_rows, "text": max((x for x in rows.column(0).to_pylist() if x is not None),
                                                                   key=lambda x: (len(x), x), default=None)})

        def merge(self, a, b):
            best = max((x for x in (a["text"], b["text"]) if x is not None), key=lambda x: (len(x), x), default=None)
            return {"n": a["n"] + b["n"], "text": best}

        def result(self, acc):
            return acc

    rnd = random.Random(5)
    rows = [(rnd.choice([None, "a", "a", "a", "b"]), None if rnd.random() < 0.1 else "x" * rnd.randrange(40)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, text string").repartition(7)
    got = {r.k: (r.n, r.text) for r in user_aggregate(df, ["k"], Longest(), ["text"]).collect()}
    assert got == {k: (sum(x == k for x, _ in rows), max((t for x, t in rows if x == k and t is not None), key=len))
                   for k in (None, "a", "b")}
    assert user_aggregate(df.limit(0), ["k"], Longest(), ["text"]).count() == 0


def test_user_aggregate_sends_accumulators_not_rows(spark):
    df = spark.range(40_000).selectExpr("id % 3 AS k", "cast(id AS double) AS v").repartition(4)
    out = user_aggregate(df, ["k"], TrimmedMean(10), ["v"])
    assert {r.k: r.n for r in out.collect()} == {0: 13_334, 1: 13_333, 2: 13_333}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.index("RepartitionByExpression") > plan.index("MapInArrow")


def test_trimmed_mean_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (1, float("nan"))], "k int, v double")
    assert [tuple(r) for r in user_aggregate(df, ["k"], TrimmedMean(), ["v"]).collect()] == [(1, 0, None)]


def test_whole_window_sees_its_rows_in_order(spark):
    df = _times(spark)

    def body(rows: pa.Table) -> dict:
        ids = rows.column("id").to_pylist()
        assert rows.column("s").to_pylist() == sorted(rows.column("s").to_pylist())
        return {"ids": ids}

    got = whole_window(df, ["kind"], "ts", "1 hour", ["id", "s"], body, "ids array<long>", order=["s"])
    want = tumbling(df, "ts", "1 hour", ["kind"], [F.sort_array(F.collect_list("id")).alias("ids")])
    assert sorted((r.kind, r.window_start, sorted(r.ids)) for r in got.collect()) == \
        sorted((r.kind, r.window.start, r.ids) for r in want.collect())


# --- blocks cut from counts -------------------------------------------------------

def _skewed(spark, n=6000):
    rnd = random.Random(2)
    rows = [(None if rnd.random() < 0.02 else 0 if rnd.random() < 0.4 else rnd.randint(1, 300), i, rnd.choice([None, 1, 2, 3, 50]))
            for i in range(n)]
    return spark.createDataFrame(rows, "k int, t long, v long")


@pytest.mark.parametrize("limit", [20, 200, 1 << 18])
def test_sized_blocks_split_large_keys_only(spark, limit):
    df = _skewed(spark)
    cut, blocks = sized_blocks(df, ["k"], [("b1", F.expr("t div 1000")), ("b2", F.expr("t div 10"))], limit)
    n_keys, n_blocks = df.select("k").distinct().count(), cut.select("k", *[c for b in blocks for c in b]).distinct().count()
    assert len(blocks) == {20: 2, 200: 2, 1 << 18: 0}[limit]
    assert n_blocks - n_keys <= 10 * 6000 // limit * 2
    got = running_totals(cut, ["k"], ["t"], blocks, {"s": "v", "n": None}).select("k", "t", "s", "n")
    want = running_totals(df, ["k"], ["t"], [], {"s": "v", "n": None}).select("k", "t", "s", "n")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("size,slide", [(5, 3), (1, 1), (4, 4), (2, 7), (9, 2)])
def test_count_window_over_blocks(spark, size, slide):
    """Blocks of a few rows, so that a window reaches over many of them."""
    df = _skewed(spark, 1500).withColumns({"b1": F.expr("t div 100"), "b2": F.expr("t div 4")})
    got = count_window(df, ["k"], ["t"], size, slide, "v", [["b1"], ["b2"]], fields=["t"])
    want = count_window(df, ["k"], ["t"], size, slide, "v", [], fields=["t"])
    assert got.columns == want.columns == ["k", "fire_seq", "window_sum", "n_rows", "t"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_count_window_exchanges_the_rows_once(spark):
    df = _skewed(spark).withColumn("b", F.expr("t div 100"))
    whole = count_window(df, ["k"], ["t"], 5, 3, "v", [])._jdf.queryExecution().executedPlan().toString()
    split = count_window(df, ["k"], ["t"], 5, 3, "v", [["b"]])._jdf.queryExecution().executedPlan().toString()
    assert whole.count("Exchange hashpartitioning") == 1
    assert "Join" not in split and "WindowGroupLimit" in split and "partial_sum" in split


def test_block_table_is_small(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    cut, blocks = sized_blocks(ev, ["user_id"], [("d", F.date_trunc("day", "ts")), ("m", F.date_trunc("minute", "ts"))])
    assert not blocks       # no user is large: a row per key


def test_running_max_over_many_blocks(spark):
    """10^5 blocks, carried level by level: only the coarsest level is one window."""
    df = spark.range(200_000).selectExpr("id", "(id * 7919) % 100003 AS v", "id div 20000 AS far", "id div 2 AS near")
    out = running_max(df, [], ["id"], ["far", "near"], "v", "m", inclusive=False)
    want, top = {}, None
    for i in range(200_000):
        if i % 9973 == 0 or i > 199_990:
            want[i] = top
        v = (i * 7919) % 100003
        top = v if top is None else max(top, v)
    got = {r.id: r.m for r in out.filter("id % 9973 = 0 or id > 199990").collect()}
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1


def test_sequence_number_with_null_keys(spark):
    df = _skewed(spark, 500)
    cut, blocks = sized_blocks(df, ["k"], [("b", F.expr("t div 50"))], 30)
    got = {(r.k, r.t): r.n for r in sequence_number(cut, ["k"], ["t"], blocks, "n").collect()}
    seen, want = {}, {}
    for k, t, _ in sorted(map(tuple, df.collect()), key=lambda r: r[1]):
        seen[k] = seen.get(k, 0) + 1
        want[k, t] = seen[k]
    assert got == want
