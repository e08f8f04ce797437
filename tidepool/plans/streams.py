"""Registered stream queries: a driver table replayed as a stream.

A table is written to the shared checkpoint folder as files in the order of time
(or of its ids), closed by a row later than all others where windows have to close
(see ``sources.replay``), and read in ``BATCHES`` micro-batches or more, so state
crosses micro-batches.  Each query runs to its end, writes to a table in the shared
folder and returns that table.  The results equal those of the batch forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.hot import item_view_counts
from tidepool.operators.sequence import running_totals, sized_blocks
from tidepool.operators.sequences import position_from
from tidepool.operators.text import tokenize, word_count
from tidepool.operators.topn import top_n
from tidepool.operators.windows import processing_time, sessions, tumbling
from tidepool.plans.oracle import HOT_ITEMS, ORACLE
from tidepool.plans.registry import register
from tidepool.session import shared_path
from tidepool.sources.replay import or_closing, replay
from tidepool.sources.tables import table
from tidepool.streaming import stateful
from tidepool.streaming.late import read_split, split_late
from tidepool.streaming.runner import drain, rows_per_batch, start
from tidepool.streaming.timers import running_count_stream, top_n_on_timer
from tidepool.streaming.topn import stream_top_n
from tidepool.streaming.watermarks import with_event_time

ORDER = ["ts", "event_id"]
BATCHES = 5

#: input rows of each micro-batch of a query's last run in this process
RUNS: dict[str, list[int]] = {}


def _replayed(df: DataFrame, name: str, order: Sequence[str], **closing) -> DataFrame:
    """``df`` as a stream in ``order``; a file for every task of a shuffle, so files grow in number with the cluster."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return replay(df, shared_path(spark, f"{name}-replay"), order, BATCHES, BATCHES * -(-tasks // BATCHES), **closing)


def _events(spark: SparkSession, sf_dir: str, name: str, reach: str | None = None) -> DataFrame:
    """``events`` in time order; with ``reach`` closed by a row so much later."""
    closing = {} if reach is None else {"reach": reach, "closing": {}}
    return _replayed(table(spark, sf_dir, "events"), name, ORDER, time="ts", **closing)


def _result(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream to its end and return the table it wrote."""
    spark = df.sparkSession
    path, ck = shared_path(spark, name), shared_path(spark, f"{name}-checkpoint")
    if mode == "complete":
        def put(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").parquet(path)
        query = drain(start(df, output_mode=mode, foreach_batch=put, checkpoint=ck))
    else:
        query = drain(start(df, output_mode=mode, sink="parquet", path=path, checkpoint=ck))
    RUNS[name] = rows_per_batch(query)
    return spark.read.schema(df.schema).parquet(path)


def _wall(*names: str) -> list[Column]:
    return [F.col(n).cast("timestamp_ntz").alias(n) for n in names]


@register("stream_tumbling")
def q_stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly tumbling sum and count per event type."""
    ev = with_event_time(_events(spark, sf_dir, "stream_tumbling", "1 hour"), "ts")
    out = tumbling(ev, "ts", "1 hour", ["event_type"],
                   [F.round(F.sum("value"), 2).alias("value_sum"), F.count(F.lit(1)).alias("n")])
    out = out.select("event_type", F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), "value_sum", "n")
    return _result(out, "stream_tumbling").select("event_type", *_wall("window_start", "window_end"), "value_sum", "n")


def _view_counts(spark: SparkSession, sf_dir: str, name: str, slide: str) -> DataFrame:
    """Views per item and window of 60 min, by panes; windows come out as they close."""
    ev = with_event_time(_events(spark, sf_dir, name, "2 hours"), "ts")
    ev = ev.filter(or_closing(F.col("event_type") == "view"))
    ev = ev.withColumn("item_id", F.get_json_object("props", "$.k").cast("long"))
    return item_view_counts(ev, "ts", "item_id", "60 minutes", slide)


@register("stream_hot_items")
def q_stream_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 viewed items per window, 60 min every 5 min, by panes."""
    counts = _view_counts(spark, sf_dir, "stream_hot_items", "5 minutes")
    path = shared_path(spark, "stream-hot-items")
    query = drain(stream_top_n(counts, ["window_end"], [F.desc("view_count"), F.asc("item_id")], 5, path,
                               shared_path(spark, "stream-hot-items-checkpoint")))
    RUNS["stream_hot_items"] = rows_per_batch(query)
    rows = spark.read.schema("window_end timestamp, item_id long, view_count long, rank int").parquet(path)
    return rows.select(*_wall("window_end"), "rank", "item_id", "view_count")


@register("stream_hot_items_timer")
def q_stream_hot_items_timer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 viewed items per window, 60 min every 15 min, by a keyed process: list state per window,
    a timer at its end + 1, then clear (some calls to the state store per window, however many rows it has)."""
    counts = _view_counts(spark, sf_dir, "stream_hot_items_timer", "15 minutes")
    path = shared_path(spark, "stream-hot-items-timer")
    query = drain(stream_top_n(top_n_on_timer(counts, "window_end", "item_id", "view_count", 5), ["window_end"],
                               [F.desc("view_count"), F.asc("item_id")], 5, path,
                               shared_path(spark, "stream-hot-items-timer-checkpoint")))
    RUNS["stream_hot_items_timer"] = rows_per_batch(query)
    rows = spark.read.schema("window_end timestamp, item_id long, view_count long, rank int").parquet(path)
    return rows.select(*_wall("window_end"), "rank", "item_id", "view_count")


@register("stream_sessions")
def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per user with a 30 min gap."""
    ev = with_event_time(_events(spark, sf_dir, "stream_sessions", "1 hour"), "ts")
    out = sessions(ev, ["user_id"], "ts", "30 minutes",
                   [F.round(F.sum("value"), 2).alias("value_sum"), F.count(F.lit(1)).alias("n")])
    out = out.select("user_id", F.col("session.start").alias("session_start"),
                     F.col("session.end").alias("session_end"), "value_sum", "n")
    return _result(out, "stream_sessions").select("user_id", *_wall("session_start", "session_end"), "value_sum", "n")


@register("stream_word_count")
def q_stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of all documents, updated with every micro-batch."""
    docs = _replayed(table(spark, sf_dir, "documents").select("doc_id", "text"), "stream_word_count", ["doc_id"])
    return _result(word_count(tokenize(docs, "text")), "stream_word_count", "complete")


@register("stream_running_count")
def q_stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count of each word, one row per token of the conversations."""
    conv = _replayed(table(spark, sf_dir, "conversations"), "stream_running_count", ["conv_id", "turn"])
    toks = tokenize(conv, "text", keep=["conv_id", "turn"], pos="pos")
    order = ["conv_id", "turn", "pos"]
    return _result(running_count_stream(toks, order, order), "stream_running_count")


@register("stream_count_window")
def q_stream_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: every 3 events, the sum of the last 5 values in cents."""
    ev = _events(spark, sf_dir, "stream_count_window").withColumn("cents", position_from("value"))
    return _result(stateful.count_window_stream(ev, "user_id", ORDER, 5, 3, "cents"), "stream_count_window")


@register("stream_every_n")
def q_stream_every_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, the truncated average of every 3 values in cents."""
    ev = _events(spark, sf_dir, "stream_every_n").withColumn("cents", position_from("value"))
    return _result(stateful.every_n_average_stream(ev, "user_id", ORDER, "cents", 3), "stream_every_n")


@register("stream_buffered")
def q_stream_buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, events in complete groups of 10; fewer stay in the state."""
    ev = _events(spark, sf_dir, "stream_buffered")
    out = stateful.buffered_stream(ev, "user_id", ORDER, 10, ["event_id", "ts", "value"])
    return _result(out, "stream_buffered").select("user_id", "batch_no", "slot", "event_id", *_wall("ts"), "value")


@register("stream_delta_trigger")
def q_stream_delta_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: each time the running value total moves 500.00 past the last mark,
    the event with the top value among the last day's events; mark and span are the state."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    ev, blocks = sized_blocks(ev, ["user_id"], [(f"_tp_{u}", F.date_trunc(u, "ts")) for u in ("day", "minute")])
    ev = running_totals(ev.withColumn("cents", position_from("value")), ["user_id"], ORDER, blocks, {"pos": "cents"})
    ev = _replayed(ev.select("user_id", "ts", "event_id", "value", "pos"), "stream_delta_trigger", ORDER, time="ts")
    out = stateful.delta_trigger_stream(ev, "user_id", "ts", ["event_id"], "pos", "value", 50_000, "1 day",
                                        ["event_id", "ts", "value", "pos"])
    return _result(out, "stream_delta_trigger").select(
        "user_id", *_wall("fire_ts"), "fire_event_id", "event_id", *_wall("ts"), "value", "pos")


@register("stream_out_of_order")
def q_stream_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sums of events that arrive up to two hours late, under a watermark three hours behind the
    latest time seen: no row is lost."""
    ev = table(spark, sf_dir, "events")
    arrival = F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") * 7919 % 7200
    ev = _replayed(ev.withColumn("arrival", arrival), "stream_out_of_order", ["arrival", "event_id"], time="ts",
                   reach="5 hours", closing={})
    out = tumbling(with_event_time(ev, "ts", "3 hours"), "ts", "1 hour", ["event_type"],
                   [F.round(F.sum("value"), 2).alias("value_sum"), F.count(F.lit(1)).alias("n")])
    out = out.select("event_type", F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), "value_sum", "n")
    return _result(out, "stream_out_of_order").select("event_type", *_wall("window_start", "window_end"), "value_sum", "n")


@register("stream_processing_time")
def q_stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per event type over processing-time windows of 10 s; the windows differ from run to run, their total does not."""
    ev = processing_time(_events(spark, sf_dir, "stream_processing_time"))
    out = tumbling(ev, "proc_time", "10 seconds", ["event_type"], [F.count(F.lit(1)).alias("n")])
    windows = _result(out, "stream_processing_time", "complete")
    return windows.groupBy("event_type").agg(F.sum("n").alias("n"))


LATE_DAYS = 5        # arrivals per micro-batch of the late-row query


@register("stream_late_rows")
def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive up to three hours late, in batches of five days' arrivals: which of them find
    their hour closed by a watermark one hour behind."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    arrival = F.unix_seconds("ts") + F.col("event_id") * 7919 % 10800
    ev = ev.withColumn("arrival", F.floor(arrival / (LATE_DAYS * 86400)).cast("long"))
    source, path = shared_path(spark, "stream_late_rows-replay"), shared_path(spark, "stream_late_rows")
    ck = shared_path(spark, "stream_late_rows-checkpoint")
    first, last = ev.agg(F.min("arrival"), F.max("arrival")).first()
    RUNS["stream_late_rows"] = []
    for n in range(first, last + 1) if first is not None else ():   # the query stops and resumes between arrivals
        ev.filter(F.col("arrival") == n).write.parquet(f"{source}/arrival-{n}")
        rows = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(source)
        RUNS["stream_late_rows"] += rows_per_batch(drain(split_late(rows, "ts", "1 hour", "1 hour", path, ck)))
    on_time, late = read_split(spark, path)
    return on_time.unionByName(late).select("event_id", *_wall("ts"), "arrival", *_wall("window_end"),
                                            *_wall("watermark"), "is_late")


ORACLE["stream_late_rows"] = f"""
WITH e AS (
  SELECT event_id, ts, CAST(floor((epoch(date_trunc('second', ts)) + event_id * 7919 % 10800) / {LATE_DAYS * 86400}) AS BIGINT) AS arrival
  FROM events),
m AS (
  SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                  - INTERVAL '1 hour' AS watermark
  FROM e GROUP BY arrival)
SELECT event_id, ts, arrival, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, watermark,
       coalesce(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= watermark, false) AS is_late
FROM e JOIN m USING (arrival)
"""
ORACLE["stream_tumbling"] = ORACLE["stream_out_of_order"] = ORACLE["tumbling_sum"]
ORACLE["stream_hot_items"] = HOT_ITEMS
ORACLE["stream_hot_items_timer"] = (HOT_ITEMS.replace("INTERVAL '5 minutes'", "INTERVAL '15 minutes'")
                                    .replace("(5 * k)", "(15 * k)").replace("series(1, 12)", "series(1, 4)"))
ORACLE["stream_sessions"] = f"""
SELECT user_id, session_start, session_end, value_sum, n FROM ({ORACLE["user_sessions"]})
"""
ORACLE["stream_word_count"] = ORACLE["word_count"]
ORACLE["stream_running_count"] = ORACLE["running_count"]
ORACLE["stream_count_window"] = """
WITH e AS (
  SELECT user_id, CAST(round(value * 100) AS BIGINT) AS cents,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS fire_seq FROM events),
w AS (
  SELECT *, CAST(sum(cents) OVER p AS BIGINT) AS window_sum, count(*) OVER p AS n_rows FROM e
  WINDOW p AS (PARTITION BY user_id ORDER BY fire_seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT user_id, fire_seq, window_sum, n_rows FROM w WHERE fire_seq % 3 = 0
"""
ORACLE["stream_every_n"] = f"SELECT user_id, average FROM ({ORACLE['every_n_average_events']})"
ORACLE["stream_buffered"] = ORACLE["full_batches"]
ORACLE["stream_delta_trigger"] = ORACLE["delta_trigger_max"]
ORACLE["stream_processing_time"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
